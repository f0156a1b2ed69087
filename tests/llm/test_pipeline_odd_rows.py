"""The pipeline's stages on nulls, empty and long texts, repeated rows and ids,
extra columns, and empty tables."""

import corpus_pipeline as cp
import pytest

SF = "/root/testdata/sf0.001"
LINE = "a line that is found in many documents"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(None, None), (1, None), (2, ""), (3, "word " * 30_000), (4, "the same text of some words"), (5, "the same text of some words"),
            (5, "another text under a repeated id"), (None, "a text without an id"), (6, "é ß 漢字 🙂\r\n\t"), (6, "é ß 漢字 🙂\r\n\t")]
    rows += [(100 + i, f"{LINE}\nown words of number {i} and {i * i}") for i in range(12)]
    return spark.createDataFrame([(i, t, None, None, None, "x") for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, row string")


def ids(df):
    return sorted((r.doc_id for r in df.collect()), key=str)


def test_stages_in_turn(spark, odd):
    docs = odd
    kept = {}
    for name, stage in cp.STAGES:
        docs = stage(spark, docs, SF)
        kept[name] = docs = docs.persist()
        if name != "bpe":
            assert docs.columns == cp.COLUMNS
    every = ids(odd)
    assert ids(kept["toxicity"]) == every  # nothing toxic is in them
    lines = {r.doc_id: r for r in kept["line_dedup"].collect()}
    assert ids(kept["line_dedup"]) == every
    assert all(LINE not in r.text and r.n_chars == len(r.text) for r in lines.values())
    assert lines[100].text == "own words of number 0 and 0" and lines[1].text == ""
    left = ids(kept["simhash"])
    assert 4 in left and left.count(5) == 2  # one of its rows has a text of its own
    assert 2 not in left and 1 in left  # both are empty
    assert left.count(None) >= 1 and left.count(6) == 2
    assert ids(kept["decontamination"]) == left
    assert ids(kept["bpe"]) == left


def test_stages_on_an_empty_table(spark, odd):
    for _, stage in cp.STAGES:
        assert stage(spark, odd.where("false"), SF).collect() == []
