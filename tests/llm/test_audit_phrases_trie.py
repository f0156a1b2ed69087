"""Filter audit, phrase fingerprints and the conversation trie against plain
versions, with odd rows."""

import hashlib

import brute_audit as brute
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from clickweave.llm import conversation_trie, filter_audit, phrases, scan
from clickweave.llm.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i}" for i in range(150))
TEXTS = [None, "", " \t ", "few words", LONG, LONG + " # mark", "SHOUTED " * 120, LONG.upper(), "same words " * 80,
         "é ß 漢字 🙂 " * 60, "x" * 30_000, "&"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, ["en", "fr", None][i % 3], f"s{i}", "p", 3) for i, t in enumerate(TEXTS)]
    rows += [(100 + i, LONG if i % 2 else "copy " + LONG, "en", None, None, None) for i in range(9)]
    rows += [(None, LONG, "fr", None, None, None), (None, None, None, None, None, None), rows[4], rows[4]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, part string, row_id int")


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_running_sums_cross_partitions(spark):
    rng = np.random.default_rng(3)
    rows = [(int(g), i, int(v)) for i, (g, v) in enumerate(zip(rng.choice([1, 2, 2, 2, 7], 500), rng.integers(-5, 9, 500)))]
    df = spark.createDataFrame(rows, "g long, i long, v long").repartition(5)
    total, want = {}, []
    for g, i, v in rows:
        total[g] = total.get(g, 0) + v
        want.append((g, i, v, total[g]))
    assert got(scan.running_sums(df, ["g"], [F.col("i")], {"s": "v"})) == sorted(want, key=str)
    assert sorted(r.s for r in scan.running_sums(df.withColumn("one", F.lit(1)), [], [F.col("i")], {"s": "one"}).collect()) == list(range(1, 501))
    assert got(scan.running_sums(df.where("false"), ["g"], [F.col("i")], {"s": "v"})) == []


def test_audit(odd, spark):
    labels = [(0, 1, 0), (4, 1, 1), (4, 0, 0), (6, None, 1), (101, 1, None), (None, 1, 1), (999, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = [(r.doc_id, r.text, r.lang) for r in odd.collect()]
    assert got(filter_audit.audit(odd, table)) == sorted(brute.audit_rows(docs, labels), key=str)
    assert got(filter_audit.audit(odd, table.where("false"))) == sorted(brute.audit_rows(docs, []), key=str)
    assert got(filter_audit.audit(odd.where("false"), table)) == []


def test_audit_of_own_filters(odd, spark):
    table = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = filter_audit.audit(odd, table, {"n": F.col("doc_id") > 3, "s": F.col("source").isNull()}, repeated=None)
    found = {(r.part, r.filter_order, r.step): r for r in rows.collect()}
    docs = odd.where("lang = 'en'").collect()
    assert found["en", "ns", 1].removed == sum(r.doc_id > 3 for r in docs) and found["en", "ns", 2].kept == sum(
        r.doc_id <= 3 and r.source is not None for r in docs)
    assert {o for _, o, _ in found} == {"ns", "sn"}
    for p in ("en", "fr", ""):
        assert found[p, "ns", 2].kept == found[p, "sn", 2].kept
        assert found[p, "ns", 2].removed + found[p, "ns", 2].redundant == found[p, "sn", 1].removed


def test_hot_copies_take_the_broadcast_path(spark, monkeypatch):
    rows = spark.range(200).select(F.col("id").alias("row_id"), F.col("id").alias("doc_id"),
                                   F.when(F.col("id") < 80, b"a").otherwise((F.col("id") % 90).cast("string").cast("binary")).alias("digest"))
    want = None
    for share in (0.0, 0.1, 1.0):
        monkeypatch.setattr(filter_audit, "HOT_SHARE", share)
        ids = sorted(r.row_id for r in filter_audit.repeats(rows).collect())
        want = want or ids
        assert ids == want and len(ids) == 79 + 30


def test_phrase_sets_match_a_plain_parse():
    for text in ["", "a", "aaaaaaa", "abracadabra" * 20, "漢字🙂" * 9 + "x", "x" * 5000]:
        known, points = {}, phrases.code_points(text)
        phrases.parse(points.tolist(), 0, known, 0)
        ends = phrases.ends_of(known).tolist()
        assert {text[a:b] for a, b in zip([0, *ends], ends)} == brute.phrase_set(text)
        hashes = phrases.phrase_hashes(points.astype(np.uint64), np.array(ends, np.int64))
        assert len(set(hashes.tolist())) == len(hashes) == len(ends)
        again = phrases.phrase_hashes(phrases.code_points("ab" + text).astype(np.uint64), np.array(ends, np.int64) + 2, 2)
        assert again.tolist() == hashes.tolist()
    own, edited, whole = phrases.both("abracadabra" * 30, "something else " * 40)
    assert own == phrases.fingerprint("abracadabra" * 30) and edited == phrases.fingerprint(whole)


def test_likeness_estimates_the_share_of_common_phrases():
    rng = np.random.default_rng(5)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(400)]
    a = " ".join(rng.choice(words, 900))
    for b in (a, a[:4000] + " ".join(rng.choice(words, 200)), " ".join(rng.choice(words, 900)), "1234567890" * 200):
        x, y = brute.phrase_set(a), brute.phrase_set(b)
        assert abs(phrases.likeness(phrases.fingerprint(a), phrases.fingerprint(b)) - len(x & y) / len(x | y)) < 0.15
    assert phrases.likeness(b"", b"") == 1 and phrases.likeness(b"", phrases.fingerprint("a")) == 0


def test_edited_pairs(odd):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    want = []
    for d, t, edited, after in brute.edited_texts(docs):
        x, y, z = map(phrases.fingerprint, (t, edited, after))
        want.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), x.hex(), y.hex(), phrases.likeness(x, y), phrases.likeness(x, z)))
    assert got(phrases.edited_pairs(odd)) == sorted(want, key=str)
    alone = phrases.edited_pairs(odd.where("doc_id = 1")).first()  # its own next
    assert (alone.near_edited, alone.near_next) == (1.0, 1.0)
    alone = phrases.edited_pairs(odd.where("doc_id = 5")).first()
    assert alone.near_edited < 1.0 and alone.near_next == 1.0
    assert got(phrases.edited_pairs(odd.where("false"))) == []
    assert {(r.doc_id, r.fingerprint) for r in phrases.fingerprints(odd).collect()} == {(w[0], w[3]) for w in want}


CONV = "conv_id long, turn long, role string, text string, conv string, key int"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "c", 1) for r in rows], CONV)


def odd_turns():
    rng = np.random.default_rng(8)
    rows = []
    for c in [*range(0, 12), *range(195, 215), 300, 301, 302, -3, -101, 2**53 + 1]:
        for t in range(int(rng.integers(0, 9))):
            rows.append((c, t, ["user", "assistant", None][t % 3], f"turn {rng.integers(0, 2)}"))
    rows += [(5, None, "user", "first"), (5, 1, None, None), (5, 1, None, None), (None, 1, "user", "nobody"), (7, 2**40, "", "last")]
    rows += [(301, t, "user", "same") for t in range(40)] + [(302, t, "user", "same") for t in range(40)]
    return rows


def test_trie(spark):
    rows = odd_turns()
    df = conversations(spark, rows)
    want = brute.trie_rows(rows)
    assert got(conversation_trie.trie(df)) == want
    assert got(conversation_trie.trie(df, block=50)) == want  # many ranges and levels
    assert got(conversation_trie.trie(df, most=0)) == brute.trie_rows(rows, lead=lambda c: 0)
    assert got(conversation_trie.trie(df.where("false"))) == []


@pytest.mark.parametrize("block", [5, 30])
def test_list_ranking(spark, block, monkeypatch):
    """Lists whose successors lie anywhere, and near by."""
    monkeypatch.setattr(conversation_trie, "CHUNK", 4)
    rng = np.random.default_rng(block)
    ids = [(int(c) * 1000, int(k)) for c in range(6) for k in range(9)]
    for order in (ids, [ids[i] for i in rng.permutation(len(ids))]):
        rows = [(*a, *(b or (None, None))) for a, b in zip(order, [*order[1:], None])]
        tour = spark.createDataFrame(rows, "conv long, k long, next_conv long, next_k long")
        place = {(r.conv, r.k): r.pos for r in conversation_trie.positions(tour, len(ids), block).collect()}
        assert place == {a: i for i, a in enumerate(order)}


def test_trie_of_copies_in_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "CHUNK", 3)
    rows = [(c, t, "user", f"t{t}") for c in range(0, 4000, 100) for t in range(7)] + [(100 * c + 50, 0, "user", f"x{c % 20}") for c in range(30)]
    assert got(conversation_trie.trie(conversations(spark, rows))) == brute.trie_rows(rows)


@pytest.mark.parametrize("name", ["op11_filter_audit", "op13_conversation_trie"])
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    rel = con.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    at = [rel.columns.index(c) for c in df.columns]
    assert got(df) == sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=str)
