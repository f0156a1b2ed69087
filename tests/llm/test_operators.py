"""The operators on small frames: against brute force, and with nulls, empty and
long texts, ties, repeated rows, empty tables and extra columns."""

import hashlib
import zlib

import brute
import numpy as np
import pytest

from clickweave.llm import (bpe, components, decontaminate, embedding_join, language, line_dedup, quality, simhash,
                            toxicity, urls, warc)
from clickweave.llm.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TEXTS = [None, "", " \t\n", "one", "One\ntwo", "a b c d e f g", "A b C d e f g", "é ß 漢字 🙂 <|endoftext|> don't  stop\n\n",
         "lorem ipsum " * 3000, "x" * 50_000, "\n".join(f"line {i % 7}" for i in range(300))]


@pytest.fixture(scope="module")
def odd(spark):
    """Rows with nulls, repeats, and columns named like those of the operators."""
    rows = [(i, t, "en", f"s{i}", 1, "dk", 0.5) for i, t in enumerate(TEXTS)]
    rows += [(20 + i, "shared line\nown " + str(i), "fr", None, None, "h1", None) for i in range(14)]
    rows += [rows[4], rows[4], rows[5]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, dk string, score double")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def empty(df):
    return df.where("doc_id < -1")


def test_simhash(odd):
    got = simhash.near_duplicates(odd).select("doc_id", "fingerprint", "component_id")
    assert rows(got) == brute.simhash_rows(pairs(odd))
    assert rows(simhash.near_duplicates(empty(odd))) == []


def test_simhash_hashes_every_shingle_of_long_texts(spark, monkeypatch):
    rng = np.random.default_rng(11)
    texts = ["a b " * 32_770 + "a",  # 65,539 shingles of two kinds: one lost shingle turns bits
             " ".join(f"w{i}" for i in rng.integers(0, 900, 131_080)), "a b " * 32_770 + "a c"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert rows(simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id")) == brute.simhash_rows(pairs(docs))
    monkeypatch.setattr(simhash, "HASH_BLOCK", 4)
    for n in range(40):
        text = "a b " * (n // 2) + "a" * (n % 2)
        assert simhash.fingerprint(text) == brute.simhash(text)


def test_simhash_links_every_distance_three(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(-2**63, 2**63 - 1, 40)
    fps = set(base.tolist())
    for b in base.tolist():
        for k in (1, 2, 3, 4):
            x = b
            for bit in rng.choice(64, k, replace=False).tolist():
                x ^= 1 << bit if bit < 63 else -(1 << 63)
            fps.add(x)
    fps |= {int(base[0]) ^ i for i in range(200)}  # one dense group
    fps = sorted(fps)
    want = brute.components(fps, [(a, b) for i, a in enumerate(fps) for b in fps[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= 3])
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    for chunk in (2048, 7):
        comp = {r.node: r.component for r in components.connected_components(simhash.links(df, chunk=chunk)).collect()}
        assert {x: comp.get(x, x) for x in fps} == want


def test_simhash_one_of_each(spark):
    rows_in = [(1, "a b c d"), (1, "a b c d"), (2, "A b c d"), (3, "a  b c d"), (3, "no such words here"), (4, "far from all of it"),
               (None, "a b c d"), (5, ""), (6, None)]
    docs = spark.createDataFrame(rows_in, "doc_id long, text string").selectExpr("*", "1L as fp", "'x' as component_id")
    got = [(r.doc_id, r.text) for r in simhash.one_of_each(docs).collect()]
    assert sorted(got, key=str) == sorted([r for r in rows_in if r[0] not in (2, 6)], key=str)
    assert simhash.one_of_each(empty(docs)).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 180)] + [(7, 7), (None, 3), (3, None)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {i: 100 for i in range(101, 180)}


def test_bpe(odd, spark):
    assert rows(bpe.encode_decode(odd)) == brute.bpe_rows(pairs(odd))
    assert rows(bpe.encode_decode(empty(odd))) == []
    back = bpe.decode(bpe.encode_decode(odd, with_ids=True))
    assert sorted(r.text for r in back.collect()) == sorted(t or "" for _, t in pairs(odd))


@pytest.fixture(scope="module")
def codecs():
    import public_tokenizers
    from tokenizers import Tokenizer
    with open(bpe.default_vocabulary(), encoding="utf-8") as f:
        own = bpe.Codec(f.read(), bpe.letter_classes())
    return own, Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def same_ids(codecs, texts):
    own, library = codecs
    for text, got, want in zip(texts, own.encode_block(texts), library.encode_batch(texts, add_special_tokens=False)):
        assert got.tolist() == want.ids, text


def test_bpe_words_of_one_polynomial_hash(codecs):
    pair = ["aaafgdaacadabaaaaaaaaa", "cegaaaacaaaaabacfcaaaa"]
    same_ids(codecs, pair)
    same_ids(codecs, [" ".join(pair), " ".join(pair[::-1])])


def test_bpe_every_code_point(codecs):
    """Beside an apostrophe, digits, letters and spaces."""
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 4000):
        same_ids(codecs, ["".join(f"{chr(c)}'s {chr(c)}1 {chr(c)}a  {chr(c)}\n" for c in points[i:i + 4000])])


def test_bpe_random_texts(codecs):
    rng = np.random.default_rng(0)
    pieces = [*"ab'stmdrevl 019.!\n\t  éß漢🙂\u0085\u200bᲊA", "<|endoftext|>"]
    for _ in range(100):
        same_ids(codecs, ["".join(rng.choice(pieces, rng.integers(0, 25))) for _ in range(1000)])


def test_line_dedup(odd):
    for least in (1, 2, 10):
        out = line_dedup.dedup_lines(odd, min_docs=least)
        got = sorted((r.row.doc_id, r.n_lines, r.n_dropped, hashlib.sha256(r.kept.encode()).hexdigest()) for r in out.collect())
        assert got == brute.line_rows(pairs(odd), least)
    assert rows(line_dedup.dedup_lines(empty(odd))) == []


def test_line_dedup_keeps_first_occurrences(spark):
    docs = spark.createDataFrame([(2, "b\na\nb"), (1, "a\nc\n"), (3, "C \n\nd")], "doc_id long, text string")
    out = {r.row.doc_id: r.kept for r in line_dedup.dedup_lines(docs, min_docs=1, keep_first=True).collect()}
    assert out == {1: "a\nc\n", 2: "b", 3: "\nd"}


def test_decontaminate(odd, spark):
    items = [(1, "shared LINE own 3"), (2, "Lorem ipsum " * 8), (3, None), (4, "..."), (5, "a b c d e f g"), (2, "Lorem ipsum " * 8)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.decontaminate(odd, bench)
    got = sorted((r.row.doc_id, r.n_words, r.n_hit, len(r.item_ids),
                  hashlib.sha256(",".join(r.item_ids).encode()).hexdigest(), r.contaminated) for r in out.collect())
    assert got == brute.leak_rows(pairs(odd), items)
    assert rows(decontaminate.decontaminate(empty(odd), bench)) == []
    assert not any(r.contaminated for r in decontaminate.decontaminate(odd, bench.where("item_id > 9")).collect())


def test_proximity_matches(spark):
    docs = spark.createDataFrame([(1, "w1 w2 w3"), (2, "w1 x w2 w3"), (3, "w1 x x x x w3")], "doc_id long, text string")
    ix = decontaminate.Index(docs, spark.createDataFrame([(1, "w1 w2 w3")], "item_id long, text string"))
    assert len(ix.candidates().collect()) == 1
    assert {r.gap for r in ix.proximity(2).collect()} <= {1, 2} and ix.proximity(2).count() >= 1
    ix.drop()


def test_embedding_join(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(12, 6))
    v = [(i, (base[i % 12] + 0.25 * rng.normal(size=6)).tolist()) for i in range(150)]
    v += [(200 + i, base[0].tolist()) for i in range(9)]
    v += [(300, None), (301, []), (302, [0.0] * 6), (303, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (304, [float("nan")] + [1.0] * 5),
          (305, [float("inf")] + [1.0] * 5), (306, [1e200] * 6), (307, [2e200] * 6)]
    df = spark.createDataFrame(v, "vec_id long, embedding array<double>").selectExpr("*", "'x' as k", "1 as block")
    with np.errstate(all="ignore"):
        want = brute.vector_rows([(i, x if i < 306 else [1.0] * 6) for i, x in v])
    for block in (1536, 8):
        assert rows(embedding_join.near_duplicates(df, block=block)) == want
    assert rows(embedding_join.near_duplicates(df.where("vec_id < 0"))) == []
    mixed = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, [2.0, 0.0]), (None, [1.0, 0.0])], "vec_id long, embedding array<double>")
    got = sorted((r for r in map(tuple, embedding_join.near_duplicates(mixed).collect()) if r[0]))
    assert got == [(1, 1, 1, True), (2, 0, 2, True), (3, 1, 1, False)]


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.score(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in got]) >= 0.9
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


@pytest.mark.parametrize("wrong, recall, precision", [(0.0, 0.84, 0.95), (0.1, 0.75, 0.85)])
def test_toxicity_recall_and_wrong_labels(spark, wrong, recall, precision):
    """Of 97 held-out toxic documents 11 hold no toxic word, so 0.887 is the most."""
    from pyspark.sql import functions as F
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    flip = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(100)) < int(100 * wrong)
    seen = labels.withColumn("toxic", F.when(flip, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    got = toxicity.score(docs, seen).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    hit = sum(r.predicted and r.toxic for r in got)
    assert hit >= recall * sum(r.toxic for r in got) and hit >= precision * sum(r.predicted for r in got)


def test_viterbi_equals_exhaustive_search():
    import itertools
    rng = np.random.default_rng(6)
    logp = np.log(rng.dirichlet(np.ones(toxicity.SYMBOLS), (toxicity.SYMBOLS, toxicity.SYMBOLS))).astype(np.float32)
    d = toxicity.Decoder(logp)
    code = lambda c: toxicity.CODE.get(c, 0 if not c.isalpha() else toxicity.OTHER)
    for span, spaced in [("1d10t", False), ("l0ser", False), ("stuuup", False), ("$c0m!", False), ("a b-c", True), ("m . 0 r", True)]:
        best = (-np.inf, "")
        for path in itertools.product(*d.columns(span, spaced)):
            a = b = 0
            p = 0.0
            for x, q in path:
                p += q
                if x:
                    p += float(logp[a, b, code(x)])
                    a, b = b, code(x)
            best = max(best, (p + float(logp[a, b, 0]), "".join(x for x, _ in path)))
        assert d(span, spaced) == best[1]


def test_toxicity_restores_disguised_words(spark, odd):
    words = "you are an idiot and a loser such a moron stupid people like this clown are worthless scum"
    clean = "the weather in the morning was good and people liked to walk along the river with others"
    docs = spark.createDataFrame([(i, (words if i % 2 else clean) + f" {i}") for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    test = docs.union(spark.createDataFrame([(1000, "what an 1d10t"), (1001, "you l o s e r"), (1002, "m0r0n"), (1003, "STUUUUPID"),
                                             (1004, "the river"), (1005, None), (1006, ""), (None, "scum")], "doc_id long, text string"))
    got = {r.doc_id: r for r in toxicity.score(test, labels, with_text=True).collect()}
    assert [got[i].predicted for i in (1000, 1001, 1002, 1003, 1004, 1005, 1006, None)] == [1, 1, 1, 1, 0, 0, 0, 1]
    assert got[1000].restored == "what an idiot" and got[1001].restored == "you loser"
    assert toxicity.score(empty(odd), labels).count() == 0
    assert {r.score for r in toxicity.score(odd, labels.where("doc_id < 0")).collect()} == {0.0}


def test_toxicity_restores_every_run(spark):
    words = "you are an idiot and a loser such a moron stupid people like this clown are worthless scum"
    clean = "the weather in the morning was good and people liked to walk along the river with others"
    docs = spark.createDataFrame([(i, (words if i % 2 else clean) + f" {i}") for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    toxic = ["l0000ser", "$$$tupid", "!diot", "i  d  i  o  t", "m - o - r - o - n", "stu" + "u" * 450 + "pid", "m000000r0n", "what scum!",
             "the.river." * 30 + "1d10t", "1d" + "1" * 250 + "0t"]
    fine = ["good!", "walk along the river!!!", "1 2 3", "$1000 and 10,000", "€5 000 000 | 12", "3.5 7 8 1", "good | river", "1000 km"]
    test = docs.union(spark.createDataFrame([(1000 + i, t) for i, t in enumerate(toxic + fine)], "doc_id long, text string"))
    got = {r.doc_id - 1000: r for r in toxicity.score(test, labels, with_text=True).where("doc_id >= 1000").collect()}
    assert [(t, got[i].predicted, got[i].restored) for i, t in enumerate(toxic) if not got[i].predicted] == []
    assert [(t, got[len(toxic) + i].restored) for i, t in enumerate(fine) if got[len(toxic) + i].predicted] == []
    assert got[len(toxic)].restored == "good!" and got[len(toxic) + 2].restored == "1 2 3"
    assert [got[i].restored for i in (0, 1, 2, 3)] == ["loser", "stupid", "idiot", "idiot"]


def test_language_held_out(spark, odd):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in got if r.held_out]) >= 0.93
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    by = {r.doc_id: r for r in language.identify(odd).collect()}
    assert [by[i].lang_pred for i in (0, 1, 2)] == ["und"] * 3 and by[3].lang_pred in ("en", "fr")
    assert rows(language.identify(empty(odd))) == []


def test_language_learns_every_label(spark):
    d = [(2 * i + k, f"w{i} x{i} " * 6, f"l{i:03d}") for i in range(230) for k in (0, 1)]
    net = language.train(spark.createDataFrame(d, "doc_id long, text string, lang string"))
    assert net.languages == [f"l{i:03d}" for i in range(230)]


def test_quality_selects_what_looks_like_the_target(spark, odd):
    docs = spark.createDataFrame([(i, ("good fine words here " if i % 2 else "junk spam noise trash ") * 5) for i in range(100)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 60)], "doc_id long, quality int")
    got = quality.resample(docs, labels).collect()
    assert sum(r.selected for r in got) == 50 and all(r.selected == bool(r.doc_id % 2) for r in got)
    assert quality.resample(odd, labels, 0.25).where("selected").count() == -(-odd.count() // 4)
    assert rows(quality.resample(empty(odd), labels)) == []


URLS = [(1, "http://A.Example.NET/en/x?y#z", "a.example.net", "/en/x", "example.net/en/", "allow"),
        (2, "https://x.net", "x.net", "", None, None), (3, "https://x.net/", "x.net", "/", "net/", "block"),
        (4, "http://example.com/de/a", "example.com", "/de/a", "example.com/de/", "block"),
        (5, "http://notexample.com/de/a", "notexample.com", "/de/a", None, None),
        (6, "http://a.org/fr/1", "a.org", "/fr/1", "org/fr/", "allow"), (7, None, "", "", None, None), (8, "", "", "", None, None),
        (9, "a.net/en/", "", "", None, None), (10, "x://b.net?q://c.org/fr/", "b.net", "", None, None), (11, "http://net/a", "net", "/a", "net/", "block")]


def test_url_rules(spark):
    df = spark.createDataFrame([(u[0], u[1], "h") for u in URLS + URLS[:2]], "page_id long, url string, host string")
    got = {r.page_id: r for r in urls.judge(df).collect()}
    assert urls.judge(df).count() == len(df.collect())
    for i, _, host, path, rule, verdict in URLS:
        r = got[i]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    assert rows(urls.judge(df.where("page_id < 0"))) == []
    assert all(r.verdict == "allow" for r in urls.judge(df.where("page_id = 2")).collect())


def test_warc_audit(spark):
    p = [(i, f"http://h/{i}", "<p>" + "x" * i + "</p>") for i in range(700)] + [(5, "http://h/5", "<p>xxxxx</p>"), (None, None, None)]
    df = spark.createDataFrame(p, "page_id long, url string, html string").selectExpr("*", "1 as part", "2 as offset")
    from pyspark.sql import functions as F
    got = warc.audit_damaged_copy(df, F.expr("page_id % 50 = 7"), F.expr("page_id % 90 = 3"), fanout=4, per_file=64).collect()
    assert len(got) == 702 and sorted(r.ordinal for r in got) == list(range(702))
    for r in got:
        i = r.page_id if r.page_id is not None else 1
        assert r.status == ("missing" if i % 90 == 3 else "corrupt" if i % 50 == 7 else "ok")
    files = {}
    for r in sorted(got, key=lambda r: r.ordinal):
        assert r.offset == files.get(r.warc_file, 0)
        files[r.warc_file] = r.offset + r.length
    assert warc.audit_damaged_copy(df.where("page_id < 0"), F.lit(True), F.lit(False)).count() == 0
    recs = sorted(r.record for r in warc.records(df).collect())
    one = spark.createDataFrame([("f", "".join(recs).encode())], "file string, content binary")
    assert sorted(bytes(r.record).decode() for r in warc.parse(one).collect()) == recs


def test_warc_audit_of_two_replicas(spark):
    page = lambda i, body: (i, f"http://h/{i}", body)
    a = [page(i, f"body {i}") for i in range(300)] + [page(9, "other"), page(20, "body 20"), page(30, "third"), (None, None, None)]
    b = [page(i, "bodY 250" if i == 250 else f"body {i}") for i in range(300) if i not in (0, 9, 100)]
    b += [page(9, "other"), page(30, "changed"), page(1000, "new"), page(40, "second"), (None, None, "x")]
    cols = "page_id long, url string, html string"
    a, b = spark.createDataFrame(a, cols), spark.createDataFrame(b, cols)
    want = sorted([(0, "missing"), (9, "missing"), (20, "missing"), (30, "corrupt"), (40, "extra"), (100, "missing"),
                   (250, "corrupt"), (1000, "extra"), (-1, "corrupt")])
    primary = warc.records(a)
    in_files = warc.parse(warc.records(b).selectExpr("'f' as file", "cast(record as binary) as content"))
    for replica in (warc.records(b), in_files):
        got = warc.audit(primary, replica, fanout=4, per_file=16).collect()
        assert sorted((-1 if r.page_id is None else r.page_id, r.status) for r in got if r.status != "ok") == want
        assert len(got) == 306 and sorted(r.ordinal for r in got if r.status != "extra") == list(range(304))
        sha = {hashlib.sha256(r.record.encode()).hexdigest() for r in primary.collect()}
        assert {r.sha256 for r in got if r.status != "extra"} == sha
    assert {r.status for r in warc.audit(primary, primary).collect()} == {"ok"}
    none = primary.where("page_id < 0")
    assert {r.status for r in warc.audit(primary, none).collect()} == {"missing"}
    assert {r.status for r in warc.audit(none, primary).collect()} == {"extra"}


def test_large_ids_beside_null_ids_stay_exact(spark):
    ids = [2**53 + 1, 2**53 + 3, None, -2**63, 2**63 - 1]
    d = spark.createDataFrame([(i, f"some words of text {k}", "en") for k, i in enumerate(ids)],
                              "doc_id long, text string, lang string").coalesce(1)
    labels = spark.createDataFrame([(ids[0], 1, 1), (ids[1], 0, 0)], "doc_id long, toxic int, quality int")
    encoded = bpe.encode_decode(d, with_ids=True)
    for out in (simhash.near_duplicates(d), encoded, bpe.decode(encoded), toxicity.score(d, labels), language.identify(d),
                quality.resample(d, labels), line_dedup.dedup_lines(d).select("row.doc_id")):
        assert {r.doc_id for r in out.collect()} == set(ids) and dict(out.dtypes)["doc_id"] == "bigint"
    pages = spark.createDataFrame([(i, f"http://other/{i}") for i in ids] + [(1, "http://a.net/"), (2, "http://a.org/fr/")],
                                  "page_id long, url string").coalesce(1)
    assert {r.page_id for r in urls.judge(pages).collect()} == {*ids, 1, 2}


def test_queries_cover_all_operators():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


def test_pipeline_stages(spark):
    import __spark_entry__ as entry
    import corpus_pipeline as cp
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sf = "/root/testdata/sf0.01"
    toxic = {r.doc_id for r in toxicity.score(docs, spark.read.parquet(f"{sf}/labels.parquet")).where("predicted = 1").collect()}
    d = [(i, t) for i, t in pairs(docs) if i not in toxic]
    hit = {}
    for i, t in d:
        for x in {brute.lower(x.strip(" \t\n\x0b\x0c\r")) for x in (t or "").split("\n")}:
            hit.setdefault(x, set()).add(i)
    d = [(i, "\n".join(x for x in (t or "").split("\n") if not (k := brute.lower(x.strip(" \t\n\x0b\x0c\r"))) or len(hit[k]) < 10)) for i, t in d]
    stays = {i for i, _, c in brute.simhash_rows(d) if i == c}
    d = [x for x in d if x[0] in stays]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    leaks = {r[0] for r in brute.leak_rows(d, items) if r[-1]}
    d = [x for x in d if x[0] not in leaks]
    assert rows(entry.queries()["pipeline"](spark, sf)) == brute.bpe_rows(d)
    assert [k for k, _ in cp.STAGES] == ["toxicity", "line_dedup", "simhash", "decontamination", "bpe"]
