"""The Merkle audit against a plain comparison of two replicas with places, and
damaged archive files."""

import gzip
import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from clickweave.llm import warc


def plain_audit(a, b):
    """[(page_id, record, file, offset)] of both sides -> Counter of (page_id,
    file, offset, status, replica file, replica offset)."""
    key = lambda r: (r[2], r[3])
    out, left, over = Counter(), defaultdict(list), defaultdict(list)
    same = defaultdict(lambda: ([], []))
    for side, rows in enumerate((a, b)):
        for r in rows:
            same[r[0], hashlib.sha256(r[1].encode()).hexdigest()][side].append(r)
    for x, y in same.values():
        x, y = sorted(x, key=key), sorted(y, key=key)
        for p, q in zip(x, y):
            out[p[0], p[2], p[3], "ok", q[2], q[3]] += 1
        for r in x[len(y):]:
            left[r[0]].append(r)
        for r in y[len(x):]:
            over[r[0]].append(r)
    for i in left.keys() | over.keys():
        x, y = sorted(left[i], key=key), sorted(over[i], key=key)
        for p, q in zip(x, y):
            out[i, p[2], p[3], "corrupt", q[2], q[3]] += 1
        for p in x[len(y):]:
            out[i, p[2], p[3], "missing", None, None] += 1
        for q in y[len(x):]:
            out[i, None, None, "extra", q[2], q[3]] += 1
    return out


def pack(rows, per_file=40):
    """[(page_id, record)] in archive order -> with file and offset."""
    out, at = [], 0
    for k, (i, r) in enumerate(rows):
        at = 0 if k % per_file == 0 else at
        out.append((i, r, f"f{k // per_file}", at))
        at += len(r)
    return out


BASE = [(i * 3 if i % 11 else None, f"record {i} " + "x" * (i % 7)) for i in range(220)] + [(30, "again"), (30, "again"), (30, "again")]


def replicas():
    rng = np.random.default_rng(4)
    shuffled = [BASE[i] for i in rng.permutation(len(BASE))]
    return {"same": BASE, "reversed": BASE[::-1], "shuffled": shuffled, "lost first": BASE[1:], "lost some": [r for k, r in enumerate(BASE) if k % 50 != 9],
            "extra": BASE[:100] + [(5, "new"), (10**15, "far"), (-10**15, "far")] + BASE[100:],
            "changed": [(i, r.upper() if k % 60 == 7 else r) for k, (i, r) in enumerate(BASE)],
            "one less of three": BASE[:-1], "all": [(i, r + "!" if k % 31 == 3 else r) for k, (i, r) in enumerate(shuffled) if k % 17] + [(7, "z")], "empty": []}


@pytest.mark.parametrize("name", list(replicas()))
def test_audit_equals_a_plain_comparison(spark, name):
    a, b = pack(BASE), pack(replicas()[name])
    cols = "page_id long, record string, file string, offset long"
    x, y = spark.createDataFrame(a, cols), spark.createDataFrame(b, cols)
    got = warc.audit(x, y, fanout=4, places=True).collect()
    assert Counter((r.page_id, r.warc_file, r.offset, r.status, r.replica_file, r.replica_offset) for r in got) == plain_audit(a, b)
    for r in got:
        assert r.moved == (r.status in ("ok", "corrupt") and (r.warc_file, r.offset) != (r.replica_file, r.replica_offset))
    if name == "reversed":
        assert sum(r.moved for r in got) > 200


def test_descent_follows_differing_branches_only(spark):
    recs = spark.createDataFrame([(i, f"r{i}") for i in range(4096)], "page_id long, record string")
    one = recs.selectExpr("page_id", "if(page_id = 1234, 'other', record) as record")
    def visits(b):
        a_, b_ = (warc.placed(x, False, 10**6).selectExpr("*", "page_id div 16 as node") for x in (recs, b))
        return warc.compare(warc.leaves(a_, "p").union(warc.leaves(b_, "r")), 256, "p", "r", 4)[1]
    assert visits(recs) == [0]  # ends at the root
    seen = visits(one.selectExpr("page_id", "if(page_id = 1234, 'r123x', record) as record"))
    assert seen == [1, 1, 1, 1, 1]
    assert max(visits(recs.where("page_id <> 4095"))) == 1


def test_parse_reports_damage_and_swallows_nothing(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i}</p>") for i in range(6)], "page_id long, url string, html string")
    recs = [r.record.encode() for r in warc.records(pages).orderBy("page_id").collect()]
    assert all(b"\r\nWARC-Date: " in r for r in recs)
    no_length = recs[1].replace(b"Content-Length: 8\r\n", b"")
    short = recs[3].replace(b"Content-Length: 8", b"Content-Length: 3")
    too_long = recs[5].replace(b"Content-Length: 8", b"Content-Length: 900")
    headless = recs[2].replace(b"\r\n\r\n", b"\r\n", 1)
    files = {"ok": recs, "a": [recs[0], no_length, recs[2], short, recs[4], too_long], "b": [b"junk\r\n", recs[0], headless, recs[4]], "none": []}
    rows = [(k, b"".join(v)) for k, v in files.items()] + [("null", None)]
    rows.append(("gz", b"".join(gzip.compress(r) for r in recs)))
    broken = gzip.compress(recs[1])
    rows.append(("bad", gzip.compress(recs[0]) + broken[:20] + b"\0\0\0" + broken[23:] + gzip.compress(recs[2])))
    got = defaultdict(list)
    for r in warc.parse(spark.createDataFrame(rows, "file string, content binary")).collect():
        got[r.file].append((r.offset, r.page_id, r.damage, bytes(r.record)))
    got = {k: sorted(v) for k, v in got.items()}
    assert [g[1:] for g in got["ok"]] == [(i, None, r) for i, r in enumerate(recs)]
    assert [g[1:3] for g in got["a"]] == [(0, None), (1, "no length"), (2, None), (3, "wrong length"), (4, None), (5, "wrong length")]
    assert [g[3] for g in got["a"]] == files["a"]
    assert [g[2] for g in got["b"]] == ["no header", None, "wrong length", None]
    assert [g[1:3] for g in got["gz"]] == [(i, None) for i in range(6)] and [g[3] for g in got["gz"]] == recs
    assert got["bad"][0][1:3] == (0, None) and got["bad"][-1][1:3] == (2, None) and {g[2] for g in got["bad"][1:-1]} == {"damaged member"}
    assert "none" not in got and "null" not in got
