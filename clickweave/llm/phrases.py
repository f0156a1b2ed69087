"""Lempel-Ziv phrase fingerprints of documents.

A text is parsed into phrases: the longest phrase known so far and one more
character make a new one. The hashes of the phrase set go through PERMUTATIONS
hash functions, and of each function's minimum one byte is kept. The share of
equal bytes of two fingerprints, less the chance of equality by accident,
estimates the Jaccard likeness of the phrase sets, which is high where one text
would help to compress the other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import as_id, as_text, checkpoint, shuffle_partitions

PERMUTATIONS = 128
# Rows that a Python worker gives back at once.
ROWS = 2000
# Phrases that are hashed at once.
WIDTH = 1024
NODE = 21  # bits of a code point
BASE = 0x9E3779B97F4A7C15
_rng = np.random.Generator(np.random.PCG64(12))
# Permutations of 32-bit numbers: odd factors and addends.
FACTORS = _rng.integers(0, 1 << 31, (PERMUTATIONS, 1), np.uint32) * np.uint32(2) + np.uint32(1)
ADDENDS = _rng.integers(0, 1 << 32, (PERMUTATIONS, 1), np.uint32)


def parse(chars: list[int], at: int, known: dict[int, int], node: int) -> int:
    """Parses characters that begin at position ``at`` of a text on from ``node``,
    the phrase begun so far (0: none), and returns the phrase begun last.
    ``known``: node << NODE | character -> node << NODE; a phrase's node is the
    position where it was found to end, so the values are the phrases' ends."""
    get = known.get
    for i, c in enumerate(chars, at + 1):
        key = node | c
        node = get(key)
        if node is None:
            known[key] = i << NODE
            node = 0
    return node


def ends_of(known: dict[int, int]) -> np.ndarray:
    """Ends of the phrases, in order; each begins where the one before it ends."""
    return np.fromiter(known.values(), np.int64, len(known)) >> NODE


_powers = [np.ones(1, np.uint64)] * 2


def phrase_hashes(points: np.ndarray, ends: np.ndarray, start: int = 0) -> np.ndarray:
    """Hashes of the phrases of a text that begin at ``start``: polynomials of
    their characters, whatever their place."""
    if len(_powers[0]) <= len(points):
        n = len(points) + (len(points) >> 1)
        for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            _powers[k] = np.cumprod(np.where(np.arange(n + 1) == 0, np.uint64(1), np.uint64(base)))
    if not len(ends):
        return np.zeros(0, np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((points[start:ends[-1]] + np.uint64(1)) * _powers[0][start:ends[-1]])])
    begin = np.concatenate([[start], ends[:-1]])
    return (total[ends - start] - total[begin - start]) * _powers[1][begin] + (ends - begin).astype(np.uint64)


def minima(hashes: np.ndarray) -> np.ndarray | None:
    """The least value of each permutation over some phrases; None of none."""
    low = None
    for i in range(0, len(hashes), WIDTH):
        x = hashes[i:i + WIDTH]
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        y = FACTORS * (x >> np.uint64(32)).astype(np.uint32)
        y += ADDENDS
        low = lower(low, y.min(axis=1))
    return low


def lower(a: np.ndarray | None, b: np.ndarray | None) -> np.ndarray | None:
    return a if b is None else b if a is None else np.minimum(a, b)


def packed(low: np.ndarray | None) -> bytes:
    """A fingerprint: one byte of each minimum; nothing of no phrases."""
    return b"" if low is None else (low & np.uint32(255)).astype(np.uint8).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """0 to 1: the estimated share of common phrases. Two fingerprints of no
    phrases are alike, one of none and another are not."""
    if not a or not b:
        return float(a == b)
    same = np.count_nonzero(np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8)) / PERMUTATIONS
    return max(0.0, (same - 1 / 256) / (1 - 1 / 256))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def fingerprint(text: str) -> bytes:
    points, known = code_points(text), {}
    parse(points.tolist(), 0, known, 0)
    return packed(minima(phrase_hashes(points.astype(np.uint64), ends_of(known))))


def both(text: str, after: str) -> tuple[bytes, bytes, str]:
    """Fingerprints of a text and of its edited text, and that text: the last
    half of the characters replaced by the first of ``after``. The half that
    both begin with is parsed once."""
    cut = len(text) - len(text) // 2
    edited = text[:cut] + after[:len(text) - cut]
    points, known = code_points(text), {}
    node = parse(points[:cut].tolist(), 0, known, 0)
    head = ends_of(known)
    shared = minima(phrase_hashes(points.astype(np.uint64), head))
    start = int(head[-1]) if len(head) else 0
    prints = []
    for whole, phrases in ((points, dict(known)), (code_points(edited), known)):
        parse(whole[cut:].tolist(), cut, phrases, node)
        prints.append(packed(lower(shared, minima(phrase_hashes(whole.astype(np.uint64), ends_of(phrases)[len(head):], start)))))
    return prints[0], prints[1], edited


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, fingerprint), one row per input row; fingerprint is
    lowercase hex. A null text is an empty one, whose fingerprint is empty.
    Repeated rows give repeated rows, a null doc_id stays null, other columns
    are ignored; an empty table gives an empty result."""
    def run(batches):
        for b in batches:
            texts = b["text"].tolist()
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_chars": [len(t) for t in texts],
                                "fingerprint": [fingerprint(t).hex() for t in texts]})
    out = docs.select(as_text("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return out.mapInPandas(run, "doc_id string, n_chars long, fingerprint string").withColumn("doc_id", as_id("doc_id"))


DONE = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
DONE_DDL = ("doc_id string, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, "
            "near_edited double, near_next double")


def _row(doc_id, text, own: bytes, edited_print: bytes, edited: str, next_print: bytes) -> tuple:
    return (doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).digest(), own, edited_print,
            likeness(own, edited_print), likeness(own, next_print))


def _stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One sorted partition: a finished row for each document but the last;
    kind 1 and 2 hold the first and the last with their texts."""
    from pyspark import TaskContext
    part = TaskContext.get().partitionId()
    rows, held, waiting, first = [], None, None, None  # held: the next text is awaited; waiting: its fingerprint

    def out(rows):
        return pd.DataFrame(rows, columns=DONE).assign(kind=0, part=part, text=None)

    for b in batches:
        for doc_id, text in zip(b["doc_id"].tolist(), b["text"].tolist()):
            if held is not None:
                found = both(held[1], text)
                first = first or (*held, found[0])
                if waiting is not None:
                    rows.append(_row(*waiting, found[0]))
                waiting = (*held, *found)
            held = (doc_id, text)
            if len(rows) >= ROWS:
                yield out(rows)
                rows = []
    if held is not None:
        last = (*held, fingerprint(held[1]))
        if waiting is not None:
            rows.append(_row(*waiting, last[2]))
        if rows:
            yield out(rows)
        for kind, (doc_id, text, own) in ((1, first or last), (2, last)):
            yield pd.DataFrame({c: [None] for c in DONE}).assign(
                doc_id=doc_id, n_chars=len(text), fingerprint=own, kind=kind, part=part, text=text)


def _edges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for doc_id, text, after, next_print in zip(b["doc_id"], b["text"], b["after"], b["next_print"]):
            rows.append(_row(doc_id, text, *both(text, after), bytes(next_print)))
        yield pd.DataFrame(rows, columns=DONE)


def edited_pairs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next), one row per input row.

    The next document is the one behind it in descending order of doc_id, null
    ids last, rows of one id in order of their text's SHA-256; after the last
    comes the first, and a single document is its own next. The texts are
    shuffled once, into this order; each partition gives up its first and last
    document, and these, two for each partition, are joined.

    A null text is an empty one, of no phrases: its fingerprint is empty, like
    another empty one and unlike any other. Repeated rows are documents of their
    own; other columns are ignored; an empty table gives an empty result. Texts
    are parsed whole, in time proportional to their length.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("tie"))
    by = [F.col("doc_id").desc_nulls_last(), F.col("tie")]
    d = d.repartitionByRange(shuffle_partitions(spark), *by).sortWithinPartitions(*by).select(as_text("doc_id"), "text")
    done = checkpoint(d.mapInPandas(_stream, DONE_DDL + ", kind int, part int, text string"))
    parts = sorted(r[0] for r in done.where("kind = 1").select("part").collect())  # one for each partition
    follows = spark.createDataFrame([(p, parts[(i + 1) % len(parts)]) for i, p in enumerate(parts)], "part int, follower int")
    firsts = done.where("kind = 1").select(F.col("part").alias("follower"), F.col("text").alias("after"), F.col("fingerprint").alias("next_print"))
    last = done.where("kind = 2").select("doc_id", "text", "part").join(F.broadcast(follows), "part").join(firsts, "follower")
    edges = last.select("doc_id", "text", "after", "next_print").mapInPandas(_edges, DONE_DDL)
    text = lambda c: F.lower(F.hex(c)).alias(c) if c in ("edited_sha256", "fingerprint", "edited_fingerprint") else F.col(c)
    return done.where("kind = 0").select(DONE).union(edges).select(*map(text, DONE)).withColumn("doc_id", as_id("doc_id"))
