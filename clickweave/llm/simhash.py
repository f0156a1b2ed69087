"""SimHash near-duplicates with deletion-variant signatures.

A fingerprint of 64 bits is cut into two segments of 32. If two fingerprints
differ in at most three bits, one of the segments differs in at most one. So
every distinct fingerprint is indexed under 64 keys, one for each bit: the
segment of that bit with the bit wiped out. Two fingerprints within distance
three share at least one key; equal keys are joined and the distance is
verified. Exact copies of a fingerprint are one index entry.

Keys are range-partitioned by (key, fingerprint), so a key shared by any part
of the corpus is spread over partitions. A partition links the groups that
lie inside it; groups that touch its edge, and groups of more than CHUNK
fingerprints, are handed on in chunks and linked chunk pair by chunk pair.
Groups emit a spanning forest of their links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import as_id, as_text, checkpoint, packed_groups, shuffle_partitions
from clickweave.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_DISTANCE = 3
SEED = 42
CHUNK = 2048
# Hashes that are turned into bit counts at once.
HASH_BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """The unsigned fingerprint of one whole text; 0 without words."""
    from xxhash import xxh64_digest
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    shingles = zip(*(words[i:] for i in range(shingle))) if len(words) > shingle else iter([words])
    counts, n = np.zeros(64, np.int64), 0
    while True:
        block = [xxh64_digest(b" ".join(s), SEED) for s in islice(shingles, HASH_BLOCK)]
        if not block:
            break
        bits = np.unpackbits(np.frombuffer(b"".join(block), np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
        n += len(block)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def _fingerprints(batches: Iterator[pd.DataFrame], shingle: int) -> Iterator[pd.DataFrame]:
    for b in batches:
        fp = np.array([fingerprint(t, shingle) for t in b["text"]], np.uint64).view(np.int64)
        yield pd.DataFrame({"doc_id": b["doc_id"], "fp": fp})


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp): fp holds the 64 bits as a signed long."""
    return (docs.select(as_text("doc_id"), F.col("text").cast("string"))
            .mapInPandas(partial(_fingerprints, shingle=shingle), "doc_id string, fp long")
            .select(as_id("doc_id"), "fp"))


def variants(distinct: DataFrame) -> DataFrame:
    """(fp) -> (key, fp), 64 rows for each: bit p in the upper bits of the key,
    the 32 bits of p's segment without p in the lower ones."""
    p = F.explode(F.sequence(F.lit(0), F.lit(63)))
    return distinct.select("fp", p.alias("p")).selectExpr(
        "shiftleft(cast(p as long), 32) | (shiftrightunsigned(fp, 32 * (p div 32)) & 4294967295L "
        "& ~shiftleft(1L, p % 32)) as key", "fp")


def _bits(x: np.ndarray) -> np.ndarray:
    """Bits set; of a signed number numpy would count those of its absolute value."""
    return np.bitwise_count(x.view(np.uint64))


def forest(fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links of one group, by breadth-first search:
    every step compares one reached fingerprint with those not reached yet."""
    left, right = [], []
    rest = fp
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            near = _bits(rest ^ x) <= distance
            if near.any():
                found = rest[near]
                left.append(np.full(len(found), x))
                right.append(found)
                queue.extend(found)
                rest = rest[~near]
    if not left:
        return fp[:0], fp[:0]
    return np.concatenate(left), np.concatenate(right)


def _links(fp: np.ndarray, starts: np.ndarray, ends: np.ndarray, distance: int):
    """Links of the groups [start, end): small groups all at once by offset,
    the others by their forests."""
    size = ends - starts
    small = (size > 1) & (size <= 8)
    left, right = [fp[:0]], [fp[:0]]
    s, n = starts[small], size[small]
    for i in range(7):
        for d in range(1, 8 - i):
            at = s[n > i + d] + i
            if len(at):
                ok = _bits(fp[at] ^ fp[at + d]) <= distance
                left.append(fp[at][ok])
                right.append(fp[at + d][ok])
    for a, b in zip(starts[size > 8].tolist(), ends[size > 8].tolist()):
        x, y = forest(fp[a:b], distance)
        left.append(x)
        right.append(y)
    return np.concatenate(left), np.concatenate(right)


def _scan(batches: Iterator[pd.DataFrame], distance: int, chunk: int) -> Iterator[pd.DataFrame]:
    """One range partition, sorted by (key, fp). Yields links (kind 0) and the
    rows of open groups (kind 1: key, fp, chunk number of this partition)."""
    from pyspark import TaskContext
    place = TaskContext.get().partitionId() << 32
    key, fp = np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, done, open_key = True, 0, None  # done: rows of open_key handed on so far

    def hand_on(k, rows, offset):
        at = place + (offset + np.arange(len(rows))) // chunk
        return pd.DataFrame({"kind": np.int8(1), "key": k, "fp": rows, "other": at})

    for b in batches:
        key = np.concatenate([key, b["key"].to_numpy()])
        fp = np.concatenate([fp, b["fp"].to_numpy()])
        starts, ends = packed_groups(len(key), key)
        if first and len(key):
            open_key, first = key[0], False
        lo = 0
        if open_key is not None:  # an open group goes on
            if len(key) and key[0] == open_key:
                yield hand_on(open_key, fp[:ends[0]], done)
                done += int(ends[0])
                lo = 1
            if len(starts) > lo:
                open_key = None
        if open_key is None and len(starts) > lo:
            inside = slice(lo, len(starts) - 1)
            big = (ends - starts)[inside] > chunk
            s, e = starts[inside], ends[inside]
            x, y = _links(fp, s[~big], e[~big], distance)
            yield pd.DataFrame({"kind": np.int8(0), "key": np.int64(0), "fp": x, "other": y})
            for i, j in zip(s[big].tolist(), e[big].tolist()):
                yield hand_on(key[i], fp[i:j], 0)
            tail = starts[-1]
            key, fp = key[tail:], fp[tail:]
            if len(key) > chunk:
                open_key, done = key[0], len(key)
                yield hand_on(open_key, fp, 0)
                key, fp = key[:0], fp[:0]
        else:
            key, fp = key[:0], fp[:0]
    if len(key):  # the last group of the partition
        yield hand_on(key[0], fp, 0)


def _pair_links(batches: Iterator[pd.DataFrame], distance: int) -> Iterator[pd.DataFrame]:
    """Rows sorted by (key, ci, cj): links of each chunk pair."""
    cols = ["key", "ci", "cj"]
    rest = None
    for b in batches:
        b = b if rest is None else pd.concat([rest, b], ignore_index=True)
        k = b[cols].to_numpy()
        same = (k[1:] == k[:-1]).all(axis=1)
        starts, ends = packed_groups(len(b), np.concatenate([[0], np.cumsum(~same)]) if len(b) else k[:, 0])
        x, y = _links(b["fp"].to_numpy(), starts[:-1], ends[:-1], distance)
        yield pd.DataFrame({"u": x, "v": y})
        rest = b.iloc[starts[-1]:] if len(b) else None
    if rest is not None and len(rest):
        x, y = _links(rest["fp"].to_numpy(), np.array([0]), np.array([len(rest)]), distance)
        yield pd.DataFrame({"u": x, "v": y})


def links(distinct: DataFrame, distance: int = MAX_DISTANCE, chunk: int = CHUNK) -> DataFrame:
    """Links (u, v) that connect every two distinct fingerprints within
    ``distance`` (at most 3) directly or through others within it."""
    if not 0 <= distance <= MAX_DISTANCE:
        raise ValueError("two segments with one free bit cover a distance of 3 at most")
    v = variants(distinct)
    v = (v.repartitionByRange(shuffle_partitions(distinct.sparkSession), "key", "fp")
         .sortWithinPartitions("key", "fp"))
    out = checkpoint(v.mapInPandas(partial(_scan, distance=distance, chunk=chunk),
                                   "kind byte, key long, fp long, other long"))
    inside = out.where("kind = 0").select(F.col("fp").alias("u"), F.col("other").alias("v"))
    opened = out.where("kind = 1").select("key", "fp", F.col("other").alias("c"))
    # chunks of one key, paired; a key with one single-row chunk has no link
    chunks = opened.groupBy("key", "c").agg(F.count("*").alias("n"))
    pairs = (chunks.select("key", F.col("c").alias("ci"), F.col("n").alias("ni"))
             .join(chunks.select("key", F.col("c").alias("cj"), F.col("n").alias("nj")), "key")
             .where("ci < cj or (ci = cj and ni > 1)")
             .select("key", "ci", "cj", F.explode(F.array_distinct(F.array("ci", "cj"))).alias("c")))
    met = (opened.join(pairs, ["key", "c"]).select("key", "ci", "cj", "fp")
           .repartition("key", "ci", "cj").sortWithinPartitions("key", "ci", "cj"))
    return inside.union(met.mapInPandas(partial(_pair_links, distance=distance), "u long, v long"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """(doc_id, fp, fingerprint, component_id), one row per input row.

    Words are the runs of characters other than ASCII white space, A-Z
    lower-cased; a text with fewer words than a shingle is one shingle; a null,
    empty or blank text has fingerprint 0 and links like any other.
    ``component_id`` is the smallest doc_id reachable over fingerprints that
    differ in at most ``distance`` bits. Rows with a null doc_id take part and
    never are the smallest; a component of such rows alone has a null id.
    Repeated rows give repeated rows; other columns of ``docs`` are ignored;
    an empty table gives an empty result.
    """
    fps = checkpoint(fingerprints(docs, shingle))
    distinct = checkpoint(fps.groupBy("fp").agg(F.min("doc_id").alias("low")))
    comp = connected_components(links(distinct.select("fp"), distance))
    rooted = distinct.join(comp.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    label = rooted.join(lowest, "root").select("fp", "component_id")
    return fps.join(label, "fp").select(
        "doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """The rows of ``docs`` that stand for their group: those whose doc_id is
    the component's smallest. Rows of one doc_id are one document: repeated
    rows stay or go together, and an id whose rows have different texts goes
    only if every one of them has a smaller id in its group. Rows of a null
    doc_id stay (they can't be named as copies of anything)."""
    gone = (near_duplicates(docs, shingle, distance).groupBy("doc_id")
            .agg(F.bool_and(F.col("doc_id") != F.col("component_id")).alias("gone")).where("gone").select("doc_id"))
    return docs.join(gone, "doc_id", "left_anti")
