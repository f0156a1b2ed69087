"""Quality selection by importance resampling.

Texts are bags of hashed word unigrams and bigrams. Two bag-of-n-grams models
are counted: one of the target texts (labelled good), one of all raw texts.
A text's weight is the log ratio of its probabilities under the two. Gumbel
noise, fixed by a hash of the document, is added to the log weights, and the
k documents with the largest sums are a sample without replacement in
proportion to the weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import as_id, as_text, checkpoint, shuffle_partitions

BUCKETS = 1 << 14
FRACTION = 0.5  # of the documents is sampled
SMOOTHING = 1.0  # added to every bucket's count
BLOCK_BYTES = 1 << 20
# Ids of target documents are broadcast up to this many (counted first); beyond it
# the texts are shuffled to them.
BROADCAST_ROWS = 1_000_000
# An odd multiplier of the rolling hash, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MIX = np.uint64(0xFF51AFD7ED558CCD)


class Hasher:
    """Buckets of all word unigrams and bigrams of a block of texts. A word is
    hashed by its bytes (A-Z lower-cased) with a polynomial whose prefix sums
    give all words of the block at once."""

    def __init__(self):
        self.powers = [np.ones(1, np.uint64)] * 2

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(buckets, text number of each)."""
        size = np.array([len(t) + 1 for t in texts], np.int64)
        raw = np.frombuffer(b"\n".join(texts).lower() + b"\n", np.uint8)
        n = len(raw)
        if len(self.powers[0]) < n + 1:
            self.powers = [np.cumprod(np.where(np.arange(n + (n >> 3) + 1) == 0, np.uint64(1), np.uint64(r))) for r in (BASE, INVERSE)]
        word = ~((raw == 32) | (raw >= 9) & (raw <= 13))
        edge = np.diff(np.concatenate([[0], word.astype(np.int8)]))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.powers[0][:n])])
        h = (total[end] - total[start]) * self.powers[1][start] + (end - start).astype(np.uint64)
        h = (h ^ (h >> np.uint64(33))) * MIX
        of = np.searchsorted(np.cumsum(size), start, "right")
        pair = (of[1:] == of[:-1]) if len(of) else np.zeros(0, bool)
        two = ((h[:-1] * np.uint64(31) + h[1:]) ^ (h[1:] >> np.uint64(29)))[pair] * MIX if len(h) else h
        shift = np.uint64(64 - BUCKETS.bit_length() + 1)
        return (np.concatenate([h, two]) >> shift).astype(np.int64), np.concatenate([of, of[:-1][pair]] if len(of) else [of])


def _blocks(b: pd.DataFrame) -> Iterator[tuple[int, int, list[bytes]]]:
    lo, size, out = 0, 0, []
    for i, t in enumerate(b["text"]):
        raw = (t or "").encode("utf-8", "surrogatepass")
        if out and size + len(raw) > BLOCK_BYTES:
            yield lo, i, out
            lo, size, out = i, 0, []
        out.append(raw)
        size += len(raw)
    if out:
        yield lo, lo + len(out), out


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashed, raw, target = Hasher(), np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for b in batches:
        good = b["good"].to_numpy(bool)
        for lo, hi, texts in _blocks(b):
            bucket, of = hashed(texts)
            raw += np.bincount(bucket, minlength=BUCKETS)
            target += np.bincount(bucket[good[lo:hi][of]], minlength=BUCKETS)
    yield pd.DataFrame({"bucket": np.arange(BUCKETS), "raw": raw, "target": target})


def log_ratio(docs: DataFrame) -> np.ndarray:
    """docs: (text, good). log(target share / raw share) of each bucket, counted
    over all texts; BUCKETS rows reach the driver. Zeros without a target."""
    rows = docs.mapInPandas(_count, "bucket int, raw long, target long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()
    n = np.zeros((2, BUCKETS))
    for b, raw, target in rows:
        n[:, b] = raw, target
    if not n[1].any():
        return np.zeros(BUCKETS)
    p = (n + SMOOTHING) / (n + SMOOTHING).sum(axis=1, keepdims=True)
    return np.log(p[1]) - np.log(p[0])


def _weigh(batches: Iterator[pd.DataFrame], ratio) -> Iterator[pd.DataFrame]:
    hashed, ratio = Hasher(), ratio.value
    for b in batches:
        weight, n = np.zeros(len(b)), np.zeros(len(b), np.int64)
        for lo, hi, texts in _blocks(b):
            bucket, of = hashed(texts)
            weight[lo:hi] = np.bincount(of, ratio[bucket], hi - lo)
            n[lo:hi] = np.bincount(of, minlength=hi - lo)
        yield pd.DataFrame({"doc_id": b["doc_id"], "twin": b["twin"], "n_features": n, "log_weight": weight})


def top_k(df: DataFrame, key: str, ties: list[str], k: int) -> DataFrame:
    """Adds ``selected``: whether a row is among the k largest of ``key`` (ties by
    ``ties``, so equal rows are chosen as they fall). Sorted ranges count their
    rows; only the range that the k-th row falls into is numbered, by parts."""
    spark = df.sparkSession
    order = [F.desc(key), *ties]
    ranged = df.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    placed = checkpoint(ranged.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")))
    before, offsets = 0, []
    for part, n in placed.groupBy("part").agg(F.count("*")).orderBy("part").collect():
        offsets.append((part, before))
        before += n
    if not offsets:
        return placed.drop("part", "at").withColumn("selected", F.lit(False))
    known = spark.createDataFrame(offsets, "part int, before long")  # a row for each partition
    rank = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)
    return placed.join(F.broadcast(known), "part").withColumn("selected", rank < k).drop("part", "at", "before")


def resample(docs: DataFrame, labels: DataFrame, fraction: float = FRACTION) -> DataFrame:
    """(doc_id, n_features, log_weight, gumbel_key, selected), one row per input row.

    Target texts are those of documents labelled quality = 1 (and never 0).
    The selected rows are the ceil(fraction * rows) largest of log_weight plus
    Gumbel noise, made of a hash of doc_id (rows of one doc_id share it); ties
    go by doc_id, equal rows as they come. A null or empty text has no n-grams and a
    weight of 0. Without target texts all weights are 0, a plain random
    sample. Rows of a null doc_id are weighed like any other. Other columns
    are ignored; an empty table gives an empty result.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("q")).where("q in (0, 1)")
    good = y.groupBy("doc_id").agg(F.min("q").alias("q")).where("q = 1").select("doc_id", F.lit(True).alias("good"))
    if good.count() <= BROADCAST_ROWS:
        good = F.broadcast(good)
    ratio = log_ratio(d.join(good, "doc_id", "left").select("text", F.coalesce("good", F.lit(False)).alias("good")))
    twin = F.monotonically_increasing_id()
    weighed = d.select(as_text("doc_id"), "text", twin.alias("twin")).mapInPandas(
        partial(_weigh, ratio=docs.sparkSession.sparkContext.broadcast(ratio)),
        "doc_id string, twin long, n_features long, log_weight double").withColumn("doc_id", as_id("doc_id"))
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(17), F.coalesce("doc_id", "twin")), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    keyed = checkpoint(weighed.withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(u))))
    k = keyed.count()
    k = -int(-k * fraction // 1)
    return top_k(keyed, "gumbel_key", ["doc_id", "twin"], k).select("doc_id", "n_features", "log_weight", "gumbel_key", "selected")
