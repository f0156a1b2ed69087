"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from clickweave.session import checkpoint  # noqa: F401  (re-exported to the operators)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(col: str, mod: int) -> Column:
    """crc32 of the id's decimal text modulo ``mod``; null for a null id."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % mod


def as_text(col: str) -> Column:
    """A long id as text, null kept: pandas would turn the ids of a batch with a
    null into floats, which are inexact from 2**53 on."""
    return F.col(col).cast("long").cast("string").alias(col)


def as_id(col: str) -> Column:
    """The id back from its text."""
    return F.col(col).cast("long").alias(col)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else. ``lower`` does the same, much faster,
    where every character is one byte."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.char_length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, upper.lower()))


def key128(*cols: Column) -> Column:
    """A struct of two 64-bit hashes that stands for the given values."""
    return F.struct(F.xxhash64(F.lit(1), *cols).alias("a"), F.xxhash64(F.lit(2), *cols).alias("b"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bounded_sample(df: DataFrame, label: str, ident: list[str], per_label: int, labels: list | None = None) -> DataFrame:
    """At most ``per_label`` rows of every label (or of those in ``labels``), with
    ``rows_``, the number of rows that the label has: the rows with the smallest
    hash of ``ident``, the same ones on every run, whatever the partitioning. A
    label with fewer rows keeps them all, and none goes without.

    Twice as many distinct hashes as wanted are let through on their value, then
    the rows of each label are cut by rank, partition by partition first."""
    if labels is not None:
        df = df.where(F.col(label).isin(labels))
    df = df.where(F.col(label).isNotNull()).withColumn("h_", F.xxhash64(F.lit(7), *ident))
    counts = df.groupBy(label, "h_").agg(F.count("*").alias("k")).groupBy(F.col(label).alias("l_")).agg(
        F.count("*").alias("distinct_"), F.sum("k").alias("rows_"))
    # 53 bits of the hash as a fraction of one
    u = F.shiftrightunsigned("h_", 11) / F.lit(float(1 << 53))
    some = df.join(F.broadcast(counts), F.col(label) == F.col("l_")).where(u * F.col("distinct_") < 2.0 * per_label)
    rank = F.row_number().over(Window.partitionBy(label).orderBy("h_"))
    return some.withColumn("rank_", rank).where(F.col("rank_") <= per_label).drop("h_", "l_", "distinct_", "rank_")


def packed_groups(n: int, keys):
    """[(start, end)] of the runs of equal neighbours in a sorted numpy key array."""
    import numpy as np
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return np.concatenate([[0], cut]), np.concatenate([cut, [n]])


def levels(n: int, fanout: int) -> int:
    """Levels of a tree of this fan-out over n leaves (at least one)."""
    return max(1, math.ceil(math.log(max(n, 2), fanout) - 1e-9))
