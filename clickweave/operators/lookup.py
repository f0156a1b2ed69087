"""Joins of many rows with a table of unique keys where some keys are hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more than this share of the rows is looked up by broadcast; there
# are fewer than 1 / HOT_SHARE such keys, whatever the size of the tables.
HOT_SHARE = 0.001


def lookup(rows: DataFrame, table: DataFrame, key: str, share: float = HOT_SHARE, how: str = "inner") -> DataFrame:
    """Inner or left join on ``key``, which ``table`` holds at most once. Rows
    without a key find nothing.

    The rows are counted per key first (with a map-side combine). Rows of the
    hot keys meet their entry by broadcast and are not shuffled; the rest is
    shuffled, with no key above ``share`` of the rows. ``rows`` is read three
    times, so it should be a table or a checkpoint.
    """
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = rows.count()
    hot = counts.where(F.col("_n") > share * total).select(key)
    met = rows.join(F.broadcast(hot.join(table, key, how)), key)
    rest = rows.join(F.broadcast(hot), key, "left_anti").join(table, key, how)
    return met.unionByName(rest)
