"""Connected components of an undirected graph given as an edge table.

Edges are first thinned inside each partition to a spanning star (union-find
on that partition's edges only), then large-star and small-star rounds run as
joins and aggregations until the edge set stays the same. Every round is
written with ``checkpoint()``; nothing but a row count and a checksum reaches
the driver. A node with many neighbours is an aggregate with map-side combine,
and its edges are dealt out by a salt when they meet its smallest neighbour.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import checkpoint, shuffle_partitions


# Partitions that the edges of one node are dealt to.
SALTS = 16
# Nodes that a task thins at once; the stars found so far are edges like any others.
THIN_NODES = 500_000


def _thin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The edges of one partition -> (node, smallest node of its piece)."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (p := parent.get(top, top)) != top:
            top = p
        while (p := parent.get(x, x)) != top:
            parent[x] = top
            x = p
        return top

    def stars() -> Iterator[pd.DataFrame]:
        nodes = list(parent)
        for i in range(0, len(nodes), 100_000):
            part = nodes[i:i + 100_000]
            yield pd.DataFrame({"u": part, "v": [root(x) for x in part]}, dtype="int64")
        parent.clear()

    for b in batches:
        for x, y in zip(b["u"].tolist(), b["v"].tolist()):
            rx, ry = root(x), root(y)
            if rx < ry:
                parent[ry] = rx
            elif ry < rx:
                parent[rx] = ry
        if len(parent) > THIN_NODES:
            yield from stars()
    yield from stars()


def thin(edges: DataFrame) -> DataFrame:
    return edges.mapInPandas(_thin, "u long, v long")


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges``: two long columns. Returns (node, component), one row per node
    that can reach a smaller one; component is the smallest node reachable.

    Self-loops and rows with a null are left out; repeated edges count once;
    an empty edge table gives an empty result.
    """
    a, b = edges.columns[:2]
    spark = edges.sparkSession
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where("u is not null and v is not null and u <> v"))
    parts = max(2, shuffle_partitions(spark) // 16)
    e = checkpoint(thin(e.coalesce(parts)).where("u <> v"))
    seen = None
    while True:
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = state
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: every larger neighbour hangs on the smallest neighbour
        salted = both.where("v > u").withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
        low = low.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        large = salted.join(low, ["u", "salt"]).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours hang on the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("u"), F.col("m").alias("v")))).alias("s")).select("s.*")
        e = checkpoint(small.where("u <> v").distinct())
