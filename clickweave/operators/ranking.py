"""Quality of ranked recommendations against what users did later."""

from __future__ import annotations

from math import log2

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ranking_metrics(recs: DataFrame, truth: DataFrame, n: int = 10) -> DataFrame:
    """``user_id, relevant, hits, precision, recall, ndcg`` of the first ``n``
    recommendations, one row per user of ``truth``.

    ``recs``: ``(user_id, rank, product_id)``, rank 1 = best, a product once a
    user; ``truth``: ``(user_id, product_id)``, repeats count once, null users
    or products not at all. A user without recommendations has hits 0. NDCG
    takes a gain of 1 for each product of ``truth``, discounted by
    ``log2(rank + 1)``, over that of the best order.
    """
    wanted = truth.where("user_id is not null and product_id is not null").select("user_id", "product_id").distinct()
    hits = (recs.where(F.col("rank") <= n).select("user_id", "product_id", "rank").join(wanted, ["user_id", "product_id"])
            .groupBy("user_id").agg(F.count(F.lit(1)).alias("hits"), F.sum(1 / F.log2(F.col("rank") + 1)).alias("_gain")))
    best, ideal = 0.0, []
    for rank in range(1, n + 1):
        best += 1 / log2(rank + 1)
        ideal.append(F.lit(best))
    per_user = wanted.groupBy("user_id").agg(F.count(F.lit(1)).alias("relevant")).join(hits, "user_id", "left")
    found = F.coalesce("hits", F.lit(0).cast("long"))
    return per_user.select(
        "user_id", "relevant", found.alias("hits"), (found / n).alias("precision"), (found / F.col("relevant")).alias("recall"),
        (F.coalesce("_gain", F.lit(0.0)) / F.element_at(F.array(*ideal), F.least("relevant", F.lit(n)).cast("int"))).alias("ndcg"))


def summary(per_user: DataFrame) -> DataFrame:
    """One row: users, mean precision, recall and ndcg, and the share of users
    with a hit."""
    return per_user.agg(
        F.count(F.lit(1)).alias("users"), F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
        F.avg("ndcg").alias("ndcg"), F.avg((F.col("hits") > 0).cast("double")).alias("hit_rate"))
