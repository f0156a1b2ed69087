"""Exact top-N products by inner product, without scoring every pair.

Products are ranked by the length of their factor vector and cut into blocks
of ``BLOCK_ITEMS``. A product's score for a user is at most the product of the
two lengths (Cauchy-Schwarz), so once the user's N-th best score so far is
above what the longest vector of a block allows, neither that block nor any
later one can matter. Users visit the blocks in waves of doubling size; after
each wave the scores found are cut to N a user, and users who are done leave.

In a wave every user left meets every block of it. Blocks and users are
shuffled on (block, group): a group is about ``GROUP_USERS`` users, and a block
is sent once to each group, so a task holds one block and one group whatever
the number of users. numpy scores a block for a slice of users at a time and
gives back N rows a user. Nothing is sent to the driver but a few numbers per
wave (the number of waves is the logarithm of the number of blocks).
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint

log = logging.getLogger(__name__)

BLOCK_ITEMS = 4096
GROUP_USERS = 16_384
# Users scored at a time: SLICE_USERS x BLOCK_ITEMS doubles.
SLICE_USERS = 512
FOUND = "user long, item long, score double"
_NONE = pd.DataFrame({"user": [], "item": [], "score": []}).astype({"user": "int64", "item": "int64", "score": "float64"})


@dataclass
class Visits:
    """Pairs of a user and a block that were scored, of all there are."""
    scored: int = 0
    total: int = 0
    waves: list = field(default_factory=list)  # (first block, block behind the last, users)

    @property
    def share(self) -> float:
        return self.scored / self.total if self.total else 0.0


def _vectors(factors: DataFrame, ident: str, name: str) -> DataFrame:
    """(name, features as doubles, length); null ids or vectors have no row."""
    f = factors.where(F.col(ident).isNotNull() & F.col("features").isNotNull()).select(
        F.col(ident).cast("long").alias(name), F.col("features").cast("array<double>").alias("features"))
    return f.withColumn("length", F.sqrt(F.aggregate("features", F.lit(0.0), lambda a, x: a + x * x)))


def _blocks(items: DataFrame, block_items: int) -> DataFrame:
    """(item, features, block): blocks of neighbours in descending length."""
    from .recommend import index_labels
    ranks = index_labels(items, "item", "length").select(F.col("label").alias("item"), "idx")
    return items.join(ranks, "item").select("item", "features", "length", F.expr(f"idx div {block_items}").alias("block"))


def _best(users: pd.DataFrame, items: pd.DataFrame, n: int) -> pd.DataFrame:
    """The n best items of one block for each user; equal scores by item."""
    if not len(users) or not len(items):
        return _NONE
    items = items.sort_values("item")
    ids, vectors = items["item"].to_numpy(), np.stack(items["features"].to_numpy())
    longest = float(np.sqrt((vectors * vectors).sum(axis=1)).max())
    out = []
    users = users[users["length"].to_numpy() * longest * (1 + 1e-9) >= users["worst"].to_numpy()]
    k = min(n, len(ids))
    for i in range(0, len(users), SLICE_USERS):
        u = users.iloc[i:i + SLICE_USERS]
        # a sum per pair in the same order for every block size, so that ties stay ties
        low = -np.einsum("ij,kj->ik", np.stack(u["features"].to_numpy()), vectors)
        limit = np.partition(low, k - 1, axis=1)[:, k - 1:k] if k < len(ids) else np.full((len(u), 1), np.inf)
        limit = np.minimum(limit, -u["worst"].to_numpy()[:, None])
        who, what = np.nonzero(low <= limit)
        score = low[who, what]
        order = np.lexsort((what, score, who))
        who, what, score = who[order], what[order], score[order]
        first = np.searchsorted(who, who)  # ties at the limit: keep n
        keep = np.arange(len(who)) - first < k
        out.append(pd.DataFrame({"user": u["user"].to_numpy()[who[keep]], "item": ids[what[keep]], "score": -score[keep]}))
    return pd.concat(out) if out else _NONE


def _cut(found: DataFrame, n: int) -> DataFrame:
    w = Window.partitionBy("user").orderBy(F.col("score").desc(), F.col("item").asc())
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def top_n(user_factors: DataFrame, item_factors: DataFrame, n: int = 10, ident: str = "id",
          block_items: int = BLOCK_ITEMS, group_users: int = GROUP_USERS) -> tuple[DataFrame, Visits]:
    """``(user, rank, item, score)``: the ``n`` items with the largest inner
    product for every user, equal scores in order of item, rank 1 = best; and
    how many pairs of user and block that took.

    Both inputs are ``(ident, features)`` with vectors of one length and ids
    that occur once. Fewer than ``n`` items give fewer rows. A user whose vector
    is zero scores 0 with every item and gets the items with the smallest ids.
    """
    spark = user_factors.sparkSession
    users = checkpoint(_vectors(user_factors, ident, "user"))
    items = checkpoint(_vectors(item_factors, ident, "item"))
    n_blocks = -(-items.count() // block_items)
    # a single block has no order
    items = checkpoint(_blocks(items, block_items)) if n_blocks > 1 else items.withColumn("block", F.lit(0).cast("long"))
    visits = Visits(total=users.count() * n_blocks)
    found = spark.createDataFrame([], FOUND)
    if not n_blocks or n < 1:
        return found.withColumn("rank", F.lit(1)).select("user", "rank", "item", "score"), visits
    first = items.orderBy("item").limit(n).select("item")  # n rows
    smallest = F.array(*[F.lit(r["item"]).cast("long") for r in first.collect()])
    zero = users.where("length = 0").select("user", F.explode(smallest).alias("item"), F.lit(0.0).alias("score"))
    users = users.where("length > 0").withColumn("worst", F.lit(float("-inf")))
    lo, hi = 0, 1
    while lo < n_blocks:
        wave = items.where((F.col("block") >= lo) & (F.col("block") < hi))
        longest = wave.agg(F.max("length")).first()[0]
        users = checkpoint(users.where(F.col("length") * longest * (1 + 1e-9) >= F.col("worst")))
        left = users.count()
        if not left:
            break
        hi = min(hi, n_blocks)
        visits.scored += left * (hi - lo)
        visits.waves.append((lo, hi, left))
        groups = -(-left // group_users)
        u = users.withColumn("grp", F.pmod(F.xxhash64("user"), F.lit(groups)).cast("int")) \
            .withColumn("block", F.explode(F.sequence(F.lit(lo).cast("long"), F.lit(hi - 1).cast("long"))))
        i = wave.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).select("block", "grp", "item", "features")
        scored = u.groupBy("block", "grp").cogroup(i.groupBy("block", "grp")).applyInPandas(lambda a, b: _best(a, b, n), FOUND)
        found = checkpoint(_cut(found.union(scored), n).select("user", "item", "score"))
        worst = found.groupBy("user").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low")).where(F.col("n") >= n)
        users = users.drop("worst").join(worst.select("user", F.col("low").alias("worst")), "user", "left") \
            .withColumn("worst", F.coalesce("worst", F.lit(float("-inf"))))
        lo, hi = hi, 2 * hi
    log.info("top %d: %.1f %% of the user and block pairs scored, waves %s", n, 100 * visits.share, visits.waves)
    out = _cut(found.union(zero), n)
    return out.select("user", F.col("rank").cast("int").alias("rank"), "item", "score"), visits
