"""Recommender: id dictionaries, ALS fit, top-N scoring and decoding
(C12, E1-E3, F2, F3, G1-G6).

Dictionaries
------------
ALS needs integer ids. ``StringIndexer`` would collect every label to the
driver; here the dictionary is a DataFrame ``(label, idx)`` built with a
distributed sort: labels by frequency desc, label asc (the order of
``StringIndexer(stringOrderType="frequencyDesc")``), and the global position
is a per-partition offset (one row per sort partition, broadcast) plus the
position inside the partition. Encoding and decoding are joins against that
table, so nothing grows on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint
from .lookup import lookup
from .topn import top_n

_POS_BITS = 33  # monotonically_increasing_id: partition id << 33 | row position


def index_labels(counts: DataFrame, label: str = "label", freq: str = "freq") -> DataFrame:
    """``(label, idx)``: 0-based rank by ``freq`` desc, ``label`` asc."""
    ordered = counts.orderBy(F.col(freq).desc(), F.col(label).asc()) \
        .select(label, F.monotonically_increasing_id().alias("_mid"))
    ordered = ordered.select(label, F.shiftright("_mid", _POS_BITS).alias("_part"),
                             F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1)).alias("_pos"))
    # The positions are read twice (sizes and join); a second sort could cut
    # different range boundaries, so they are materialised once.
    ordered = checkpoint(ordered)
    sizes = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per sort partition: a bounded table, safe to broadcast
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (ordered.join(F.broadcast(offsets), "_part")
            .select(F.col(label).alias("label"), (F.col("_off") + F.col("_pos")).cast("int").alias("idx")))


def fit_labels(df: DataFrame, col: str) -> DataFrame:
    """Label dictionary of ``col`` (C12, F3): ``(label, idx)``, nulls skipped;
    frequency = number of rows of ``df`` carrying the label."""
    counts = (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("label"))
              .agg(F.count(F.lit(1)).alias("freq")))
    return index_labels(counts)


@dataclass
class Dictionaries:
    """User and product dictionaries (G1)."""
    users: DataFrame
    products: DataFrame


def fit_indexers(interactions: DataFrame, user_col: str = "user_id",
                 item_col: str = "product_id") -> Dictionaries:
    return Dictionaries(fit_labels(interactions, user_col), fit_labels(interactions, item_col))


def encode(interactions: DataFrame, dicts: Dictionaries, user_col: str = "user_id",
           item_col: str = "product_id") -> DataFrame:
    """Add ``user_idx`` and ``product_idx``; unknown or null ids are dropped
    (E3, G2: ``handleInvalid="skip"``)."""
    users = dicts.users.select(F.col("label").alias(user_col), F.col("idx").alias("user_idx"))
    items = dicts.products.select(F.col("label").alias(item_col), F.col("idx").alias("product_idx"))
    return interactions.join(users, user_col, "inner").join(items, item_col, "inner")


def fit_als(encoded: DataFrame, rank: int = 10, max_iter: int = 10, reg: float = 0.1,
            nonnegative: bool = True, implicit: bool = False, seed: int = 42,
            rating_col: str = "interaction_strength", blocks: int | None = None) -> ALSModel:
    """ALS factor model (G3); cold-start predictions are dropped. Lineage is
    cut every ``checkpointInterval`` iterations into the session's
    checkpoint folder. ``blocks`` is the number of user and of item blocks,
    and so of training tasks; it follows ``spark.sql.shuffle.partitions``, at
    a sixteenth, as every pair of blocks exchanges factors."""
    blocks = blocks or max(8, int(encoded.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 16)
    als = ALS(userCol="user_idx", itemCol="product_idx", ratingCol=rating_col,
              coldStartStrategy="drop", rank=rank, maxIter=max_iter, regParam=reg,
              nonnegative=nonnegative, implicitPrefs=implicit, seed=seed,
              numUserBlocks=blocks, numItemBlocks=blocks)
    return als.fit(encoded)


def decode_ranked(flat: DataFrame, dicts: Dictionaries) -> DataFrame:
    """``(user_idx, rank, product_idx, rating)`` -> ``user_id, rank,
    product_id, rating`` (G5, E1). A product that is recommended to many users
    is looked up without a shuffle of their rows."""
    users = dicts.users.select(F.col("idx").alias("user_idx"), F.col("label").alias("user_id"))
    items = dicts.products.select(F.col("idx").alias("product_idx"), F.col("label").alias("product_id"))
    return (lookup(checkpoint(flat), items, "product_idx").join(users, "user_idx", "inner")
            .select("user_id", "rank", "product_id", "rating"))


def _decode(recs: DataFrame, dicts: Dictionaries) -> DataFrame:
    """``(user_idx, recommendations)`` -> ``user_id, rank, product_id,
    rating`` (B17: array explode); ``rank`` 1 = best."""
    flat = recs.select("user_idx", F.posexplode("recommendations").alias("_pos", "rec"))
    return decode_ranked(flat.select("user_idx", (F.col("_pos") + 1).alias("rank"), F.col("rec.product_idx").alias("product_idx"),
                                     F.col("rec.rating").cast("double").alias("rating")), dicts)


def _scored(users: DataFrame, model: ALSModel, dicts: Dictionaries, n: int) -> DataFrame:
    best, _ = top_n(users, model.itemFactors, n)
    return decode_ranked(best.select(F.col("user").cast("int").alias("user_idx"), "rank",
                                     F.col("item").cast("int").alias("product_idx"), F.col("score").alias("rating")), dicts)


def recommend(model: ALSModel, dicts: Dictionaries, users: DataFrame, n: int = 10,
              user_col: str = "user_id") -> DataFrame:
    """Top-``n`` products for the users in ``users[user_col]`` (G4, E2, F2);
    unknown users get no rows. Exact (``operators.topn``)."""
    wanted = (users.select(F.col(user_col).alias("label")).distinct()
              .join(dicts.users, "label", "inner").select(F.col("idx").alias("id")))
    return _scored(model.userFactors.join(wanted, "id", "left_semi"), model, dicts, n)


def recommend_all(model: ALSModel, dicts: Dictionaries, n: int = 10) -> DataFrame:
    """Top-``n`` products for every known user, as a table."""
    return _scored(model.userFactors, model, dicts, n)
