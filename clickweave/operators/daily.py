"""Aggregates kept per day and put together, instead of computed over all days.

* Interaction scores over a moving range of days (C1): the scores of a day are
  added when it enters the range and subtracted when it leaves, so a step reads
  two days and the last result, whatever the width of the range.
* Distinct counts (C2-C5): the values seen by a key on a day are bits of words
  (64 values each) over a dictionary of the values. Only words with a bit set are
  kept, so a key takes no more room than its values. Days are put together by
  ``or``, so counts stay exact, and a new day touches no old one. A dictionary
  only grows: new values get the indexes behind the old ones.

All of these are aggregates with a map-side combine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import action_weight, count_if_action, event_date, safe_ratio
from ..session import checkpoint
from .lookup import lookup
from .recommend import fit_labels


# --- C1 over a moving range of days ------------------------------------------


def day_scores(events: DataFrame) -> DataFrame:
    """``event_date, user_id, product_id, score, n`` per day: the sum of the
    action weights and the number of events."""
    return events.groupBy(event_date("timestamp").alias("event_date"), "user_id", "product_id").agg(
        F.sum(action_weight("action_type")).alias("score"), F.count(F.lit(1)).alias("n"))


def slide(window: DataFrame | None, entering: DataFrame, leaving: DataFrame | None) -> DataFrame:
    """``user_id, product_id, score, n`` of the range one day on. Pairs without
    an event left go; the weights are whole numbers, so nothing else is left of
    them than zero."""
    cols = ["user_id", "product_id", "score", "n"]
    rows = entering.select(cols)
    if leaving is not None:
        rows = rows.unionByName(leaving.select("user_id", "product_id", (-F.col("score")).alias("score"), (-F.col("n")).alias("n")))
    if window is not None:
        rows = rows.unionByName(window.select(cols))
    return rows.groupBy("user_id", "product_id").agg(F.sum("score").alias("score"), F.sum("n").alias("n")).where("n > 0")


# --- distinct counts by bitmaps ----------------------------------------------

WORD = 64  # values to a row of bits, a long


def extend_labels(known: DataFrame | None, events: DataFrame, col: str) -> DataFrame:
    """The dictionary ``(label, idx)`` with the values of ``col`` that it lacks
    behind its own."""
    if known is None:
        return fit_labels(events, col)
    new = fit_labels(events.select(col).join(known.select(F.col("label").alias(col)), col, "left_anti"), col)
    behind = known.agg((F.coalesce(F.max("idx"), F.lit(-1)) + 1).alias("behind")).first()[0]
    return known.unionByName(new.select("label", (F.col("idx") + behind).cast("int").alias("idx")))


def day_sets(events: DataFrame, keys: list[str], col: str, labels: DataFrame) -> DataFrame:
    """``event_date, <keys>, bucket, bits``: which values of ``col`` a key had on
    a day, as bits of their dictionary index; nulls are no value."""
    rows = events.where(F.col(col).isNotNull()).select(event_date("timestamp").alias("event_date"), *keys, F.col(col).alias("label")).distinct()
    return lookup(checkpoint(rows), labels, "label").groupBy("event_date", *keys, F.expr(f"idx div {WORD}").alias("bucket")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, CAST(idx % {WORD} AS INT))")).alias("bits"))


def distinct_counts(sets: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``<keys>, name``: exact numbers of distinct values over the days given."""
    whole = sets.groupBy(*keys, "bucket").agg(F.bit_or("bits").alias("bits"))
    return whole.groupBy(*keys).agg(F.sum(F.bit_count("bits")).alias(name))


def day_users(events: DataFrame) -> DataFrame:
    """What adds up over days of the user features."""
    price = F.col("product_price").cast("double")
    return events.groupBy(event_date("timestamp").alias("event_date"), "user_id").agg(
        F.count(F.lit(1)).alias("total_events"), F.sum(price).alias("price_sum"), F.count(price).alias("priced"),
        F.sum(count_if_action("purchase")).alias("purchase_count"), F.sum(count_if_action("add_to_cart")).alias("cart_additions"),
        F.max("timestamp").alias("last_activity"))


def users_over_days(days: DataFrame, sets: dict[str, DataFrame]) -> DataFrame:
    """The user features (C2, C3) of all days given. ``sets``: output column ->
    ``day_sets`` with the key ``user_id``."""
    out = days.groupBy("user_id").agg(
        F.sum("total_events").alias("total_events"), F.sum("price_sum").alias("_sum"), F.sum("priced").alias("_n"),
        F.sum("purchase_count").alias("purchase_count"), F.sum("cart_additions").alias("cart_additions"), F.max("last_activity").alias("last_activity"))
    for name, s in sets.items():
        counts = distinct_counts(s, ["user_id"], name)
        out = out.join(counts.withColumnRenamed("user_id", "_u"), F.col("user_id").eqNullSafe(F.col("_u")), "left").drop("_u") \
            .withColumn(name, F.coalesce(name, F.lit(0).cast("long")))
    return out.select(
        "user_id", "total_events", *sets, safe_ratio("_sum", "_n").alias("avg_price_interest"), "purchase_count", "cart_additions",
        "last_activity", safe_ratio("purchase_count", "total_events").alias("conversion_rate"),
        safe_ratio("purchase_count", F.when(F.col("cart_additions") > 0, F.col("cart_additions")).otherwise(1)).alias("cart_conversion_rate"))
