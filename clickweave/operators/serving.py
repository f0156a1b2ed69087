"""Serving summaries (C6-C11), re-aimed from a keyed store to tables.

Each summary is what a key-value store would hold for a key after the
events were written to it one by one: recent behaviours of a user (newest
first, trimmed), counters per category / price band / action, and a session
record. With ``ttl_seconds`` the key expires that long after its last write
and restarts from zero, so only the events of the key's newest run count
(``operators.runs``); ``as_of`` additionally drops keys already expired at
that time. ``ttl_seconds=None`` summarises the whole history.

All summaries are partial-aggregated before their shuffle or use a
per-group limit (``row_number() <= n`` becomes a map-side top-n), so a hot
user contributes a bounded number of rows to any one task. Runs are found
on one row per (key, second) (``operators.runs``); counters join their
per-second counts to them on (key, second), and the newest behaviours are
the key's newest ``n`` overall that fall in its newest run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import behavior_json, format_time, price_band, serving_key
from ..schema import (RECENT_BEHAVIORS_KEEP, TTL_ACTION_COUNTS, TTL_CATEGORY_INTERESTS,
                      TTL_PRICE_PREFERENCES, TTL_RECENT_BEHAVIORS, TTL_SESSION)
from .runs import per_second_runs, second_of, second_runs, ttl_interval

REQUIRED_FOR_SERVING = ["user_id", "session_id", "action_type", "product_category",
                        "product_price", "timestamp"]


def tag_storable(events: DataFrame) -> DataFrame:
    """``events`` + ``reason``: the first missing field that keeps the row
    out of the serving tables, NULL for a storable row (C11, one pass)."""
    reason = F.lit(None).cast("string")
    for c in reversed(REQUIRED_FOR_SERVING):
        reason = F.when(F.col(c).isNull(), F.lit(f"missing {c}")).otherwise(reason)
    return events.withColumn("reason", reason)


def split_storable(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(storable rows, quarantined rows + ``reason``) (C11).

    A row can be stored only with a user, session, action, category, price
    and time; the quarantine keeps the others with the first missing field.
    """
    tagged = tag_storable(events)
    good = tagged.where(F.col("reason").isNull()).drop("reason")
    bad = tagged.where(F.col("reason").isNotNull())
    return good, bad


def _newest_run(summary: DataFrame, key: str, ttl_seconds: int | None, as_of,
                last_col: str = "_last") -> DataFrame:
    """Keep the rows of each key's newest run of an already aggregated
    summary (small: a bounded number of rows per key and run), and drop keys
    that have expired at ``as_of``."""
    if ttl_seconds is None:
        return summary
    w = Window.partitionBy(key)
    out = (summary.withColumn("_newest", F.max("run_start").over(w))
           .withColumn("_key_last", F.max(last_col).over(w))
           .where(F.col("run_start") == F.col("_newest")))
    if as_of is not None:
        out = out.where(F.lit(as_of).cast("timestamp") < F.col("_key_last") + ttl_interval(ttl_seconds))
    return out.drop("_newest", "_key_last")


def recent_behaviors(events: DataFrame, n: int = RECENT_BEHAVIORS_KEEP,
                     ttl_seconds: int | None = TTL_RECENT_BEHAVIORS, as_of=None,
                     tie_break: str | None = None, keep_time: bool = False) -> DataFrame:
    """Newest ``n`` behaviours per user, rank 1 = newest.

    Output ``user_id, rank, product_id, action_type, category, price,
    timestamp`` (text) and ``behavior_json``; ``_ts``, the exact time, with
    ``keep_time``.
    """
    order = [F.col("timestamp").desc()] + ([F.col(tie_break).desc()] if tie_break else [])
    # newest n overall (a per-group limit, applied map-side before the shuffle)
    w = Window.partitionBy("user_id").orderBy(*order)
    top = events.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    if keep_time:
        top = top.withColumn("_ts", F.col("timestamp"))
    if ttl_seconds is not None:
        # the newest run holds the key's newest events: keep the top rows at
        # or after its start; ranks stay as they are
        runs = second_runs(events, "user_id", ttl_seconds).groupBy("user_id").agg(
            F.max("run_start").alias("_newest"), F.timestamp_micros(F.max("_lastu")).alias("_key_last"))
        top = top.join(runs, "user_id", "inner").where(F.col("timestamp") >= F.col("_newest"))
        if as_of is not None:
            top = top.where(F.lit(as_of).cast("timestamp") < F.col("_key_last") + ttl_interval(ttl_seconds))
    return top.select(
        "user_id", "rank", "product_id", "action_type",
        F.col("product_category").alias("category"),
        F.col("product_price").cast("double").alias("price"),
        format_time("timestamp").alias("timestamp"),
        behavior_json().alias("behavior_json"),
        *(["_ts"] if keep_time else []),
    )


def counter_runs(events: DataFrame, fields: dict[str, Column], ttl_seconds: int) -> DataFrame:
    """Events per (user, run, kind, field) of the ``fields`` by kind: ``user_id,
    run_start, kind, field, count, _last``. An event is one row until its second has
    its run; only then it is taken apart into kinds."""
    names = [f"_f{i}" for i in range(len(fields))]
    wide = events.select("user_id", "timestamp", *[c.alias(n) for n, c in zip(names, fields.values())])
    part = wide.groupBy("user_id", second_of().alias("_sec"), *names).agg(
        F.count(F.lit(1)).alias("_n"), F.max("timestamp").alias("_last"))
    runs = second_runs(events, "user_id", ttl_seconds).select("user_id", "_sec", "run_start")
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(n).alias("field")) for k, n in zip(fields, names)])
    apart = part.join(runs, ["user_id", "_sec"], "left").select("user_id", "run_start", F.inline(kinds), "_n", "_last")
    return apart.groupBy("user_id", "run_start", "kind", "field").agg(
        F.sum("_n").alias("count"), F.max("_last").alias("_last"))


def _counter(events: DataFrame, field, ttl_seconds, as_of) -> DataFrame:
    if ttl_seconds is None:
        return events.groupBy("user_id", field.alias("field")).agg(F.count(F.lit(1)).alias("count"))
    per_run = counter_runs(events, {"": field}, ttl_seconds)
    return _newest_run(per_run, "user_id", ttl_seconds, as_of).select("user_id", "field", "count")


def category_interests(events: DataFrame, ttl_seconds: int | None = TTL_CATEGORY_INTERESTS,
                       as_of=None) -> DataFrame:
    """Events per (user, category) (C7): ``user_id, field, count``."""
    return _counter(events, F.col("product_category"), ttl_seconds, as_of)


def price_preferences(events: DataFrame, ttl_seconds: int | None = TTL_PRICE_PREFERENCES,
                      as_of=None) -> DataFrame:
    """Events per (user, 5-band price class), ranked by count desc then band
    asc (C8): ``user_id, field, count, rank``."""
    counts = _counter(events, price_band("product_price"), ttl_seconds, as_of)
    w = Window.partitionBy("user_id").orderBy(F.col("count").desc(), F.col("field").asc())
    return counts.withColumn("rank", F.row_number().over(w))


def action_counts(events: DataFrame, ttl_seconds: int | None = TTL_ACTION_COUNTS,
                  as_of=None) -> DataFrame:
    """Events per (user, action) (C9): ``user_id, field, count``."""
    return _counter(events, F.col("action_type"), ttl_seconds, as_of)


def session_runs(events: DataFrame, ttl_seconds: int) -> DataFrame:
    """One row per run of a session: ``session_id, run_start, _start, user_id,
    _last, action_count``."""
    part = per_second_runs(events, "session_id", ttl_seconds, [
        F.min("timestamp").alias("_start"),
        F.min_by("user_id", "timestamp").alias("_user"),
        F.max("timestamp").alias("_last"),
        F.count(F.lit(1)).alias("_n")])
    return part.groupBy("session_id", "run_start").agg(
        F.min("_start").alias("_start"),
        F.min_by("_user", "_start").alias("user_id"),
        F.max("_last").alias("_last"),
        F.sum("_n").alias("action_count"))


def session_summary(events: DataFrame, ttl_seconds: int | None = TTL_SESSION, as_of=None,
                    all_runs: bool = False) -> DataFrame:
    """Session record (C10): ``session_id, user_id, start_time,
    last_activity, action_count``; start and user come from the first event
    of the (run of the) session, last activity from the newest.

    With ``all_runs`` every run of a session is listed, not only the newest.
    """
    if ttl_seconds is None:
        out = events.groupBy("session_id").agg(
            F.min("timestamp").alias("_start"),
            F.min_by("user_id", "timestamp").alias("user_id"),
            F.max("timestamp").alias("_last"),
            F.count(F.lit(1)).alias("action_count"))
    else:
        out = session_runs(events, ttl_seconds)
        if not all_runs:
            out = _newest_run(out, "session_id", ttl_seconds, as_of)
    return out.select("session_id", "user_id", format_time("_start").alias("start_time"),
                      format_time("_last").alias("last_activity"), "action_count")


# key layout of the keyed store the summaries replace (optional export column)
_KEYS = {
    "recent_behaviors": ("user", "user_id", "recent_behaviors"),
    "category_interests": ("user", "user_id", "category_interests"),
    "price_preferences": ("user", "user_id", "price_preferences"),
    "action_counts": ("user", "user_id", "action_counts"),
    "session_summary": ("session", "session_id", None),
}


def with_serving_key(summary: DataFrame, table: str) -> DataFrame:
    """Add ``key`` (e.g. ``user:<id>:category_interests``, ``session:<id>``)."""
    kind, col, suffix = _KEYS[table]
    return summary.withColumn("key", serving_key(kind, col, suffix))
