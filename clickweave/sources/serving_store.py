"""Serving-store sink (A11), re-aimed from a key-value store to tables.

Every micro-batch writes its summary *deltas* below
``<path>/<table>/run_id=R/batch_id=N``: counters (one table, a folder for
each kind) and session records per run of a key inside the batch
(``operators.runs``), and the newest behaviours of every user with the runs
of the user beside them. A replayed batch replaces
its own folder, so increments are never applied twice, and a job with a new
checkpoint adds to what earlier ones wrote.

``read_serving`` merges the deltas into the current summary. The runs of all
batches are merged as intervals, so a key expires and restarts exactly as it
would over all events at once, whatever the order of the batches. All merges
are aggregations (partial before the shuffle) or per-key top-n; a key has one
row per batch and run, whatever its event rate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import format_time, price_band
from ..operators import serving
from ..operators.runs import newest_merged_run, second_runs, ttl_interval
from ..schema import (RECENT_BEHAVIORS_KEEP, TTL_ACTION_COUNTS, TTL_CATEGORY_INTERESTS, TTL_PRICE_PREFERENCES,
                      TTL_RECENT_BEHAVIORS, TTL_SESSION)
from .lake import write_batch

# table -> lifetime of its keys in seconds
TABLES = {"recent_behaviors": TTL_RECENT_BEHAVIORS, "category_interests": TTL_CATEGORY_INTERESTS,
          "price_preferences": TTL_PRICE_PREFERENCES, "action_counts": TTL_ACTION_COUNTS,
          "session_summary": TTL_SESSION}
COUNTED = {"category_interests": "product_category", "price_preferences": price_band, "action_counts": "action_type"}
COUNTERS, RECENT_RUNS = "counters", "recent_runs"


def batch_tables(events: DataFrame, ttls: dict[str, int] | None = None,
                 n: int = RECENT_BEHAVIORS_KEEP) -> dict[str, DataFrame]:
    """Summary deltas of one batch of storable events, merged when read."""
    ttl = TABLES | (ttls or {})
    # kinds of one lifetime share their runs and are counted in one pass
    by_ttl: dict[int, dict] = {}
    for kind, by in COUNTED.items():
        by_ttl.setdefault(ttl[kind], {})[kind] = F.col(by) if isinstance(by, str) else by()
    counted = [serving.counter_runs(events, kinds, seconds) for seconds, kinds in by_ttl.items()]
    out = {COUNTERS: reduce(DataFrame.unionByName, counted).select(
        "user_id", "run_start", "kind", "field", "count", "_last")}
    out["session_summary"] = serving.session_runs(events, ttl["session_summary"])
    # ties in time are cut by content, the same way on a replay
    tie = events.withColumn("_tie", F.xxhash64("session_id", "product_id", "action_type", "product_price"))
    out["recent_behaviors"] = serving.recent_behaviors(tie, n, ttl_seconds=None, tie_break="_tie", keep_time=True)
    out[RECENT_RUNS] = second_runs(events, "user_id", ttl["recent_behaviors"]).groupBy("user_id", "run_start").agg(
        F.timestamp_micros(F.max("_lastu")).alias("_last"))
    return out


def write_serving(tables: dict[str, DataFrame], path: str, batch_id: int, run_id: str = "stream") -> None:
    for name, df in tables.items():
        write_batch(df, f"{path.rstrip('/')}/{name}", run_id, batch_id, ["kind"] if name == COUNTERS else [])


def read_serving(spark: SparkSession, path: str, name: str, n: int = RECENT_BEHAVIORS_KEEP,
                 ttl_seconds: int | None = None, as_of=None) -> DataFrame:
    """Current summary ``name`` merged over all written batches: of each key
    its newest run, without keys that have expired at ``as_of``.
    ``ttl_seconds`` is the lifetime the batches were written with (default:
    the table's), or a longer one."""
    if name not in TABLES:
        raise ValueError(f"unknown serving table {name}")
    ttl = ttl_seconds or TABLES[name]
    key = "session_id" if name == "session_summary" else "user_id"

    def load(table):
        return spark.read.parquet(f"{path.rstrip('/')}/{table}")

    df = load(COUNTERS).where(F.col("kind") == name) if name in COUNTED else load(name)
    newest = newest_merged_run(load(RECENT_RUNS) if name == "recent_behaviors" else df, key, ttl)
    if as_of is not None:
        newest = newest.where(F.lit(as_of).cast("timestamp") < F.col("_key_last") + ttl_interval(ttl))
    if name == "recent_behaviors":
        live = df.join(newest, key).where(F.col("_ts") >= F.col("_newest"))
        w = Window.partitionBy(key).orderBy(F.col("_ts").desc(), F.col("run_id").desc(), F.col("batch_id").desc(),
                                            F.col("rank").asc())
        return (live.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
                .drop("_ts", "run_id", "batch_id", "_newest", "_key_last"))
    live = df.join(newest, key).where(F.col("run_start") >= F.col("_newest"))
    if name == "session_summary":
        out = live.groupBy(key).agg(
            F.min_by("user_id", "_start").alias("user_id"), F.min("_start").alias("_start"),
            F.max("_last").alias("_last"), F.sum("action_count").alias("action_count"))
        return out.select(key, "user_id", format_time("_start").alias("start_time"),
                          format_time("_last").alias("last_activity"), "action_count")
    out = live.groupBy(key, "field").agg(F.sum("count").alias("count"))
    if name == "price_preferences":
        w = Window.partitionBy(key).orderBy(F.col("count").desc(), F.col("field").asc())
        out = out.withColumn("rank", F.row_number().over(w))
    return out
