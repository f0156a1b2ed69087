"""Sliding-expiry runs of a keyed summary (H9, batch form).

A serving summary keyed by ``key`` (a user, a session) is renewed by every
event of that key and disappears ``ttl`` seconds after the last one. Seen in
event time, the key's events fall into *runs*: a new run starts when the gap
to the previous event of the key is ``>= ttl``, and an expired key restarts
from zero. ``assign_runs`` labels every event with the start of its run.

Plan (no task ever holds a whole key)
-------------------------------------
The TTL is at least one second, so two events of the same second are never
a TTL apart: only the *first* event of a second can start a run, and only
the key's *last* event of a second can be the one before it. So:

1. Events are reduced to one row per ``(key, second)``: first and last time
   (micros) plus whatever the caller wants summed per second (map-side
   combine before the shuffle).
2. Those rows go to ``(key, bucket)`` partitions, bucket = ``floor(s / W)``
   with ``W >= ttl``; the rows of the last ``ttl`` seconds of a bucket are
   copied into the next bucket as halo rows, so the previous event of any
   second, if it is less than a TTL back, is in the same partition. ``lag``
   gives it; a second whose first event is ``>= ttl`` after it starts a run.
   A running max gives the run open at every second of the bucket.
3. Seconds whose run began in an earlier bucket take the run carried over
   from a window on one row per ``(key, bucket)`` (runs are ``>= ttl``
   apart, so a key has few of them).

A partition holds at most ``W + ttl`` rows per key, whatever the key's event
rate. Summaries aggregate their values per ``(key, second)`` too, join the
runs on ``(key, second)`` and aggregate by run (``per_second_runs``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_HOME = 0
DEFAULT_BUCKET_SECONDS = 86400


def ttl_interval(ttl_seconds: int):
    return F.expr(f"INTERVAL {int(ttl_seconds)} SECONDS")


def second_of(ts: str = "timestamp") -> Column:
    """Whole second (epoch) of a timestamp; NULL for a NULL time."""
    return F.floor(F.unix_micros(F.col(ts)) / F.lit(1_000_000))


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def second_runs(events: DataFrame, key: str | Sequence[str], ttl_seconds: int,
                bucket_seconds: int = DEFAULT_BUCKET_SECONDS, ts: str = "timestamp") -> DataFrame:
    """One row per ``(key, _sec)`` with ``run_start`` (timestamp of the run
    the second's events belong to; NULL for NULL times) and ``_lastu`` (last
    event time of the second, micros). Keys must be non-NULL (serving tables
    are built from ``split_storable`` output).

    The carried-over runs branch off the per-bucket rows and are joined back;
    both branches read the same columns, so Spark reuses one shuffle for
    them. (Callers therefore aggregate their own values per second and join
    on ``(key, _sec)`` instead of passing extra columns through here.)"""
    keys = _keys(key)
    ttl_s = max(int(ttl_seconds), 1)
    ttl_us = ttl_s * 1_000_000
    width = max(int(bucket_seconds), ttl_s)
    micros = F.unix_micros(F.col(ts))
    per_sec = events.groupBy(*keys, second_of(ts).alias("_sec")).agg(
        F.min(micros).alias("_first"), F.max(micros).alias("_lastu"))
    tb = F.floor(F.col("_sec") / F.lit(width))
    spread = per_sec.withColumn("_buckets", F.when(
        F.col("_sec") >= (tb + 1) * width - ttl_s, F.array(tb, tb + 1)).otherwise(F.array(tb)))
    rows = spread.select(*keys, "_sec", "_first", "_lastu",
                         F.posexplode("_buckets").alias("_kind", "_bucket"))
    home = F.col("_kind") == _HOME

    w = Window.partitionBy(*keys, "_bucket").orderBy("_sec")
    prev = F.lag("_lastu").over(w)
    starts = (rows.repartition(*keys, "_bucket")
              .withColumn("_prev", prev)
              .where(home)
              .withColumn("_head", F.when(
                  F.col("_first").isNotNull()
                  & (F.col("_prev").isNull() | (F.col("_first") - F.col("_prev") >= ttl_us)),
                  F.col("_first"))))
    local = starts.withColumn(
        "_local", F.max("_head").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    # the run open when each bucket begins: one row per (key, bucket)
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (local.groupBy(*keys, "_bucket").agg(F.max("_local").alias("_m"))
               .select(*keys, "_bucket", F.max("_m").over(earlier).alias("_carried")))
    out = local.join(carried, [*keys, "_bucket"], "left")
    return out.select(*keys, "_sec",
                      F.timestamp_micros(F.coalesce(F.col("_local"), F.col("_carried"))).alias("run_start"),
                      "_lastu")


def per_second_runs(events: DataFrame, key: str | Sequence[str], ttl_seconds: int, aggs: Sequence[Column],
                    by: Sequence[Column] = (), bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
                    ts: str = "timestamp") -> DataFrame:
    """``aggs`` of the events per ``(key, second, *by)`` (map-side combined),
    with the ``run_start`` of that second. NULL times get a NULL run."""
    keys = _keys(key)
    runs = second_runs(events, keys, ttl_seconds, bucket_seconds, ts) \
        .select(*keys, "_sec", "run_start")
    part = events.groupBy(*keys, second_of(ts).alias("_sec"), *by).agg(*aggs)
    return part.join(runs, [*keys, "_sec"], "left")


def assign_runs(events: DataFrame, key: str | Sequence[str], ttl_seconds: int,
                bucket_seconds: int = DEFAULT_BUCKET_SECONDS, ts: str = "timestamp") -> DataFrame:
    """``events`` + ``run_start`` (timestamp of the first event of the run).

    The per-second runs are joined back on ``(key, second)``, a key no hotter
    than one second of one key. Keys must be non-NULL. Events with a NULL
    time form no run (``run_start`` NULL).
    """
    keys = _keys(key)
    cols = events.columns
    runs = second_runs(events, keys, ttl_seconds, bucket_seconds, ts) \
        .select(*keys, "_sec", "run_start")
    out = events.withColumn("_sec", second_of(ts)).join(runs, [*keys, "_sec"], "left")
    return out.select(*cols, "run_start")


def run_summary(events: DataFrame, key: str | Sequence[str], ttl_seconds: int,
                bucket_seconds: int = DEFAULT_BUCKET_SECONDS, ts: str = "timestamp") -> DataFrame:
    """One row per run: ``key, run_start, last_write, events, expires_at``."""
    keys = _keys(key)
    secs = per_second_runs(events, keys, ttl_seconds,
                           [F.max(ts).alias("_last"), F.count(F.lit(1)).alias("_n")],
                           bucket_seconds=bucket_seconds, ts=ts)
    return (secs.groupBy(*keys, "run_start")
            .agg(F.max("_last").alias("last_write"), F.sum("_n").alias("events"))
            .withColumn("expires_at", F.col("last_write") + ttl_interval(ttl_seconds)))


def newest_merged_run(runs: DataFrame, key: str, ttl_seconds: int) -> DataFrame:
    """``key, _newest, _key_last``: start and last write of each key's newest
    run, from runs found separately in pieces of its events (micro-batches):
    rows ``key, run_start, _last``, in any order, found with a TTL of at most
    ``ttl_seconds``.

    Runs of two pieces belong together if they overlap or lie less than the
    TTL apart, so the pieces are merged as intervals. A key has one row per
    run and piece here, whatever its event rate.
    """
    runs = runs.groupBy(key, "run_start").agg(F.max("_last").alias("_last"))
    w = Window.partitionBy(key).orderBy("run_start")
    before = F.max("_last").over(w.rowsBetween(Window.unboundedPreceding, -1))
    head = before.isNull() | (F.col("run_start") >= before + ttl_interval(ttl_seconds))
    heads = runs.withColumn("_head", F.when(head, F.col("run_start")))
    return heads.groupBy(key).agg(F.max("_head").alias("_newest"), F.max("_last").alias("_key_last"))
