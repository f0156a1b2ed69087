"""Event lake: day-partitioned Parquet.

Layout: ``<path>/event_date=YYYY-MM-DD/run_id=R/batch_id=N/part-*.parquet``,
for every writer. A batch write takes a new ``run_id``; a stream write passes
the id of its query (bound to the checkpoint) and its ``batch_id`` and
overwrites exactly the partitions of that pair, so a replayed micro-batch
replaces its own files and no run touches the files of another.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import event_date, parse_iso


def write_lake(events: DataFrame, path: str, batch_id: int | None = None,
               files_per_day: int | None = None, run_id: str = "stream") -> None:
    """Append events to the lake, partitioned by UTC event day.

    Errors are raised, not swallowed. ``files_per_day`` optionally clusters
    the rows by (day, salt) first -- one shuffle -- so each day is written as
    about that many even files instead of one file per input partition and
    day; the salt is a hash of the row, so a retried task places rows the
    same way and a heavy day is still spread over many tasks.
    """
    out = events.withColumn("event_date", event_date("timestamp"))
    if files_per_day:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in events.columns]), F.lit(int(files_per_day)))
        out = out.repartition("event_date", salt.alias("_salt"))
    if batch_id is None:
        run_id, batch_id = f"batch-{uuid.uuid4().hex}", 0
    write_batch(out, path, run_id, batch_id, ["event_date"])


def write_batch(df: DataFrame, path: str, run_id: str, batch_id: int, by: Sequence[str] = ()) -> None:
    """Write ``df`` as the partitions of one (run, batch) below ``path``; a
    replay replaces exactly those. ``run-`` keeps the folder name a string."""
    (df.withColumns({"run_id": F.lit(f"run-{run_id}"), "batch_id": F.lit(int(batch_id))})
     .write.partitionBy(*by, "run_id", "batch_id").mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").parquet(path))


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    """Scan the lake; ``event_date`` comes from the directory names (A5)."""
    return spark.read.option("basePath", path).parquet(path).drop("run_id", "batch_id")


def time_range(events: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Half-open ``[start, end)`` filter on ``timestamp``.

    Filters only when both ends are given. On a lake frame the matching
    ``event_date`` range is added as well, so the scan prunes day folders
    (a timestamp predicate alone does not prune partitions).
    """
    if not (start and end):
        return events
    s, e = parse_iso(start), parse_iso(end)
    cond = (F.col("timestamp") >= s) & (F.col("timestamp") < e)
    if "event_date" in events.columns:
        cond = cond & (F.col("event_date") >= F.to_date(s)) & (F.col("event_date") <= F.to_date(e - F.expr("INTERVAL 1 MICROSECOND")))
    return events.where(cond)


def day_range(day: str | date) -> tuple[str, str]:
    """ISO start/end of one UTC day, for ``time_range``."""
    d = day if isinstance(day, date) else date.fromisoformat(str(day))
    start = datetime(d.year, d.month, d.day, tzinfo=timezone.utc)
    fmt = "%Y-%m-%dT%H:%M:%S+00:00"
    return start.strftime(fmt), (start + timedelta(days=1)).strftime(fmt)


def run_sql(spark: SparkSession, events: DataFrame, sql: str,
            view: str = "user_behavior_events") -> DataFrame:
    """Register ``events`` as a temp view and run SQL text over it."""
    events.createOrReplaceTempView(view)
    return spark.sql(sql)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` rows."""
    return df.limit(n)
