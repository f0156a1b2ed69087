"""Cross-batch features without state: a look back into the lake (H8), with
corrections of what late rows change (H12).

A micro-batch's window features need the users' earlier events: those of the
last ``recent_seconds`` and those of the same session. They are in the lake, so
no state is kept: the days around the batch are read (the scan is pruned to
their folders and to five columns), cut to the batch's users, and summed per
(user, second) and (user, session, second) before they meet the batch's rows.

A row that comes late also changes the features of rows behind it that are
written already. Such rows (events of its user that are not before it, in the
days read) are computed anew, in one pass with the batch's rows, and where a feature differs from the one written,
two rows are added to the features table: the old one with ``sign`` -1 and the
new one with ``sign`` 1. Every row's signs sum to one for its present features,
so a consumer can add up changes; ``current_features`` reads the present state.

A replayed batch reads the lake and the features without its own rows and those
of later batches of its run, and replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import epoch_seconds, event_date
from ..operators.features import SEGMENT_COLS, WINDOW_COLS, process_user_behavior
from ..schema import EVENT_COLUMNS, RECENT_WINDOW_SECONDS

RECORD = ["topic", "partition", "offset"]
EVENTS_AND_RECORD = [*EVENT_COLUMNS, *RECORD]
SESSION_SECONDS = 86_400
CHANGING = [*WINDOW_COLS, *SEGMENT_COLS]
DERIVED = ["sign", "event_date", "run_id", "batch_id"]


def _other_batches(table: DataFrame, run_id: str, batch_id: int) -> DataFrame:
    """Rows of other runs and of earlier batches of this one."""
    return table.where((F.col("run_id") != f"run-{run_id}") | (F.col("batch_id") < batch_id))


def _days_around(batch: DataFrame, seconds: int) -> tuple[list, int | None]:
    """The days of the batch's events and as many around them as ``seconds``
    reach, and the first second of all; a micro-batch holds a few days."""
    reach = -(-seconds // 86_400)
    first = {r[0]: r[1] for r in batch.groupBy(event_date("timestamp")).agg(F.min(epoch_seconds("timestamp"))).collect()}
    return sorted({d + timedelta(days=k) for d in first for k in range(-reach, reach + 1)}), min(first.values(), default=None)


def _read(spark: SparkSession, path: str, days: list) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path).where(F.col("event_date").isin(days))


def newest(rows: DataFrame) -> DataFrame:
    """The present row of each record: of those added, the last one."""
    w = Window.partitionBy(*RECORD).orderBy(F.col("batch_id").desc())
    return rows.where("sign = 1").withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def current_features(spark: SparkSession, path: str) -> DataFrame:
    """Every event with its present features, one row per record."""
    return newest(spark.read.option("basePath", path).parquet(path)).drop(*DERIVED)


def lookback_features(batch: DataFrame, lake_path: str, features_path: str | None, run_id: str, batch_id: int,
                      recent_seconds: int = RECENT_WINDOW_SECONDS, session_seconds: int = SESSION_SECONDS,
                      tie_break: str | None = "offset", held: list | None = None) -> DataFrame:
    """The batch's events with all features and ``sign`` 1, and the corrections
    (``sign`` -1 and 1) of rows in the features table of ``features_path``.

    ``batch``: events with the record columns; those without a user or a time
    have no features. Sessions count on over ``session_seconds``. The lake holds
    the batch already or not. Events of one second are ordered by time, then by
    ``tie_break``. Rows of the lake that are used several times are persisted and
    added to ``held``, for the caller to release once the result is written.
    """
    spark = batch.sparkSession
    batch = batch.where("user_id is not null and timestamp is not null")
    cols = batch.columns
    days, begin = _days_around(batch, max(recent_seconds, session_seconds))
    past = _other_batches(_read(spark, lake_path, days), run_id, batch_id).where("timestamp is not null")
    sec = epoch_seconds("timestamp")
    end = past.agg(F.max(sec)).first()[0]
    any_late = begin is not None and end is not None and begin <= end

    def keep(rows):
        if held is not None:
            with _few_partitions(spark):
                held.append(rows.persist())
        return rows

    # merged: a scan is planned by the size of its files, and rows of the lake are no table to broadcast
    past = past.hint("merge").join(batch.groupBy("user_id").agg(F.min(sec).alias("_from")), "user_id")
    # rows not before the batch's first of their user: behind a late row, or in its second
    changed = sec >= F.col("_from") if any_late else F.lit(False)
    before = keep(past.where(~changed).select("user_id", "session_id", "action_type", "product_price", "timestamp"))
    if not any_late:
        return process_user_behavior(batch, recent_seconds, tie_break, earlier=before).withColumn("sign", F.lit(1))
    behind = past.where(changed).select(*cols)
    known = None if features_path is None else _features_of(spark, features_path, days, run_id, batch_id)
    if known is not None:
        behind = behind.hint("merge").join(known.select(*RECORD, F.struct(*CHANGING).alias("_old")), RECORD, "left")
    both = batch.withColumn("_own", F.lit(True)).unionByName(keep(behind.withColumn("_own", F.lit(False))), allowMissingColumns=True)
    done = process_user_behavior(both, recent_seconds, tie_break, earlier=before)
    if known is None:
        return done.where("_own").drop("_own").withColumn("sign", F.lit(1))

    differs = F.lit(False)
    for c in WINDOW_COLS:
        a, b = F.col(f"_old.{c}"), F.col(c)
        # sums of prices may come in another order
        same = F.abs(a - b) <= 1e-9 * F.greatest(F.abs(a), F.lit(1.0)) if c == "avg_price_viewed" else a == b
        differs = differs | (a.isNull() != b.isNull()) | ~F.coalesce(same, F.lit(True))
    old = F.struct(*[F.col(f"_old.{c}").alias(c) for c in CHANGING], F.lit(-1).alias("sign"))
    new = F.struct(*CHANGING, F.lit(1).alias("sign"))
    rows = F.when(F.col("_own"), F.array(new)).when(F.col("_old").isNotNull() & differs, F.array(old, new))
    kept = [c for c in done.columns if c not in ("_own", "_old")]
    return done.withColumn("_row", F.explode(rows)).select(
        *[F.col(f"_row.{c}").alias(c) if c in CHANGING else F.col(c) for c in kept], F.col("_row.sign").alias("sign"))


@contextmanager
def _few_partitions(spark: SparkSession) -> Iterator[None]:
    """What is persisted within keeps the partitions that AQE has merged."""
    name = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"
    was = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, was)


def _features_of(spark: SparkSession, path: str, days: list, run_id: str, batch_id: int) -> DataFrame | None:
    from pyspark.errors import AnalysisException
    try:
        rows = _read(spark, path, days)
    except AnalysisException:  # the first batch: nothing is written yet
        return None
    return newest(_other_batches(rows, run_id, batch_id))
