"""Stream records kept as JSON files: a broker-free stand-in for the Kafka
topic (same record columns), used by tests, back-fills and the stream
queries. One folder per event day, written in day order, so a file stream
with ``maxFilesPerTrigger=1`` replays the days in time order."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import EVENT_COLUMNS
from ..session import scratch_path
from ..sources.kafka import DEFAULT_TOPIC, ENCODE_OPTIONS

ROWS_PER_FILE = 50_000  # some 25 MB of JSON
SMALL_DAY = 1000  # rows per file, below which a day is dealt out by one task

RECORD_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])


def to_records(events: DataFrame, partitions: int = 12, offset_col: str = "event_id",
               topic: str = DEFAULT_TOPIC) -> DataFrame:
    """Events -> record rows: key = user id, JSON value, partition by a hash
    of the key, ``offset`` from ``offset_col`` (unique per event), record
    time = event time."""
    value = F.to_json(F.struct(*[F.col(c) for c in EVENT_COLUMNS]), ENCODE_OPTIONS)
    return events.select(
        F.col("user_id").alias("key"), value.alias("value"), F.lit(topic).alias("topic"),
        F.pmod(F.xxhash64("user_id"), F.lit(partitions)).cast("int").alias("partition"),
        F.col(offset_col).cast("long").alias("offset"),
        F.col("timestamp").alias("timestamp"))


@dataclass
class StagedDays:
    """Events in a table with one folder per day of arrival, and their number."""
    path: str
    offset_col: str
    rows: dict[str, int]


def stage_days(events: DataFrame, offset_col: str = "event_id", late_days: Column | None = None) -> StagedDays:
    """Reads the events once and lays them by day of arrival, so that the files
    of a day are made from that day's rows alone."""
    arrival = F.col("timestamp") if late_days is None else F.col("timestamp") + F.make_dt_interval(
        late_days.cast("int"), F.lit(0), F.lit(0), F.lit(0))
    spark = events.sparkSession
    path = scratch_path(spark, f"days-{uuid.uuid4().hex}")
    columns = list(dict.fromkeys([*EVENT_COLUMNS, offset_col]))
    events.select(*columns).withColumn("offset", F.col(offset_col).cast("long")) \
        .withColumn("_day", F.date_format(arrival, "'d'yyyyMMdd")).select(*columns, "_day").write.partitionBy("_day").parquet(path)
    # the number of days is bounded by the time span
    rows = {r[0]: r[1] for r in spark.read.parquet(path).groupBy("_day").count().collect()}
    return StagedDays(path, offset_col, rows)


def even_files(staged: StagedDays, rows_per_file: int = ROWS_PER_FILE) -> int:
    """Files per day so that a file has about ``rows_per_file`` rows on the largest
    day; no more than the smallest day has rows, as every day gets as many."""
    most = max(staged.rows.values(), default=1)
    return max(1, min(-(-most // rows_per_file), min(staged.rows.values(), default=1)))


def write_days(spark: SparkSession, staged: StagedDays, path: str, partitions: int = 12, topic: str = DEFAULT_TOPIC,
               files_per_day: int | None = 1, suffix: str = "", at_once: int = 1) -> list[str]:
    """The records of staged days as JSON, days in ascending order; every day with
    at least ``files_per_day`` rows has exactly that many files. ``at_once`` days, those
    of a micro-batch, are written side by side before the next begin."""
    schema = spark.read.parquet(staged.path).drop("_day").schema

    def write(d: str) -> str:
        folder = f"{path.rstrip('/')}/{d}{suffix}"
        day = spark.read.schema(schema).parquet(f"{staged.path}/_day={d}")
        if files_per_day == 1:
            day = day.coalesce(1)
        elif files_per_day:
            # dealt in turn from one task, a small day leaves no file out
            day = (day.coalesce(1) if staged.rows[d] < SMALL_DAY * files_per_day else day).repartition(files_per_day)
        to_records(day, partitions, staged.offset_col, topic).sortWithinPartitions("timestamp").write.mode("overwrite").json(folder)
        return folder

    days, out = sorted(staged.rows), []
    with ThreadPoolExecutor(at_once) as pool:
        for i in range(0, len(days), at_once):
            out += pool.map(inheritable_thread_target(spark)(write), days[i:i + at_once])
    return out


def write_record_files(events: DataFrame, path: str, partitions: int = 12,
                       offset_col: str = "event_id", topic: str = DEFAULT_TOPIC,
                       files_per_day: int | None = 1, suffix: str = "", late_days: Column | None = None) -> list[str]:
    """Write records of ``events`` as JSON, one sub folder per UTC day, days
    in ascending order. Returns the folders written. With one file per day
    and ``maxFilesPerTrigger=1`` each micro-batch is exactly one day.
    ``late_days`` (of an event's ``offset_col``): days after which a record is
    delivered."""
    return write_days(events.sparkSession, stage_days(events, offset_col, late_days), path, partitions, topic, files_per_day, suffix)


def read_record_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Streaming frame over the record files below ``path``."""
    reader = spark.readStream.schema(RECORD_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(f"{path.rstrip('/')}/*/*.json")
