"""Event stream records: Kafka source, decoding and encoding.

A stream record is ``key binary, value binary, topic, partition, offset,
timestamp`` (the Kafka source schema). ``decode_events`` works on any frame
of that shape -- a Kafka stream, a file stream in tests, or a batch frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import BEHAVIOR_SCHEMA, EVENT_COLUMNS, RECORD_METADATA

DEFAULT_TOPIC = "user-behavior-events"
# Event times are written as ISO-8601 text with microseconds and a +hh:mm
# offset (as the event producer does); reading accepts any ISO-8601 form.
ENCODE_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx", "ignoreNullFields": "false"}


def read_kafka(spark: SparkSession, servers: str, topics: str = DEFAULT_TOPIC,
               starting: str = "latest", fail_on_data_loss: bool = False,
               options: dict | None = None) -> DataFrame:
    """Streaming frame subscribed to ``topics`` (A1). Needs the Kafka
    connector on the class path; nothing here runs until the query starts."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topics)
              .option("startingOffsets", starting)
              .option("failOnDataLoss", str(bool(fail_on_data_loss)).lower()))
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def decode_events(records: DataFrame, widen_price: bool = True) -> DataFrame:
    """Parse JSON values with the fixed event schema and flatten (A2, B17: struct expand).

    Bad JSON, wrong-typed or missing fields give NULL fields; the row is
    kept. Extra fields are ignored. Record metadata is kept as
    ``kafka_key, topic, partition, offset, kafka_timestamp``.
    """
    parsed = records.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.from_json(F.col("value").cast("string"), BEHAVIOR_SCHEMA).alias("data"),
        *[F.col(c) for c in ("topic", "partition", "offset") if c in records.columns],
        *([F.col("timestamp").alias("kafka_timestamp")] if "timestamp" in records.columns else []),
    )
    meta = [c for c in RECORD_METADATA if c in parsed.columns]
    out = parsed.select(*[F.col("data." + c).alias(c) for c in EVENT_COLUMNS], *meta)
    if widen_price:
        out = out.withColumn("product_price", F.col("product_price").cast("double"))
    return out


def fill_event_time(events: DataFrame, now=None) -> DataFrame:
    """Missing event time becomes the batch time (A3); ``now`` pins it."""
    fill: Column = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    return events.withColumn("timestamp", F.coalesce(F.col("timestamp"), fill))


def encode_events(events: DataFrame, topic: str | None = DEFAULT_TOPIC) -> DataFrame:
    """Events as stream records (A12): key = user id, value = JSON of the
    event fields (nulls written out), headers ``event_type`` and
    ``category``. The result can be written with ``format("kafka")``."""
    value = F.to_json(F.struct(*[F.col(c) for c in EVENT_COLUMNS]), ENCODE_OPTIONS)
    headers = F.array(
        F.struct(F.lit("event_type").alias("key"), F.col("action_type").cast("binary").alias("value")),
        F.struct(F.lit("category").alias("key"), F.col("product_category").cast("binary").alias("value")),
    )
    cols = [F.col("user_id").cast("binary").alias("key"), value.cast("binary").alias("value"),
            headers.alias("headers")]
    if topic:
        cols.append(F.lit(topic).alias("topic"))
    return events.select(*cols)
