"""The streaming job.

``start_stream`` runs, for every micro-batch of decoded events:

1. lake append (A4 / H10);
2. an optional table of features of the rows that have a user: per batch (H7:
   windows see only the current micro-batch) or across batches by looking back
   into the lake, with corrections of what late rows change (H8, H12,
   ``streaming.lookback``; ``streaming.stateful`` has the form with state);
3. serving deltas of the storable rows (A11), with expiry when read;
4. an optional quarantine table of the rows that are not storable, with the
   reason (C11).

Every write is idempotent per run and batch; the run is the id of the
streaming query, which its checkpoint keeps over restarts. The batch is persisted before its first action and released afterwards
(H11); its row count comes from an ``Observation`` on the lake write rather
than a separate ``count()`` job (C13, B21).
"""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import event_date
from ..operators.features import process_user_behavior
from ..operators.serving import split_storable
from ..schema import RECORD_METADATA
from ..sources.kafka import decode_events, fill_event_time
from ..sources.lake import write_batch, write_lake
from ..sources.serving_store import batch_tables, write_serving
from . import live_serving
from .lookback import EVENTS_AND_RECORD, lookback_features
from .metrics import BatchMetrics, observed
from .once import each_record_once
from .stateful import configured

log = logging.getLogger(__name__)

RECORD_KEYS = ["topic", "partition", "offset"]


def with_event_time(events: DataFrame, delay: str = "1 minute") -> DataFrame:
    """Event-time watermark on ``timestamp`` (H2). Without a stateful
    operator after it, late rows are still processed (policy ``keep``)."""
    return events.withWatermark("timestamp", delay)


def apply_late_policy(events: DataFrame, late: str = "keep", delay: str = "1 minute") -> DataFrame:
    """``keep``: watermark only (reference behaviour). ``drop``: also drop
    duplicate records (same topic / partition / offset) within the
    watermark, which discards rows behind the watermark as well (H10, H12).
    ``once``: drop duplicate records and keep late rows (``streaming.once``)."""
    if late == "once":
        return with_event_time(each_record_once(events), delay)
    watermarked = with_event_time(events, delay)
    if late == "keep":
        return watermarked
    if late == "drop":
        if missing := [c for c in RECORD_KEYS if c not in events.columns]:
            raise ValueError(f"late='drop' needs the record columns {missing}")
        return watermarked.dropDuplicatesWithinWatermark(RECORD_KEYS)
    raise ValueError("late must be 'keep', 'drop' or 'once'")


def decode_stream(records: DataFrame, late: str = "keep", delay: str = "1 minute",
                  now=None) -> DataFrame:
    """Records -> events with event time filled and the late-row policy set."""
    return apply_late_policy(fill_event_time(decode_events(records), now=now), late, delay)


def together(spark: SparkSession, jobs: list[Callable[[], None]]) -> None:
    """Runs the writes of a batch side by side: each is a chain of small stages
    that alone leaves most of the cluster idle. The first error is raised once
    all have ended, and the batch is replayed; every write replaces its own."""
    if not jobs:
        return
    with ThreadPoolExecutor(len(jobs)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    for f in started:
        f.result()


@dataclass
class BatchSink:
    """The ``foreachBatch`` body. Any of the outputs may be switched off
    (``lake_path=None`` is the store-only variant, A14). ``run_id`` names
    the checkpoint; ``start_stream`` sets it once the query has its id."""
    lake_path: str | None = None
    serving_path: str | None = None
    features_path: str | None = None
    feature_args: dict = field(default_factory=dict)
    feature_mode: str = "batch"
    counts: dict = field(default_factory=dict)
    quarantine_path: str | None = None
    ttls: dict = field(default_factory=dict)
    run_id: str | None = "stream"
    named: threading.Event = field(default_factory=threading.Event)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if self.run_id is None and not self.named.wait(60):
            raise RuntimeError("the streaming query has no id yet")
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            obs = Observation(f"batch_{batch_id}")
            observed = batch.observe(obs, F.count(F.lit(1)).alias("rows"))
            if self.lake_path:
                write_lake(observed, self.lake_path, batch_id=batch_id, run_id=self.run_id)
                self.counts[batch_id] = obs.get["rows"]
            events = batch.drop(*[c for c in RECORD_METADATA if c in batch.columns])
            jobs = []
            if self.features_path and self.feature_mode == "lookback":
                def features():
                    held = []
                    try:
                        feats = lookback_features(batch.select(*EVENTS_AND_RECORD), self.lake_path, self.features_path,
                                                  self.run_id, batch_id, held=held, **self.feature_args)
                        write_batch(feats.withColumn("event_date", event_date("timestamp")), self.features_path, self.run_id,
                                    batch_id, ["event_date"])
                    finally:
                        for rows in held:
                            rows.unpersist()
                jobs.append(features)
            elif self.features_path:
                # undecodable records have no user and would share one window
                feats = process_user_behavior(events.where("user_id is not null"), **self.feature_args)
                jobs.append(lambda: write_batch(feats, self.features_path, self.run_id, batch_id))
            good, bad = split_storable(events)
            if self.serving_path:
                for name, table in batch_tables(good, self.ttls).items():
                    jobs.append(partial(write_serving, {name: table}, self.serving_path, batch_id, self.run_id))
            if self.quarantine_path:
                jobs.append(lambda: write_batch(bad, self.quarantine_path, self.run_id, batch_id))
            together(batch.sparkSession, jobs)
            log.info("batch %s done", batch_id)
        finally:
            batch.unpersist()


def start_stream(events: DataFrame, checkpoint: str, lake_path: str | None = None,
                 serving_path: str | None = None, features_path: str | None = None,
                 trigger: str | None = "10 seconds", available_now: bool = False,
                 name: str | None = None, feature_args: dict | None = None,
                 quarantine_path: str | None = None, ttls: dict | None = None,
                 feature_mode: str = "batch", metrics_path: str | None = None) -> StreamingQuery:
    """Start the micro-batch job (H1, H3, H4). ``available_now`` processes
    what is there and stops (tests, back-fills). ``ttls`` overrides serving
    lifetimes in seconds by table. ``feature_mode``: ``batch`` or ``lookback``
    (needs the lake and the record columns). ``metrics_path``: a row of counts
    per micro-batch (``query.metrics`` is the listener that writes them)."""
    if feature_mode not in ("batch", "lookback"):
        raise ValueError("feature_mode must be 'batch' or 'lookback'")
    if feature_mode == "lookback" and features_path and not lake_path:
        raise ValueError("features across batches look back into the lake, so they need lake_path")
    sink = BatchSink(lake_path, serving_path, features_path, feature_args or {}, feature_mode,
                     quarantine_path=quarantine_path, ttls=ttls or {}, run_id=None)
    metrics = None
    if metrics_path:
        metrics = BatchMetrics(events.sparkSession, metrics_path)
        events.sparkSession.streams.addListener(metrics)
        events = observed(events)
    writer = (events.writeStream.outputMode("update").foreachBatch(sink)
              .option("checkpointLocation", checkpoint))
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    with configured(events.sparkSession):  # for policies that keep state
        query = writer.start()
    query.metrics = metrics
    sink.run_id = str(query.id)
    sink.named.set()
    query.sink_counts = sink.counts  # rows per batch, for monitoring
    return query


LIVE_TABLES = {"counters": live_serving.live_counters, "sessions": live_serving.live_sessions,
               "recent_behaviors": live_serving.live_recent}


def start_live(events: DataFrame, table: str, path: str, checkpoint: str, trigger: str | None = "10 seconds",
               available_now: bool = False, **options) -> StreamingQuery:
    """Keep one live serving table (``LIVE_TABLES``) in keyed state (H9): each
    micro-batch writes the present rows of the keys it touched below ``path``;
    ``read_live`` has the newest of every key. ``options`` go to the table
    (``ttl_seconds``, ...)."""
    good, _ = split_storable(events)
    run: dict = {}
    named = threading.Event()

    def sink(batch, batch_id):
        if not named.wait(60):
            raise RuntimeError("the streaming query has no id yet")
        write_batch(batch, path, run["id"], batch_id)

    with configured(events.sparkSession):
        writer = (LIVE_TABLES[table](good, **options).writeStream.outputMode("update").foreachBatch(sink)
                  .option("checkpointLocation", checkpoint))
        if available_now:
            writer = writer.trigger(availableNow=True)
        elif trigger:
            writer = writer.trigger(processingTime=trigger)
        query = writer.start()
    run["id"] = str(query.id)
    named.set()
    return query


def read_live(spark: SparkSession, path: str, key: str = "user_id") -> DataFrame:
    """The last emission of every key of a live table. A key's emissions of one
    batch are few rows; the last batch of each key is an aggregate."""
    rows = spark.read.parquet(path)
    last = rows.groupBy(key).agg(F.max("batch_id").alias("batch_id"))
    return rows.join(last, [key, "batch_id"], "left_semi").drop("run_id", "batch_id")


def run_for(query: StreamingQuery, seconds: float | None = None) -> StreamingQuery:
    """Wait ``seconds`` (or until the query ends), then stop it (H5)."""
    try:
        if seconds is None:
            query.awaitTermination()
        else:
            query.awaitTermination(seconds)
    finally:
        query.stop()
    return query


def stop_all(spark: SparkSession) -> int:
    """Stop every active query of the session (H6); returns how many."""
    active = list(spark.streams.active)
    for q in active:
        q.stop()
    return len(active)


def status(spark: SparkSession) -> DataFrame:
    """``id, name, is_active, last_progress`` (JSON text) of active queries (H6)."""
    import json
    rows = [(str(q.id), q.name, bool(q.isActive), json.dumps(q.lastProgress) if q.lastProgress else None)
            for q in spark.streams.active]
    return spark.createDataFrame(rows, "id string, name string, is_active boolean, last_progress string")


def main(argv=None):
    """``python -m clickweave.streaming.micro_batch --servers host:9092 --lake …``"""
    import argparse

    from ..session import get_session
    from ..sources.kafka import DEFAULT_TOPIC, read_kafka
    p = argparse.ArgumentParser(description="stream events into the lake and the serving tables")
    p.add_argument("--servers", required=True)
    p.add_argument("--topics", default=DEFAULT_TOPIC)
    p.add_argument("--starting", default="latest")
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--lake")
    p.add_argument("--serving")
    p.add_argument("--features")
    p.add_argument("--quarantine")
    p.add_argument("--trigger", default="10 seconds")
    p.add_argument("--late", choices=["keep", "drop", "once"], default="keep")
    p.add_argument("--metrics", help="folder of the table of counts per micro-batch")
    p.add_argument("--feature-mode", choices=["batch", "lookback"], default="batch")
    p.add_argument("--max-offsets", type=int, help="records per micro-batch at most")
    p.add_argument("--live", help="folder of live serving tables kept in state")
    p.add_argument("--duration", type=float, help="seconds to run, default until stopped")
    a = p.parse_args(argv)
    spark = get_session()
    more = {"maxOffsetsPerTrigger": str(a.max_offsets)} if a.max_offsets else {}
    events = decode_stream(read_kafka(spark, a.servers, a.topics, a.starting, options=more), late=a.late)
    if a.live:
        for table in LIVE_TABLES:
            start_live(events, table, f"{a.live}/{table}", f"{a.checkpoint}/live-{table}", trigger=a.trigger)
    query = start_stream(events, a.checkpoint, a.lake, a.serving, a.features, trigger=a.trigger,
                         name="clickweave-stream", quarantine_path=a.quarantine, feature_mode=a.feature_mode,
                         metrics_path=a.metrics)
    run_for(query, a.duration)


if __name__ == "__main__":
    main()
