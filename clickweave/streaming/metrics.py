"""Metrics of the stream job as a table.

The streaming frame observes its rows while they flow into the sinks, so no
extra job counts them, and it makes no difference which sinks are on. A
listener writes one row per micro-batch that Spark reports, below the query's
id, so that a restarted job goes on with its table.
"""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..operators.serving import REQUIRED_FOR_SERVING

NAME = "job"
SCHEMA = ("query_id string, batch_id long, rows long, storable long, no_user long, first_event timestamp, "
          "last_event timestamp, input_rows long, trigger_ms long, started string")


def observed(events: DataFrame) -> DataFrame:
    """The streaming frame with the counts that ``BatchMetrics`` writes."""
    whole = F.lit(True)
    for c in REQUIRED_FOR_SERVING:
        whole = whole & F.col(c).isNotNull()
    return events.observe(NAME, F.count(F.lit(1)).alias("rows"), F.count_if(whole).alias("storable"),
                          F.count_if(F.col("user_id").isNull()).alias("no_user"),
                          F.min("timestamp").alias("first_event"), F.max("timestamp").alias("last_event"))


class BatchMetrics(StreamingQueryListener):
    """Writes the observed counts of every micro-batch with rows to ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.written: dict[str, set[int]] = {}
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get(NAME)
        if seen is None or not seen["rows"]:
            return
        row = (str(p.id), p.batchId, seen["rows"], seen["storable"], seen["no_user"], seen["first_event"], seen["last_event"],
               p.numInputRows, int(p.durationMs.get("triggerExecution", 0)), p.timestamp)
        # a replayed batch replaces its row
        self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/query={p.id}/batch={p.batchId}")
        with self._changed:
            self.written.setdefault(str(p.id), set()).add(p.batchId)
            self._changed.notify_all()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def wait(self, query, timeout: float = 60.0) -> bool:
        """Progress is reported behind the query: wait for its last batch."""
        last = max((p["batchId"] for p in query.recentProgress if p["numInputRows"]), default=None)
        end = time.monotonic() + timeout
        with self._changed:
            while last is not None and last not in self.written.get(str(query.id), ()):
                if not self._changed.wait(max(0.0, end - time.monotonic())) and time.monotonic() >= end:
                    return False
        return True


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(f"{path.rstrip('/')}/*/*")
