"""Skew probe: one user holds a third of all events.

Derives two skewed frames from the test events: every third event moved to
one user ("spread", over the whole month), and the same user as a bot whose
events are packed into one hour ("burst"). Runs the window features and
the 1-day expiry runs, each as the textbook per-user plan and as the
library's per-second plan, with Spark's event log written to a scratch
folder. Prints, per run, the largest number of shuffle records one task
read and the median (in the stage with the largest task), from the
task-end events of the log.

usage: python scripts/skew_probe.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from clickweave.operators import features as feat  # noqa: E402
from clickweave.operators import runs  # noqa: E402
from clickweave.session import get_session  # noqa: E402
from clickweave.sources.fixtures import behavior_events  # noqa: E402


def task_reads(log_dir: str) -> dict[int, list[int]]:
    """stage id -> shuffle records read by each task."""
    out: dict[int, list[int]] = {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path) or path.endswith(".inprogress.tmp"):
            continue
        with open(path, errors="ignore") as fh:
            for line in fh:
                if '"SparkListenerTaskEnd"' not in line:
                    continue
                try:
                    ev = json.loads(line)
                except json.JSONDecodeError:
                    continue
                m = ev.get("Task Metrics") or {}
                n = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                if n:
                    out.setdefault(ev["Stage ID"], []).append(n)
    return out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="skew-eventlog-")
    spark = get_session("local[8]", 16, app_name="skew-probe",
                        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                               "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
                               "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    events = behavior_events(spark, sf_dir)
    hot = F.col("event_id") % 3 == 0
    spread_out = events.withColumn("user_id", F.when(hot, F.lit("user_hot")).otherwise(F.col("user_id")))
    # the same hot user as a bot: its third of the events packed into one hour
    burst = spread_out.withColumn("timestamp", F.when(
        hot, F.timestamp_seconds(F.lit(1705276800) + F.col("event_id") % 3600)).otherwise(F.col("timestamp")))
    total = spread_out.count()

    def plain_runs(df, ttl=86400):
        """Textbook gaps-and-islands over the whole key (one task per user)."""
        w = Window.partitionBy("user_id").orderBy("timestamp")
        gap = F.col("timestamp").cast("long") - F.lag(F.col("timestamp").cast("long")).over(w)
        flagged = df.withColumn("_new", F.when(gap.isNull() | (gap >= ttl), 1).otherwise(0))
        numbered = flagged.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        return numbered.groupBy("user_id", "_run").agg(F.count(F.lit(1)).alias("events"))

    jobs = {
        "windows_plain": lambda df: feat.add_aggregated_features(df, bucket_seconds=None),
        "windows_per_second": lambda df: feat.add_aggregated_features(df),
        "runs_plain": plain_runs,
        "runs_per_second": lambda df: runs.run_summary(df, "user_id", 86400),
    }
    results = {}
    for scenario, frame in (("spread", spread_out), ("burst", burst)):
        for label, build in jobs.items():
            spark.sparkContext.setJobGroup(label, label)
            before = set(task_reads(log_dir))
            t0 = time.perf_counter()
            build(frame).write.format("noop").mode("overwrite").save()
            secs = time.perf_counter() - t0
            time.sleep(2)  # let the log flush
            stages = {k: v for k, v in task_reads(log_dir).items() if k not in before}
            biggest = max(stages.values(), key=max)
            results[f"{scenario}/{label}"] = {
                "seconds": round(secs, 2), "max_task_records": max(biggest),
                "median_task_records": int(statistics.median(biggest)), "tasks": len(biggest)}
    print(json.dumps({"rows": total, "hot_user_rows": total // 3 + 1, **results}))
    spark.stop()


if __name__ == "__main__":
    main()
