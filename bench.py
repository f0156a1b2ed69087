"""Headline queries on one scale-factor folder; prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
The events of the folder are first written to the event lake (timed as
``lake_write``, not summed); the batch queries then read the lake, as the
training and summary jobs do. Every query is run to completion with the
``noop`` sink (full execution, nothing collected); the value is the sum of
the per-query wall times. The stream job is reported separately.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from clickweave.operators import aggregates as agg  # noqa: E402
from clickweave.operators import features as feat  # noqa: E402
from clickweave.operators import recommend as rec  # noqa: E402
from clickweave.operators import runs, serving  # noqa: E402
from clickweave.session import checkpoint, get_session  # noqa: E402
from clickweave.sources.fixtures import behavior_events  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus * 2, app_name="clickweave-bench",
                        extra={"spark.driver.memory": "8g"})
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")

    def als(events):
        scores = checkpoint(agg.interaction_strength(events))
        dicts = rec.fit_indexers(scores)
        model = rec.fit_als(rec.encode(scores, dicts))
        return rec.recommend_all(model, dicts, n=10)

    queries = {
        "feature_pipeline": lambda e: feat.process_user_behavior(e),
        "interaction_strength": lambda e: agg.interaction_strength(e),
        "user_features": lambda e: agg.user_features(e),
        "product_features": lambda e: agg.product_features(e),
        "recent_behaviors": lambda e: serving.recent_behaviors(e, n=100),
        "category_interests": lambda e: serving.category_interests(e),
        "price_preferences": lambda e: serving.price_preferences(e),
        "action_counts": lambda e: serving.action_counts(e),
        "session_summary": lambda e: serving.session_summary(e),
        "expiry_runs_1d": lambda e: runs.run_summary(e, "user_id", 86400),
        "als_recommend_all": als,
    }
    # JIT / codegen warm-up on the smallest folder (not timed)
    if os.path.isdir(warm_dir):
        small = behavior_events(spark, warm_dir)
        for build in queries.values():
            run(build(small))
    import uuid
    from clickweave.session import scratch_path
    from clickweave.sources.lake import read_lake, write_lake
    raw = behavior_events(spark, sf_dir)
    lake_path = scratch_path(spark, f"bench-lake-{uuid.uuid4().hex}")
    t0 = time.perf_counter()
    write_lake(raw, lake_path)
    lake_write = time.perf_counter() - t0
    events = read_lake(spark, lake_path)
    run(events.select(F.count(F.lit(1))))
    times = {}
    for name, build in queries.items():
        t0 = time.perf_counter()
        run(build(events))
        times[name] = round(time.perf_counter() - t0, 3)
    # end-to-end stream job: record files -> decode -> lake + features +
    # serving sinks, ten day-files per micro-batch (not part of the sum)
    from clickweave.streaming import micro_batch as mb
    from clickweave.streaming import records
    src = scratch_path(spark, f"bench-records-{uuid.uuid4().hex}")
    records.write_record_files(raw, src)
    out = scratch_path(spark, f"bench-stream-{uuid.uuid4().hex}")
    t0 = time.perf_counter()
    q = mb.start_stream(mb.decode_stream(records.read_record_stream(spark, src, max_files=10)),
                        checkpoint=f"{out}/ckpt", lake_path=f"{out}/lake", serving_path=f"{out}/serving",
                        features_path=f"{out}/features", available_now=True)
    q.awaitTermination()
    stream_sec = time.perf_counter() - t0
    n_events = events.count()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "sum_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "rows": n_events, "cpus": cpus, "lake_write_sec": round(lake_write, 3),
                      "stream_job_sec": round(stream_sec, 3),
                      "stream_events_per_sec": round(n_events / stream_sec, 1)}))
    spark.stop()


if __name__ == "__main__":
    main()
