import uuid

from conftest import SF_SMALL

from clickweave.operators import recommend as rec
from clickweave.operators import runs, serving
from clickweave.plans.train import train
from clickweave.session import scratch_path
from clickweave.sources import lake
from clickweave.sources.fixtures import behavior_events
from clickweave.sources.models import load_model


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_train_job_on_a_day_of_the_lake(spark):
    path = scratch_path(spark, f"lake-{uuid.uuid4().hex}")
    lake.write_lake(behavior_events(spark, SF_SMALL), path)
    start, end = lake.day_range("2024-01-10")
    root = train(spark, path, start, end, scratch_path(spark, "models"), max_iter=3, version="t1")
    model, dicts = load_model(spark, root)
    day_users = lake.time_range(lake.read_lake(spark, path), start, end).select("user_id").distinct()
    assert dicts.users.count() == day_users.count()
    out = rec.recommend(model, dicts, day_users, n=3)
    assert out.select("user_id").distinct().count() == day_users.count()


def test_top_n_is_limited_before_the_shuffle(spark):
    plan = _plan(serving.recent_behaviors(behavior_events(spark, SF_SMALL), n=10, ttl_seconds=None))
    assert plan.count("WindowGroupLimit") >= 2


def _first_reducer_above_scans(plan: str) -> list[str]:
    """For every file scan of a plan text, the first ancestor that is an
    Exchange or a map-side reduction (partial aggregate / partial limit)."""
    lines = plan.splitlines()

    def depth(line):
        i = line.find("+- ")
        return i if i >= 0 else (len(line) - len(line.lstrip(" :")))

    found = []
    for i, line in enumerate(lines):
        if "FileScan" not in line:
            continue
        d, hit = depth(line), None
        for j in range(i - 1, -1, -1):
            if depth(lines[j]) < d:
                d = depth(lines[j])
                if "Exchange" in lines[j] or "partial_" in lines[j] or "Partial" in lines[j]:
                    hit = "exchange" if "Exchange" in lines[j] else "reduce"
                    break
        found.append(hit)
    return found


def test_serving_summaries_reduce_events_before_any_shuffle(spark):
    """Runs, counters and newest-n never shuffle whole event rows: every
    scan is partial-aggregated per (key, second) or top-n limited first."""
    events = behavior_events(spark, SF_SMALL)
    for df in (serving.category_interests(events), serving.recent_behaviors(events),
               serving.session_summary(events), runs.run_summary(events, "user_id", 86400),
               runs.run_summary(events, "user_id", 86400)):
        hits = _first_reducer_above_scans(_plan(df))
        assert hits and all(h == "reduce" for h in hits), hits
    # the runs and the summary's per-second values: two scans; the branch
    # that carries runs across buckets reuses the runs' shuffle
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = runs.run_summary(events, "user_id", 86400) \
            ._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("FileScan parquet") == 2 and plan.count("ReusedExchange") == 1


def test_recommend_jobs(spark):
    from clickweave.plans.recommend_job import recommend_everyone, recommend_users
    path = scratch_path(spark, f"lake-{uuid.uuid4().hex}")
    lake.write_lake(behavior_events(spark, SF_SMALL), path)
    models = scratch_path(spark, f"models-{uuid.uuid4().hex}")
    root = train(spark, path, None, None, models, max_iter=2, version="all")
    got = recommend_users(spark, root, ["user_000001", "user_000002", "nobody"], n=4)
    assert sorted({r.user_id for r in got.collect()}) == ["user_000001", "user_000002"]
    out = recommend_everyone(spark, root, scratch_path(spark, f"recs-{uuid.uuid4().hex}"), n=3)
    assert spark.read.parquet(out).groupBy("user_id").count().agg({"count": "max"}).first()[0] == 3
