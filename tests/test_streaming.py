import pytest
import uuid

from conftest import SF_SMALL
from pyspark.sql import functions as F

from clickweave.operators import serving
from clickweave.schema import EVENT_COLUMNS
from clickweave.session import scratch_path
from clickweave.sources import lake
from clickweave.sources.fixtures import behavior_events
from clickweave.sources.serving_store import read_serving
from clickweave.streaming import micro_batch as mb
from clickweave.streaming import records


def test_replayed_batch_changes_nothing(spark):
    base = scratch_path(spark, f"sink-{uuid.uuid4().hex}")
    events = behavior_events(spark, SF_SMALL).drop("event_id")
    sink = mb.BatchSink(lake_path=f"{base}/lake", serving_path=f"{base}/serving")
    half1 = events.where("timestamp < '2024-01-15'")
    half2 = events.where("timestamp >= '2024-01-15'")
    sink(half1, 0)
    sink(half2, 1)
    sink(half2, 1)                       # foreachBatch replay of batch 1
    assert lake.read_lake(spark, f"{base}/lake").count() == events.count()
    assert sink.counts == {0: half1.count(), 1: half2.count()}
    merged = read_serving(spark, f"{base}/serving", "action_counts")
    direct = serving.action_counts(events)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, direct.collect()))
    rb = read_serving(spark, f"{base}/serving", "recent_behaviors", n=10)
    assert rb.groupBy("user_id").count().agg(F.max("count")).first()[0] == 10
    sess = read_serving(spark, f"{base}/serving", "session_summary")
    assert sess.count() == events.select("session_id").distinct().count()


def test_serving_tables_of_two_runs_in_any_order_equal_batch(spark, make_events):
    """Events dealt at random to the batches of two runs, so that batches
    overlap and come late, with times equal and below a second apart."""
    import random
    from datetime import datetime, timedelta

    from conftest import ev

    from clickweave.sources.serving_store import TABLES
    rnd, t, rows = random.Random(5), datetime(2024, 1, 5), []
    for i in range(300):
        t += timedelta(milliseconds=rnd.choice([0, 300, 700, 500_000, 3_600_000, 3_600_100]))
        rows.append(ev(user=f"u{rnd.randrange(3)}", session=f"s{rnd.randrange(4)}", ts=t, price=float(rnd.randrange(600)),
                       category=rnd.choice(["Books", "Toys"]), action=rnd.choice(["view", "click"]), event_id=i))
    base = scratch_path(spark, f"runs-{uuid.uuid4().hex}")
    piece = [rnd.randrange(4) for _ in rows]
    ttls = dict.fromkeys(TABLES, 3600)
    for k in (3, 1, 0, 2, 3):            # the last one is a replay
        sink = mb.BatchSink(serving_path=base, run_id="ab"[k % 2], ttls=ttls)
        sink(make_events([r for r, p in zip(rows, piece) if p == k]), k // 2)
    events = make_events(rows)
    as_of = rows[-1][3] + timedelta(minutes=30)
    for when in (None, as_of):
        for name in ("category_interests", "price_preferences", "action_counts", "session_summary"):
            got = read_serving(spark, base, name, ttl_seconds=3600, as_of=when)
            want = getattr(serving, name)(events, ttl_seconds=3600, as_of=when)
            assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect())), name
        got = read_serving(spark, base, "recent_behaviors", n=7, ttl_seconds=3600, as_of=when)
        want = serving.recent_behaviors(events, n=7, ttl_seconds=3600, as_of=when)
        cols = ["user_id", "rank", "timestamp"]
        assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))


def test_restart_keeps_its_run_and_a_new_checkpoint_adds(spark):
    src, out = (scratch_path(spark, f"{k}-{uuid.uuid4().hex}") for k in ("rec", "out"))
    events = behavior_events(spark, SF_SMALL).where("timestamp < '2024-01-04'")
    records.write_record_files(events.where("timestamp < '2024-01-03'"), src)

    def run(checkpoint):
        stream = mb.decode_stream(records.read_record_stream(spark, src))
        mb.start_stream(stream, f"{out}/{checkpoint}", f"{out}/lake", quarantine_path=f"{out}/bad",
                        available_now=True).awaitTermination()
        return lake.read_lake(spark, f"{out}/lake").count()

    first = events.where("timestamp < '2024-01-03'").count()
    assert run("a") == first and run("a") == first
    records.write_record_files(events.where("timestamp >= '2024-01-03'"), src)
    assert run("a") == events.count()
    assert run("b") == 2 * events.count()
    assert spark.read.parquet(f"{out}/lake").select("run_id").distinct().count() == 2


def test_status_and_stop_of_running_queries(spark):
    src, out = (scratch_path(spark, f"{k}-{uuid.uuid4().hex}") for k in ("rec", "out"))
    records.write_record_files(behavior_events(spark, SF_SMALL).where("timestamp < '2024-01-02'"), src)
    stream = mb.decode_stream(records.read_record_stream(spark, src))
    q = mb.start_stream(stream, f"{out}/a", f"{out}/lake", trigger="1 second", name="timed")
    assert [r.name for r in mb.status(spark).where("is_active").collect()] == ["timed"]
    assert not mb.run_for(q, 0.5).isActive
    mb.start_stream(stream, f"{out}/b", f"{out}/lake", trigger="1 second")
    assert mb.stop_all(spark) == 1 and mb.status(spark).count() == 0


def test_file_stream_end_to_end(spark):
    src = scratch_path(spark, f"rec-{uuid.uuid4().hex}")
    out = scratch_path(spark, f"run-{uuid.uuid4().hex}")
    events = behavior_events(spark, SF_SMALL).where("timestamp < '2024-01-04'")
    folders = records.write_record_files(events, src)
    assert len(folders) == 3
    stream = mb.decode_stream(records.read_record_stream(spark, src, max_files=1))
    q = mb.start_stream(stream, checkpoint=f"{out}/ckpt", lake_path=f"{out}/lake",
                        serving_path=f"{out}/serving", available_now=True, name="e2e")
    q.awaitTermination()
    assert len(q.sink_counts) == 3 and sum(q.sink_counts.values()) == events.count()
    assert lake.read_lake(spark, f"{out}/lake").select(*EVENT_COLUMNS).count() == events.count()
    assert mb.status(spark).count() == 0 and mb.stop_all(spark) == 0


def test_live_counters_restart_after_ttl(spark, make_events):
    from datetime import datetime, timedelta

    from conftest import ev

    from clickweave.streaming import live_serving, stateful
    stateful.configure(spark)
    base = datetime(2024, 1, 5)
    rows = [ev(ts=base, category="Books", event_id=1),
            ev(ts=base + timedelta(hours=1), category="Books", event_id=2),
            ev(ts=base + timedelta(days=1, hours=1), category="Toys", event_id=3),   # gap == TTL
            ev(ts=base + timedelta(days=1, hours=2), category="Toys", event_id=4)]
    src = scratch_path(spark, f"rec-{uuid.uuid4().hex}")
    records.write_record_files(make_events(rows), src)
    out = scratch_path(spark, f"live-{uuid.uuid4().hex}")
    events = mb.decode_stream(records.read_record_stream(spark, src, max_files=1)).select(*EVENT_COLUMNS)
    q = (live_serving.live_counters(events, 86400).writeStream.outputMode("update")
         .foreachBatch(lambda df, b: df.withColumn("b", F.lit(b)).write.mode("append").parquet(f"{out}/o"))
         .option("checkpointLocation", f"{out}/c").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(f"{out}/o")
    last = got.where(F.col("b") == got.agg(F.max("b")).first()[0])
    cats = {r.field: r["count"] for r in last.where("kind = 'category_interests'").collect()}
    assert cats == {"Toys": 2}


def test_stateful_dense_bot_across_midnight_equals_batch(spark, make_events):
    """Ten events a second of one user in two sessions, across two day
    files (two micro-batches); the per-second state gives the batch result."""
    from datetime import datetime, timedelta

    from conftest import ev

    from clickweave.operators import features as feat
    from clickweave.streaming import stateful
    stateful.configure(spark)
    base = datetime(2024, 1, 5, 23, 59, 0)
    rows = [ev(user="bot", session=["a", "b"][i % 2], ts=base + timedelta(milliseconds=100 * i),
               action=["view", "add_to_cart", "view", "click"][i % 4],
               price=None if i % 9 == 0 else float(i % 11), event_id=i) for i in range(1200)]
    df = make_events(rows)
    src = scratch_path(spark, f"rec-{uuid.uuid4().hex}")
    assert len(records.write_record_files(df, src)) == 2
    out = scratch_path(spark, f"state-{uuid.uuid4().hex}")
    events = mb.decode_stream(records.read_record_stream(spark, src, max_files=1)).select(*EVENT_COLUMNS)
    q = (stateful.stateful_features(events).writeStream.format("parquet").option("path", f"{out}/f")
         .option("checkpointLocation", f"{out}/c").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    cols = ["session_id", "timestamp", *feat.WINDOW_COLS]
    got = sorted(tuple(r) for r in spark.read.parquet(f"{out}/f").select(*cols).collect())
    want = sorted(tuple(r) for r in feat.add_aggregated_features(df, bucket_seconds=None).select(*cols).collect())
    assert len(got) == 1200
    for g, w in zip(got, want):
        assert g[:6] == w[:6]
        assert (g[6] is None and w[6] is None) or abs(g[6] - w[6]) < 1e-9


def test_live_serving_dense_seconds_equal_batch(spark, make_events):
    """Several events a second, gaps of exactly TTL and TTL +- 100 us, ties,
    across midnight (two micro-batches): live counters and session records
    equal the batch serving tables with the same 2 s TTL."""
    from datetime import datetime, timedelta

    from conftest import ev

    from clickweave.functions import format_time
    from clickweave.streaming import live_serving, stateful
    stateful.configure(spark)
    steps = [0, 100_000, 2_000_000, 300_000, 1_999_900, 2_000_100, 0, 50_000]
    t, rows = datetime(2024, 1, 5, 23, 59, 50), []
    for i in range(64):
        t = t + timedelta(microseconds=steps[i % len(steps)])
        rows.append(ev(user="bot", session="s", ts=t, category=["Books", "Toys", "Food"][i % 3],
                       price=float(10 + 37 * (i % 5)), action=["view", "click", "purchase"][i % 3],
                       event_id=i))
    df = make_events(rows)
    src = scratch_path(spark, f"rec-{uuid.uuid4().hex}")
    assert len(records.write_record_files(df, src)) == 2
    out = scratch_path(spark, f"live-{uuid.uuid4().hex}")

    def run(build, name):
        events = mb.decode_stream(records.read_record_stream(spark, src, max_files=1)).select(*EVENT_COLUMNS)
        q = (build(events).writeStream.outputMode("update")
             .foreachBatch(lambda b, i: b.withColumn("b", F.lit(i)).write.mode("append").parquet(f"{out}/{name}"))
             .option("checkpointLocation", f"{out}/c-{name}").trigger(availableNow=True).start())
        q.awaitTermination()
        got = spark.read.parquet(f"{out}/{name}")
        return got.where(F.col("b") == got.agg(F.max("b")).first()[0])

    counters = run(lambda e: live_serving.live_counters(e, 2), "counters")
    for kind, batch in (("category_interests", serving.category_interests(df, ttl_seconds=2)),
                        ("price_preferences", serving.price_preferences(df, ttl_seconds=2).drop("rank")),
                        ("action_counts", serving.action_counts(df, ttl_seconds=2))):
        live = counters.where(F.col("kind") == kind).select("user_id", "field", "count")
        assert sorted(map(tuple, live.collect())) == sorted(map(tuple, batch.collect())), kind
    sessions = run(lambda e: live_serving.live_sessions(e, 2), "sessions").select(
        "session_id", "user_id", format_time("start_time").alias("start_time"),
        format_time("last_activity").alias("last_activity"), "action_count")
    assert sorted(map(tuple, sessions.collect())) == \
        sorted(map(tuple, serving.session_summary(df, ttl_seconds=2).collect()))


def test_drop_policy_needs_the_record_columns(spark):
    events = behavior_events(spark, SF_SMALL)
    with pytest.raises(ValueError, match="offset"):
        mb.apply_late_policy(events, "drop")
