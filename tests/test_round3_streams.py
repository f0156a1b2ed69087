"""Findings F7, F8, F10 and F11 of round 3: what a micro-batch recomputes and shuffles."""

import os
import re
import uuid

from conftest import ev
from pyspark.sql import functions as F

from clickweave.session import scratch_path
from clickweave.sources import serving_store
from clickweave.streaming import lookback, records
from clickweave.streaming import micro_batch as mb


def as_records(df):
    return df.withColumns({"topic": F.lit("t"), "partition": F.lit(0), "offset": F.col("event_id")}).drop("event_id")


def passes(df):
    """Shuffles of whole rows for the windows."""
    return len(re.findall(r"RepartitionByExpression \[user_id#\d+, _sec", df._jdf.queryExecution().optimizedPlan().toString()))


def test_a_batch_and_what_it_changes_are_computed_in_one_pass(spark, make_events):
    """one pass gives the batch's features and the corrections; what is held is released."""
    base = scratch_path(spark, f"late-{uuid.uuid4().hex}")
    sink = mb.BatchSink(lake_path=f"{base}/lake", features_path=f"{base}/f", feature_mode="lookback")
    early = [ev(user="a", session=f"s{i}", ts=f"2024-01-05 {i:02d}:00:00", event_id=i) for i in range(24)] + \
        [ev(user="a", session=None, ts="2024-01-05 12:05:00", event_id=24), ev(user="b", session="s5", ts="2024-01-05 13:00:00", event_id=25)]
    sink(as_records(make_events(early)), 0)
    late = as_records(make_events([ev(user="a", session="s5", ts="2024-01-05 04:59:00", event_id=30),
                                   ev(user="a", session="x", ts="2024-01-05 12:01:00", event_id=31),
                                   ev(user="b", session="y", ts="2024-01-06 13:00:00", event_id=32)]))
    held = []
    got = lookback.lookback_features(late, f"{base}/lake", f"{base}/f", "stream", 1, held=held)
    assert passes(got) == 1
    before, behind = held
    again = {r.offset for r in behind.collect()}
    assert again == set(range(5, 25)) and before.count() + behind.count() == 26
    fixed = sorted((r.offset, r.sign, r.action_sequence, r.recent_view_count) for r in got.where("offset < 30").collect())
    assert fixed == [(5, -1, 1, 1), (5, 1, 2, 2), (24, -1, 1, 2), (24, 1, 1, 3)]
    for rows in held:
        rows.unpersist()
    was = len(list(spark.sparkContext._jsc.getPersistentRDDs()))
    sink(late, 1)
    assert len(list(spark.sparkContext._jsc.getPersistentRDDs())) <= was
    assert spark.read.parquet(f"{base}/f").where("sign = -1").count() == 2


def test_a_batch_in_time_order_reads_no_features(spark, make_events):
    """rows behind everything in the lake change nothing, so the features table is not met."""
    base = scratch_path(spark, f"order-{uuid.uuid4().hex}")
    sink = mb.BatchSink(lake_path=f"{base}/lake", features_path=f"{base}/f", feature_mode="lookback")
    sink(as_records(make_events([ev(ts="2024-01-05 10:00:00", event_id=0)])), 0)
    held = []
    got = lookback.lookback_features(as_records(make_events([ev(ts="2024-01-05 10:00:01", event_id=1)])), f"{base}/lake", f"{base}/f", "stream", 1, held=held)
    assert len(held) == 1 and f"{base}/f" not in "".join(got.inputFiles())
    assert [(r.offset, r.sign, r.action_sequence, r.recent_view_count) for r in got.collect()] == [(1, 1, 2, 2)]
    held[0].unpersist()


def test_an_event_is_one_row_until_its_run_is_known(spark, make_events):
    """The three kinds of counters are taken apart behind the join with the runs."""
    events = make_events([ev(category="Books", price=10.0, action="view", ts=f"2024-01-05 10:00:0{i}") for i in range(3)])
    counters = serving_store.batch_tables(events, dict.fromkeys(serving_store.TABLES, 60))["counters"]
    plan = counters._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.index("Generate") < plan.index("Join ")
    got = {r.kind: (r.field, r["count"]) for r in counters.collect()}
    assert got["category_interests"] == ("Books", 3) and got["action_counts"] == ("view", 3) and len(got) == 3
    runs = serving_store.batch_tables(events, {})["recent_runs"]
    assert [(r.user_id, str(r.run_start), str(r._last)) for r in runs.collect()] == [("u1", "2024-01-05 10:00:00", "2024-01-05 10:00:02")]


def test_days_of_a_micro_batch_are_written_side_by_side(spark, make_events):
    """Days within a group at once, groups in order."""
    rows = [ev(event_id=10 * d + i, ts=f"2024-01-0{d} 10:00:{i:02d}") for d in range(1, 6) for i in range(2)]
    src = scratch_path(spark, f"side-{uuid.uuid4().hex}")
    folders = records.write_days(spark, records.stage_days(make_events(rows)), src, at_once=2)
    assert [f.rsplit("/", 1)[1] for f in folders] == [f"d2024010{d}" for d in range(1, 6)]
    local = [f.removeprefix("file:") for f in folders]
    times = [[os.path.getmtime(f"{f}/{n}") for n in os.listdir(f) if n.endswith(".json")] for f in local]
    assert all(len(t) == 1 for t in times)
    assert max(times[0] + times[1]) <= min(times[2] + times[3]) and max(times[2] + times[3]) <= times[4][0]
    assert spark.read.schema(records.RECORD_SCHEMA).json(f"{src}/*/*.json").count() == 10
