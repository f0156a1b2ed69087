"""Findings of round 3: bounded tasks of the queries by days, record files in
one pass, live tables and stream state in buckets of keys."""

import uuid

import pytest
from conftest import ev
from pyspark.sql import functions as F

from clickweave.operators import daily
from clickweave.plans.catalog import QUERIES
from clickweave.session import scratch_path


@pytest.fixture(scope="module")
def own_dir(spark):
    """A folder with an ``events`` table of 12 days, seven users, some seconds shared."""
    base = scratch_path(spark, f"own-{uuid.uuid4().hex}")
    t = F.timestamp_seconds(F.lit(1_704_067_200) + (F.col("id") % 12) * 86_400 + (F.col("id") * 137) % 80_000)
    spark.range(600).select(
        F.col("id").alias("event_id"), t.cast("timestamp_ntz").alias("ts"), (F.col("id") * 31 % 7).alias("user_id"),
        F.element_at(F.array(*map(F.lit, ["view", "click", "signup", "purchase"])), (F.col("id") % 4 + 1).cast("int")).alias("event_type"),
        (F.col("id") % 90 + 0.25).alias("value"), F.format_string('{"k": %d}', F.col("id") % 50).alias("props")) \
        .coalesce(1).write.parquet(f"{base}/events.parquet")
    return base


def test_rolling_days_are_written_one_by_one(spark, own_dir):
    """no task reads a piece of every day."""
    got = QUERIES["rolling_interactions"](spark, own_dir)
    assert "Union" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert got.select("day").distinct().count() == 12
    # on the last day: the events of the last seven
    events = spark.read.parquet(f"{own_dir}/events.parquet").where("ts >= '2024-01-06'")
    weight = F.expr("CASE event_type WHEN 'purchase' THEN 4 WHEN 'signup' THEN 3 WHEN 'click' THEN 2 ELSE 1 END")
    want = {r[0]: (r[1], r[2]) for r in events.groupBy(F.format_string("user_%06d", "user_id")).agg(
        F.countDistinct("props"), F.sum(weight)).collect()}
    assert {r.user_id: (r.products, r.score) for r in got.where("day = '2024-01-12'").collect()} == want


def test_a_day_set_of_few_values_takes_few_bytes(spark, make_events):
    """a row of bits is one long, however few values a key had."""
    events = make_events([ev(user="u", product=f"p{i:03d}") for i in range(130)] + [ev(user="v", product="p129"), ev(user=None, product="p000")])
    sets = daily.day_sets(events, ["user_id"], "product_id", daily.extend_labels(None, events, "product_id"))
    assert dict(sets.dtypes)["bits"] == "bigint"
    assert {r.user_id: r["count"] for r in sets.groupBy("user_id").count().collect()} == {"u": 3, "v": 1, None: 1}
    got = daily.distinct_counts(sets, ["user_id"], "n")
    assert {tuple(r) for r in got.collect()} == {("u", 130), ("v", 1), (None, 1)} and got.schema["n"].dataType.simpleString() == "bigint"


def test_record_files_are_made_from_their_own_day(spark, make_events):
    """The events are read once; every day has as many files, none of them empty."""
    from clickweave.streaming import records
    rows = [ev(event_id=100 * d + i, ts=f"2024-01-0{d} 10:00:{i:02d}") for d in (1, 2, 3) for i in range(3 * d)]
    read = spark.sparkContext.accumulator(0)
    ids = spark.sparkContext.parallelize([r[-1] for r in rows], 2).map(lambda i: (read.add(1), (i,))[1])
    events = make_events(rows).join(spark.createDataFrame(ids, "event_id long"), "event_id")
    staged = records.stage_days(events, late_days=F.when(F.col("offset") == 100, 2).otherwise(0))
    assert staged.rows == {"d20240101": 2, "d20240102": 6, "d20240103": 10}
    assert records.even_files(staged) == 1 and records.even_files(staged, rows_per_file=3) == 2  # the smallest day has two rows
    src = scratch_path(spark, f"even-{uuid.uuid4().hex}")
    folders = records.write_days(spark, staged, src, files_per_day=2) + records.write_days(spark, staged, src, files_per_day=2, suffix="r1")
    assert [f.rsplit("/", 1)[1] for f in folders] == ["d20240101", "d20240102", "d20240103", "d20240101r1", "d20240102r1", "d20240103r1"]
    assert read.value == len(rows)
    for f in folders:
        got = spark.read.schema(records.RECORD_SCHEMA).json(f"{f}/*.json")
        assert got.select("_metadata.file_name").distinct().count() == 2
    want = records.to_records(events)
    got = spark.read.schema(records.RECORD_SCHEMA).json(f"{src}/d2024010[123]/*.json")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def _batches(monkeypatch, cls, rows_by_bucket, wm=0):
    """Calls of a processor by hand, with states that count how often they are used."""
    import pandas as pd

    class State:
        def __init__(self):
            self.held, self.uses = None, 0

        def get(self):
            self.uses += 1
            return self.held

        def update(self, value):
            self.uses += 1
            self.held = value

        def clear(self):
            self.held = None

    class Handle:
        def __init__(self):
            self.states, self.timers = {}, []

        def getValueState(self, name, schema):
            return self.states.setdefault(name, State())

        def listTimers(self):
            return iter(self.timers)

        def deleteTimer(self, t):
            self.timers.remove(t)

        def registerTimer(self, t):
            self.timers.append(t)

    class Timers:
        now = wm

        def getCurrentWatermarkInMs(self):
            return self.now

    handle = Handle()
    cls.init(handle)
    return handle, Timers(), lambda frame, timers: pd.concat(cls.handleInputRows((0,), iter([frame]), timers))


def test_a_bucket_of_sessions_takes_few_uses_of_the_state(monkeypatch):
    """Keys of a bucket are handled together; an expired key leaves the state."""
    import pandas as pd
    from clickweave.streaming import live_serving as live
    p = live.SessionRecord(60)
    handle, timers, call = _batches(monkeypatch, p, None)
    t = pd.Timestamp("2024-01-05 10:00:00")
    frame = pd.DataFrame({"session_id": [f"s{i % 500}" for i in range(1500)], "timestamp": [t + pd.Timedelta(seconds=i // 500) for i in range(1500)],
                          "user_id": [f"u{i}" for i in range(1500)]})
    got = call(frame, timers)
    assert len(got) == 500 and set(got["action_count"]) == {3} and got.set_index("session_id").loc["s7", "user_id"] == "u7"
    assert handle.states["records"].uses == 2 and len(handle.timers) == 1
    again = call(pd.DataFrame({"session_id": ["s1", "s2"], "timestamp": [t + pd.Timedelta(seconds=61), t + pd.Timedelta(seconds=62)], "user_id": ["x", "y"]}), timers)
    assert again.set_index("session_id")["action_count"].to_dict() == {"s1": 4, "s2": 1}
    timers.now = int((t + pd.Timedelta(seconds=62)).timestamp() * 1000)
    list(p.handleExpiredTimer((0,), timers, None))
    assert set(live.load_table(handle.states["records"], p.RECORDS)["key"]) == {"s1", "s2"}


def test_seen_offsets_are_one_value_of_the_state(monkeypatch):
    """offsets with gaps are not a row of state each."""
    import pandas as pd
    from clickweave.streaming import once
    p = once.SeenOffsets(["offset"])
    handle, timers, call = _batches(monkeypatch, p, None)
    frame = pd.DataFrame({"offset": range(0, 1000, 2)})
    assert len(call(frame, timers)) == 500
    assert not list(p.handleInputRows((0,), iter([frame]), timers))
    assert handle.states["intervals"].uses == 4 and len(handle.states["intervals"].held[0]) == 500 * 16


def test_users_of_a_bucket_do_not_blur_each_other():
    """users of a bucket are handled together, each with sums of its own; state goes on."""
    import pandas as pd
    from clickweave.streaming.stateful import RecentActivity
    t = pd.Timestamp("2024-01-05 10:00:00")
    cols = ["user_id", "session_id", "action_type", "product_price", "timestamp"]
    p = RecentActivity(cols, 600)
    handle, timers, _ = _batches(None, type("P", (), {"init": lambda self, h: None})(), None)

    class Map(dict):
        def getValue(self, k):
            return self.get(k)

        def updateValue(self, k, v):
            self[k] = v
    handle.getMapState = lambda *a: Map()
    p.init(handle)
    rows = [("a", "s", "view", 1e30, t), ("b", "s", "view", 2.0, t), ("b", "s", "view", 4.0, t), (None, None, "add_to_cart", 1.0, t)]
    out = next(p.handleInputRows((0,), iter([pd.DataFrame(rows, columns=cols)]), timers))
    assert out["avg_price_viewed"].tolist()[:3] == [1e30, 3.0, 3.0] and out["action_sequence"].tolist() == [1, 1, 2, 1]
    out = next(p.handleInputRows((0,), iter([pd.DataFrame([("b", "s", "view", 6.0, t + pd.Timedelta(seconds=600))], columns=cols)]), timers))
    assert out.iloc[0][["action_sequence", "session_action_count", "recent_view_count", "avg_price_viewed"]].tolist() == [3, 3, 3, 4.0]
