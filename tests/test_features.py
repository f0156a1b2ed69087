from datetime import datetime, timedelta

import pytest
from conftest import SF_SMALL, ev

from clickweave.operators import features as feat
from clickweave.sources.fixtures import behavior_events

COLS = ["action_sequence", "session_action_count", "recent_view_count", "recent_cart_count",
        "avg_price_viewed"]


def _rows(df, order="event_id"):
    return [tuple(r) for r in df.orderBy(order).select(order, *COLS).collect()]


def test_running_count_counts_peers(make_events):
    rows = [ev(ts="2024-01-05 10:00:00", event_id=1), ev(ts="2024-01-05 10:00:00", event_id=2),
            ev(ts="2024-01-05 10:00:05", event_id=3)]
    out = _rows(feat.add_aggregated_features(make_events(rows), tie_break="event_id"))
    assert [r[1] for r in out] == [1, 2, 3]          # action_sequence
    assert [r[2] for r in out] == [2, 2, 3]          # session_action_count (running, with peers)


def test_recent_frame_edges(make_events):
    base = datetime(2024, 1, 5, 10, 0, 0)
    rows = [ev(ts=base, price=10.0, event_id=1),
            ev(ts=base + timedelta(seconds=600), price=20.0, event_id=2),       # 600 s: inside
            ev(ts=base + timedelta(seconds=1201, microseconds=900000), price=30.0, event_id=3),  # 601.9 s
            ev(ts=base + timedelta(seconds=1201, microseconds=100), action="add_to_cart", event_id=4)]
    out = {r[0]: r for r in _rows(feat.add_aggregated_features(make_events(rows)))}
    assert out[2][3] == 2 and out[2][5] == 15.0
    # whole-second truncation: 1201 - 600 = 601 -> event 2 (600) is out, the cart at 1201 is a peer
    assert out[3][3] == 1 and out[3][4] == 1 and out[3][5] == 30.0
    assert out[4][3] == 1 and out[4][4] == 1


def test_no_views_gives_null_avg(make_events):
    out = _rows(feat.add_aggregated_features(make_events([ev(action="click", event_id=1)])))
    assert out[0][5] is None and out[0][3] == 0


@pytest.mark.parametrize("frame,bucket", [(600, 3600), (600, 600), (3600, 7200), (86400, 86400)])
def test_bucketed_equals_plain_on_fixture(spark, frame, bucket):
    events = behavior_events(spark, SF_SMALL)
    split = feat.add_aggregated_features(events, recent_seconds=frame, bucket_seconds=bucket)
    plain = feat.add_aggregated_features(events, recent_seconds=frame, bucket_seconds=None)
    a, b = _rows(split), _rows(plain)
    assert len(a) == 1000
    for x, y in zip(a, b):
        assert x[:5] == y[:5]
        assert (x[5] is None and y[5] is None) or abs(x[5] - y[5]) < 1e-9


def test_hot_user_split_across_buckets(make_events):
    """One user with a long session crossing many buckets, plus null users."""
    base = datetime(2024, 1, 5, 0, 0, 0)
    rows = []
    for i in range(400):
        t = base + timedelta(seconds=37 * i)
        rows.append(ev(user="hot", session="long", ts=t, action=["view", "click", "add_to_cart"][i % 3],
                       price=float(i % 17), event_id=i))
    for i in range(20):
        rows.append(ev(user=None, session=None, ts=base + timedelta(seconds=500 * i), event_id=1000 + i))
    df = make_events(rows)
    split = _rows(feat.add_aggregated_features(df, tie_break="event_id", bucket_seconds=600))
    plain = _rows(feat.add_aggregated_features(df, tie_break="event_id", bucket_seconds=None))
    assert split == plain
    assert max(r[1] for r in split) == 400


def test_single_exchange_and_no_python(spark):
    df = feat.process_user_behavior(behavior_events(spark, SF_SMALL))
    plan = df._jdf.queryExecution().executedPlan().toString()
    full = df._jdf.queryExecution().toString()
    # one exchange of the event rows; the other two move the per-bucket counts
    assert plan.count("Exchange hashpartitioning(user_id") >= 1
    assert "BatchEvalPython" not in full and "ArrowEvalPython" not in full


def test_segments_order(make_events):
    rows = [ev(ts=f"2024-01-05 10:00:0{i}", action=a, event_id=i)
            for i, a in enumerate(["view", "add_to_cart", "purchase"])]
    out = feat.process_user_behavior(make_events(rows)).orderBy("event_id") \
        .select("user_behavior_type", "engagement_level").collect()
    assert [r[0] for r in out] == ["casual_visitor", "quick_buyer", "quick_buyer"]
    assert {r[1] for r in out} == {"low"}


def test_null_times_match_plain_windows(make_events):
    base = datetime(2024, 1, 5, 23, 50, 0)
    rows = [ev(ts=None if i % 4 == 0 else base + timedelta(seconds=97 * i), session="s" + str(i % 2),
               action=["view", "add_to_cart"][i % 2], event_id=i) for i in range(60)]
    df = make_events(rows)
    split = _rows(feat.add_aggregated_features(df, tie_break="event_id", bucket_seconds=600))
    plain = _rows(feat.add_aggregated_features(df, tie_break="event_id", bucket_seconds=None))
    assert split == plain


def test_dense_seconds_and_sessions_match_plain(make_events):
    """A bot: many events per second, equal timestamps, two sessions of one
    user interleaved, a NULL session; the per-second plan equals the plain
    windows."""
    base = datetime(2024, 1, 5, 23, 59, 50)
    rows = []
    for i in range(300):
        t = base + timedelta(microseconds=250_000 * (i // 3))   # 3 events per timestamp, 4 per second
        rows.append(ev(user="bot", session=["a", "b", None][i % 3], ts=t,
                       action=["view", "add_to_cart", "click", "view"][i % 4],
                       price=None if i % 7 == 0 else float(i % 13), event_id=i))
    df = make_events(rows)
    for frame in (1, 5, 600):
        split = _rows(feat.add_aggregated_features(df, recent_seconds=frame, tie_break="event_id",
                                                   bucket_seconds=60))
        plain = _rows(feat.add_aggregated_features(df, recent_seconds=frame, tie_break="event_id",
                                                   bucket_seconds=None))
        assert [r[:5] for r in split] == [r[:5] for r in plain]
        for x, y in zip(split, plain):
            assert (x[5] is None and y[5] is None) or abs(x[5] - y[5]) < 1e-9


def test_event_rows_move_once_by_user_second(spark):
    df = feat.add_aggregated_features(behavior_events(spark, SF_SMALL))
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the only exchange of whole event rows is keyed by (user, second); the
    # others move per-second sums
    assert plan.count("Exchange hashpartitioning(user_id") >= 1
    assert "Exchange hashpartitioning(user_id#" in plan and "_sec" in plan
    final = plan.split("Union")[0]
    assert final.count("Sort [") == 1


def test_per_second_plan_property(make_events):
    """Random events (dense times with ties, NULL users / sessions / actions
    / prices / times), random frame and bucket: equal to the plain windows."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    base = datetime(2024, 1, 5, 23, 58, 0)
    event = st.tuples(st.sampled_from(["u1", "u2", None]), st.sampled_from(["s1", "s2", None]),
                      st.one_of(st.none(), st.integers(0, 3000)),
                      st.sampled_from(["view", "add_to_cart", "click", None]),
                      st.one_of(st.none(), st.integers(1, 500).map(lambda x: x / 4)))

    @settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(event, min_size=1, max_size=40), st.sampled_from([1, 7, 120]),
           st.sampled_from([2, 30, 3600]))
    def check(evs, frame, bucket):
        rows = [ev(user=u, session=s, ts=None if o is None else base + timedelta(milliseconds=100 * o),
                   action=a, price=p, event_id=i) for i, (u, s, o, a, p) in enumerate(evs)]
        df = make_events(rows)
        split = _rows(feat.add_aggregated_features(df, recent_seconds=frame, tie_break="event_id",
                                                   bucket_seconds=bucket))
        plain = _rows(feat.add_aggregated_features(df, recent_seconds=frame, tie_break="event_id",
                                                   bucket_seconds=None))
        assert [r[:5] for r in split] == [r[:5] for r in plain]
        for x, y in zip(split, plain):
            assert (x[5] is None and y[5] is None) or abs(x[5] - y[5]) < 1e-9

    check()


def test_pipeline_runs_no_job_while_it_is_built(spark):
    """One plan at every size: building the frame starts no job, also on a stream."""
    from clickweave.operators import runs
    tracker = spark.sparkContext.statusTracker()
    events = behavior_events(spark, SF_SMALL)
    before = set(tracker.getJobIdsForGroup(None))
    spark_plan = feat.process_user_behavior(events, tie_break="event_id")
    assert set(tracker.getJobIdsForGroup(None)) == before
    assert "_bucket" in spark_plan._jdf.queryExecution().executedPlan().toString()
    src = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    stream = spark.readStream.schema(src.schema).parquet(SF_SMALL)
    events = stream.selectExpr("format_string('user_%06d', user_id) AS user_id", "cast(ts AS timestamp) AS timestamp",
                               "'s1' AS session_id", "event_type AS action_type", "value AS product_price",
                               "CAST(NULL AS STRING) AS user_agent", "CAST(NULL AS STRING) AS referrer")
    assert feat.process_user_behavior(events).isStreaming
    assert runs.second_runs(events, "user_id", 3600).isStreaming
