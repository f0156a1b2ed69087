from datetime import datetime, timedelta

from conftest import SF_SMALL, ev
from pyspark.sql import functions as F

from clickweave.operators import aggregates as agg
from clickweave.operators import runs, serving
from clickweave.sources.fixtures import behavior_events


def test_ratio_edges(make_events):
    rows = [ev(user="a", product="p1", action="view", event_id=1),
            ev(user="a", product="p2", action="purchase", event_id=2),
            ev(user="b", product="p2", action="click", event_id=3)]
    df = make_events(rows)
    uf = {r.user_id: r for r in agg.user_features(df).collect()}
    assert uf["a"].cart_conversion_rate == 1.0 and uf["a"].conversion_rate == 0.5
    pf = {r.product_id: r for r in agg.product_features(df).collect()}
    assert pf["p2"].conversion_rate is None          # no views -> NULL, not an error
    assert pf["p2"].popularity_score == 1.0


def test_interaction_totals_and_counts(spark):
    events = behavior_events(spark, SF_SMALL)
    total = events.select(F.sum(F.when(F.col("action_type") == "purchase", 4.0)
                                .when(F.col("action_type") == "add_to_cart", 3.0)
                                .when(F.col("action_type") == "click", 2.0).otherwise(1.0))).first()[0]
    scores = agg.interaction_strength(events)
    assert scores.select(F.sum("interaction_strength")).first()[0] == total
    sql = agg.interaction_strength_sql(spark, events)
    assert sorted(map(tuple, scores.collect())) == sorted(map(tuple, sql.collect()))
    counts = serving.action_counts(events, ttl_seconds=None)
    assert counts.select(F.sum("count")).first()[0] == events.count()


def _brute_runs(times, ttl):
    times = sorted(times)
    out, start, prev = [], None, None
    for t in times:
        if prev is None or (t - prev).total_seconds() >= ttl:
            start = t
        out.append(start)
        prev = t
    return out


def test_ttl_edges(make_events):
    base = datetime(2024, 1, 5)
    gaps = [0, 3600, 3599, 3601, 7200]     # exact TTL starts a new run; TTL-1s does not
    t, rows = base, []
    for i, g in enumerate(gaps):
        t = t + timedelta(seconds=g)
        rows.append(ev(ts=t, event_id=i))
    out = runs.assign_runs(make_events(rows), "user_id", 3600, bucket_seconds=3600) \
        .orderBy("timestamp").select("run_start").collect()
    assert [r[0] for r in out] == _brute_runs([r[3] for r in rows], 3600)
    summary = runs.run_summary(make_events(rows), "user_id", 3600).orderBy("run_start").collect()
    assert [r.events for r in summary] == [1, 2, 1, 1]


def test_runs_match_brute_force_on_fixture(spark):
    events = behavior_events(spark, SF_SMALL)
    for ttl, bucket in [(86400, 86400), (3600, 86400), (7200, 3600)]:
        got = {(r.user_id, r.timestamp): r.run_start
               for r in runs.assign_runs(events, "user_id", ttl, bucket_seconds=bucket).collect()}
        by_user = {}
        for (u, t) in got:
            by_user.setdefault(u, []).append(t)
        for u, ts in by_user.items():
            for t, s in zip(sorted(ts), _brute_runs(ts, ttl)):
                assert got[(u, t)] == s


def test_expired_key_restarts_and_as_of(make_events):
    base = datetime(2024, 1, 1)
    rows = [ev(ts=base, category="Books", event_id=1),
            ev(ts=base + timedelta(days=31), category="Toys", event_id=2),
            ev(ts=base + timedelta(days=31, hours=1), category="Toys", event_id=3)]
    df = make_events(rows)
    live = serving.category_interests(df).collect()
    assert [(r.field, r["count"]) for r in live] == [("Toys", 2)]
    gone = serving.category_interests(df, as_of=base + timedelta(days=62)).collect()
    assert gone == []


def test_recent_behaviors_keeps_newest(make_events):
    base = datetime(2024, 1, 5)
    rows = [ev(ts=base + timedelta(minutes=i), product=f"p{i}", event_id=i) for i in range(150)]
    out = serving.recent_behaviors(make_events(rows), n=100, tie_break="event_id").orderBy("rank").collect()
    assert len(out) == 100 and out[0].product_id == "p149" and out[-1].product_id == "p50"


def test_session_summary_first_and_last(make_events):
    rows = [ev(user="a", session="s", ts="2024-01-05 10:00:00", event_id=1),
            ev(user="b", session="s", ts="2024-01-05 10:30:00", event_id=2),
            ev(user="b", session="s", ts="2024-01-05 12:00:00", event_id=3)]
    whole = serving.session_summary(make_events(rows), ttl_seconds=None).collect()[0]
    assert (whole.user_id, whole.start_time, whole.last_activity, whole.action_count) == \
        ("a", "2024-01-05 10:00:00", "2024-01-05 12:00:00", 3)
    live = serving.session_summary(make_events(rows)).collect()[0]       # 1 h TTL: gap 1.5 h
    assert (live.user_id, live.start_time, live.action_count) == ("b", "2024-01-05 12:00:00", 1)


def test_quarantine(make_events):
    rows = [ev(event_id=1), ev(price=None, event_id=2), ev(user=None, event_id=3),
            ev(session=None, event_id=4), ev(category=None, event_id=5), ev(action=None, event_id=6),
            ev(agent=None, referrer=None, event_id=7)]
    good, bad = serving.split_storable(make_events(rows))
    assert sorted(r.event_id for r in good.collect()) == [1, 7]
    reasons = {r.event_id: r.reason for r in bad.collect()}
    assert reasons == {2: "missing product_price", 3: "missing user_id", 4: "missing session_id",
                       5: "missing product_category", 6: "missing action_type"}


def test_serving_keys_and_position_property(spark):
    from clickweave.operators import features as feat
    events = behavior_events(spark, SF_SMALL)
    keyed = serving.with_serving_key(serving.session_summary(events, ttl_seconds=None), "session_summary")
    assert keyed.where(~F.col("key").startswith("session:s_")).count() == 0
    keyed = serving.with_serving_key(serving.action_counts(events), "action_counts")
    assert keyed.first().key.endswith(":action_counts")
    f = feat.add_aggregated_features(events)
    assert f.where(F.col("session_action_count") < F.col("action_sequence")).count() == 0


def test_runs_dense_seconds_sub_second_gaps(make_events):
    """Many events per second, gaps of exactly TTL and TTL +- 100 us across
    bucket edges: per-second run detection equals the brute force."""
    base = datetime(2024, 1, 5, 0, 0, 0)
    offsets_us, t = [], 0
    pattern = [0, 250_000, 250_000, 2_000_000, 1_999_900, 2_000_100, 100, 0, 3_999_999, 2_000_000]
    for i in range(120):
        t += pattern[i % len(pattern)]
        offsets_us.append(t)
    rows = [ev(ts=base + timedelta(microseconds=u), event_id=i) for i, u in enumerate(offsets_us)]
    df = make_events(rows)
    for bucket in (2, 3, 7, 86400):
        got = [r[0] for r in runs.assign_runs(df, "user_id", 2, bucket_seconds=bucket)
               .orderBy("timestamp", "event_id").select("run_start").collect()]
        assert got == _brute_runs(sorted(r[3] for r in rows), 2), bucket


def test_runs_property(make_events):
    """Random dense times (ties, sub-second gaps, NULL times) for two users,
    random TTL and bucket: run labels equal the brute force."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    base = datetime(2024, 1, 5, 23, 59, 0)
    event = st.tuples(st.sampled_from(["u1", "u2"]), st.one_of(st.none(), st.integers(0, 200_000)))

    @settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(event, min_size=1, max_size=40), st.sampled_from([1, 2, 5]), st.sampled_from([1, 3, 86400]))
    def check(evs, ttl, bucket):
        rows = [ev(user=u, ts=None if o is None else base + timedelta(microseconds=250 * o), event_id=i)
                for i, (u, o) in enumerate(evs)]
        got = {r.event_id: r.run_start
               for r in runs.assign_runs(make_events(rows), "user_id", ttl, bucket_seconds=bucket).collect()}
        for user in ("u1", "u2"):
            mine = sorted((r[3], r[10]) for r in rows if r[0] == user and r[3] is not None)
            want = _brute_runs([t for t, _ in mine], ttl)
            assert [got[i] for _, i in mine] == want
        assert all(got[r[10]] is None for r in rows if r[3] is None)

    check()
