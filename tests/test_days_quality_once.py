import math
import random
import uuid
from datetime import datetime, timedelta

import numpy as np
import pytest
from conftest import SF_SMALL, ev
from pyspark.sql import functions as F

from clickweave.operators import aggregates as agg
from clickweave.operators import daily, ranking
from clickweave.plans.train import evaluate
from clickweave.session import checkpoint, scratch_path
from clickweave.sources import lake
from clickweave.sources.fixtures import behavior_events
from clickweave.streaming import micro_batch as mb
from clickweave.streaming import once, records
from clickweave.streaming.metrics import read_metrics


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_sliding_scores_equal_a_full_computation(spark):
    events = behavior_events(spark, SF_SMALL)
    days = daily.day_scores(events)
    start = datetime(2024, 1, 1).date()
    window = None
    for k in range(6):
        d = start + timedelta(days=k)
        gone = days.where(F.col("event_date") == d - timedelta(days=3)) if k >= 3 else None
        window = checkpoint(daily.slide(window, days.where(F.col("event_date") == d), gone))
        part = events.where(F.to_date("timestamp").between(d - timedelta(days=2), d))
        assert rows(window.select("user_id", "product_id", "score")) == rows(agg.interaction_strength(part))


def test_day_sets_of_nulls_repeats_and_new_labels(spark, make_events):
    a = [ev(user="u", product=p, ts="2024-01-05 10:00:00") for p in ("p1", "p2", "p2", None)] + [ev(user=None, product="p1", ts="2024-01-05 11:00:00")]
    b = [ev(user="u", product=p, ts="2024-01-06 10:00:00") for p in ("p2", "p9")] + [ev(user="v", product=None, ts="2024-01-06 11:00:00")]
    first = daily.extend_labels(None, make_events(a), "product_id")
    both = daily.extend_labels(first, make_events(b), "product_id")
    old, new = ({r.label: r.idx for r in d.collect()} for d in (first, both))
    assert new == {**old, "p9": 2} and sorted(new.values()) == [0, 1, 2]
    sets = daily.day_sets(make_events(a), ["user_id"], "product_id", first).unionByName(daily.day_sets(make_events(b), ["user_id"], "product_id", both))
    assert rows(daily.distinct_counts(sets, ["user_id"], "n")) == [("u", 3), (None, 1)]
    days = daily.day_users(make_events(a + b))
    got = daily.users_over_days(days, {"unique_products_viewed": sets}).collect()
    assert {(r.user_id, r.total_events, r.unique_products_viewed) for r in got} == {("u", 6, 3), (None, 1, 1), ("v", 1, 0)}


def test_sets_of_many_buckets_equal_distinct_counts(spark):
    events = spark.range(60_000).select(F.lit("2024-01-05").cast("timestamp").alias("timestamp"), (F.col("id") % 3).cast("string").alias("user_id"),
                                        (F.col("id") % 40_000).cast("string").alias("product_id"))
    labels = daily.extend_labels(None, events, "product_id")
    got = daily.distinct_counts(daily.day_sets(events, ["user_id"], "product_id", labels), ["user_id"], "n")
    assert rows(got) == rows(events.groupBy("user_id").agg(F.countDistinct("product_id").alias("n")))


def test_ranking_metrics_by_hand(spark):
    recs = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 3, "z"), ("b", 1, "x"), ("nobody", 1, "x")], "user_id string, rank int, product_id string")
    truth = spark.createDataFrame([("a", "z"), ("a", "z"), ("a", "q"), ("a", "x"), ("b", "y"), ("c", "x"), (None, "x"), ("a", None)], "user_id string, product_id string")
    got = {r.user_id: r for r in ranking.ranking_metrics(recs, truth, 3).collect()}
    assert set(got) == {"a", "b", "c"}
    a = got["a"]
    assert (a.relevant, a.hits, a.recall, a.precision) == (3, 2, 2 / 3, 2 / 3)
    best = 1 + 1 / math.log2(3) + 1 / 2
    assert abs(a.ndcg - 1.5 / best) < 1e-12
    assert got["b"].hits == got["c"].hits == 0 and got["c"].ndcg == 0
    s = ranking.summary(ranking.ranking_metrics(recs, truth, 3)).first()
    assert s.users == 3 and abs(s.hit_rate - 1 / 3) < 1e-12
    assert ranking.ranking_metrics(recs, truth.where("false"), 3).count() == 0


def test_evaluation_of_a_trained_model(spark):
    """Users buy the products of their group and only look at others: the model
    must beat recommending anything. (Of equal scores it could learn nothing.)"""
    rnd = random.Random(1)
    rows_ = []
    for u in range(40):
        for k in range(14):
            day = 1 + k % 9
            rows_.append((f"u{u}", f"p{u % 4}-{rnd.randrange(12)}", "purchase", datetime(2024, 1, day, 10, k), f"s{u}", "Books", 10.0, None, None, None, k))
            if day < 8:
                other = (u + rnd.randrange(1, 4)) % 4
                rows_.append((f"u{u}", f"p{other}-{rnd.randrange(12)}", "view", datetime(2024, 1, day, 11, k), f"s{u}", "Books", 10.0, None, None, None, k))
    ddl = ("user_id string, product_id string, action_type string, timestamp timestamp, session_id string, product_category string, "
           "product_price double, user_agent string, ip_address string, referrer string, event_id long")
    path = scratch_path(spark, f"lake-{uuid.uuid4().hex}")
    lake.write_lake(spark.createDataFrame(rows_, ddl), path)
    out = evaluate(spark, path, None, "2024-01-08T00:00:00+00:00", "2024-01-11T00:00:00+00:00", n=12, max_iter=5)
    got = ranking.summary(out).first()
    assert got.users == 40 and got.recall > 0.6  # 12 of 48 products at random: 0.25


def test_offset_intervals():
    rng = random.Random(3)
    for _ in range(50):
        seen, lo, hi = set(), np.zeros(0, "int64"), np.zeros(0, "int64")
        for _ in range(6):
            x = np.array([rng.randrange(40) for _ in range(rng.randrange(1, 12))], "int64")
            new = once.unseen(lo, hi, x)
            want = []
            for v in x.tolist():
                want.append(v not in seen)
                seen.add(v)
            assert new.tolist() == want
            if new.any():
                lo, hi = once.merge_offsets(lo, hi, x[new])
            assert {v for a, b in zip(lo, hi) for v in range(a, b + 1)} == seen
            assert all(a > b + 1 for a, b in zip(lo[1:], hi[:-1]))


def test_each_record_once_with_late_rows_and_restart(spark):
    src, out = (scratch_path(spark, f"{k}-{uuid.uuid4().hex}") for k in ("rec", "once"))
    events = behavior_events(spark, SF_SMALL).where("timestamp < '2024-01-05'")

    def run():
        stream = mb.decode_stream(records.read_record_stream(spark, src, max_files=2), late="once")
        mb.start_stream(stream, f"{out}/c", f"{out}/lake", available_now=True).awaitTermination()
        return [r[0] for r in lake.read_lake(spark, f"{out}/lake").select("offset").collect()]

    records.write_record_files(events, src, late_days=F.when(F.col("offset") % 3 == 0, 2).otherwise(0))
    first = run()
    assert sorted(first) == sorted(r[0] for r in events.select("event_id").collect())
    records.write_record_files(events, src, suffix="again")
    assert sorted(run()) == sorted(first)  # the state outlives the query
    with pytest.raises(ValueError, match="offset"):
        mb.apply_late_policy(events, "once")


def test_metrics_of_every_batch_whatever_the_sinks(spark, make_events):
    src, out = (scratch_path(spark, f"{k}-{uuid.uuid4().hex}") for k in ("rec", "met"))
    days = [[ev(event_id=10 * d + i, ts=f"2024-01-0{d} 10:00:0{i}", user=None if i == 0 else "u", price=None if i == 1 else 1.0) for i in range(d + 2)]
            for d in (1, 2, 3)]
    records.write_record_files(make_events([e for d in days for e in d]), src)
    stream = mb.decode_stream(records.read_record_stream(spark, src, max_files=1))
    q = mb.start_stream(stream, f"{out}/c", quarantine_path=f"{out}/bad", metrics_path=f"{out}/m", available_now=True)
    q.awaitTermination()
    assert q.metrics.wait(q)
    spark.streams.removeListener(q.metrics)
    got = read_metrics(spark, f"{out}/m").orderBy("batch_id").collect()
    assert [(r.batch_id, r.rows, r.storable, r.no_user, r.input_rows) for r in got] == [(0, 3, 1, 1, 3), (1, 4, 2, 1, 4), (2, 5, 3, 1, 5)]
    assert all(r.query_id == str(q.id) and r.trigger_ms > 0 for r in got)
    assert spark.read.parquet(f"{out}/bad").count() == 6
