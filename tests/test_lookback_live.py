import random
import uuid
from datetime import datetime, timedelta

import pytest
from conftest import ev
from pyspark.sql import functions as F

from clickweave.operators import features as feat
from clickweave.operators import serving
from clickweave.session import scratch_path
from clickweave.sources import lake
from clickweave.streaming import lookback, records
from clickweave.streaming import micro_batch as mb
from clickweave.streaming.stateful import STATE_CONF


def random_events(n=400, seed=3):
    """Events of three users in sessions over midnight, seconds with several
    events, gaps below and above the frame."""
    rnd, t, rows = random.Random(seed), datetime(2024, 1, 5, 22), []
    for i in range(n):
        t += timedelta(milliseconds=rnd.choice([100, 400, 20_000, 250_000, 700_000]))
        rows.append(ev(user=f"u{rnd.randrange(3)}", session=f"s{i // 40}", ts=t, price=float(rnd.randrange(600)),
                       category=rnd.choice(["Books", "Toys"]), action=rnd.choice(["view", "view", "add_to_cart", "purchase"]), event_id=i))
    return rows


def as_records(df):
    """Events as the job decodes them, with the record columns."""
    return df.withColumns({"topic": F.lit("t"), "partition": F.lit(0), "offset": F.col("event_id")}).drop("event_id")


COLS = ["user_id", "session_id", "timestamp", *feat.WINDOW_COLS[:4], *feat.SEGMENT_COLS]


def same_features(got, want):
    a, b = (sorted(tuple(r) for r in d.select("offset", *COLS).collect()) for d in (got, want))
    assert a == b
    price = [{r.offset: r.avg_price_viewed for r in d.collect()} for d in (got, want)]
    assert all((price[0][k] is None) == (v is None) and (v is None or abs(price[0][k] - v) < 1e-9) for k, v in price[1].items())


def run_batches(make_events, rows, order, base, replay=()):
    sink = mb.BatchSink(lake_path=f"{base}/lake", features_path=f"{base}/features", feature_mode="lookback",
                        feature_args={"session_seconds": 10 * 86_400})
    for b, part in enumerate(order):
        batch = as_records(make_events([rows[i] for i in part]))
        for _ in range(2 if b in replay else 1):
            sink(batch, b)


def test_lookback_in_time_order_equals_batch_without_corrections(spark, make_events):
    rows, base = random_events(), scratch_path(spark, f"look-{uuid.uuid4().hex}")
    # cut where the second changes
    cuts = [0, *[i for i in range(60, 400, 67) if rows[i][3].replace(microsecond=0) != rows[i - 1][3].replace(microsecond=0)], 400]
    run_batches(make_events, rows, [range(a, b) for a, b in zip(cuts, cuts[1:])], base, replay={1})
    all_rows = spark.read.parquet(f"{base}/features")
    assert all_rows.count() == 400 and all_rows.where("sign <> 1").count() == 0
    same_features(lookback.current_features(spark, f"{base}/features"),
                  feat.process_user_behavior(as_records(make_events(rows)), tie_break="offset"))


def test_late_rows_are_corrected_and_signs_add_up(spark, make_events):
    rows, base = random_events(seed=9), scratch_path(spark, f"late-{uuid.uuid4().hex}")
    rnd = random.Random(1)
    part = [min(3, i // 100 + (rnd.random() < 0.2) * rnd.randrange(1, 4)) for i in range(400)]
    order = [[i for i in range(400) if part[i] == b] for b in range(4)]
    run_batches(make_events, rows, order, base, replay={2})
    want = feat.process_user_behavior(as_records(make_events(rows)), tie_break="offset")
    same_features(lookback.current_features(spark, f"{base}/features"), want)
    every = spark.read.parquet(f"{base}/features")
    assert every.where("sign = -1").count() > 20
    # the rows that are left when old and new ones are added up are the present ones
    cols = [c for c in want.columns]
    net = every.groupBy(*cols).agg(F.sum("sign").alias("n")).where("n <> 0")
    assert {r.n for r in net.select("n").distinct().collect()} == {1}
    same_features(net.drop("n"), want)


def test_lookback_needs_a_lake(spark, make_events):
    events = make_events([ev()])
    with pytest.raises(ValueError, match="lake"):
        mb.start_stream(events, "c", features_path="f", feature_mode="lookback")
    with pytest.raises(ValueError, match="feature_mode"):
        mb.start_stream(events, "c", features_path="f", feature_mode="other")


def test_live_recent_behaviours_of_shuffled_batches_equal_batch(spark, make_events):
    """Rows within the watermark in any order: late rows take their place in the
    list, and may join two runs into one."""
    rnd, t, rows = random.Random(2), datetime(2024, 1, 5), []
    for i in range(240):
        t += timedelta(milliseconds=rnd.choice([0, 400, 60_000, 3_599_000, 3_600_000, 5_000_000]))
        rows.append(ev(user=f"u{rnd.randrange(4)}", ts=t, price=float(i), action=rnd.choice(["view", "click"]), event_id=i))
    events = make_events(rows)
    part = [rnd.randrange(4) for _ in rows]
    src, out = (scratch_path(spark, f"{k}-{uuid.uuid4().hex}") for k in ("rec", "live"))
    for b in range(4):
        records.to_records(make_events([r for r, p in zip(rows, part) if p == b])).coalesce(1).write.json(f"{src}/b{b}")
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    stream = mb.decode_stream(records.read_record_stream(spark, src, max_files=1), delay="60 days")
    mb.start_live(stream, "recent_behaviors", f"{out}/t", f"{out}/c", available_now=True, ttl_seconds=3600, n=7,
                  tie_break="offset").awaitTermination()
    assert {k: spark.conf.get(k, None) for k in STATE_CONF} == before
    got = mb.read_live(spark, f"{out}/t").select("user_id", "rank", "product_id", "action_type", "price")
    want = serving.recent_behaviors(events, n=7, ttl_seconds=3600, tie_break="event_id").select(
        "user_id", "rank", "product_id", "action_type", "price")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert spark.read.parquet(f"{out}/t").select("batch_id").distinct().count() == 4


def test_live_recent_state_is_deleted_when_the_watermark_passes(spark, make_events):
    rows = [ev(user="a", ts="2024-01-05 10:00:00", event_id=1), ev(user="b", ts="2024-01-06 10:00:00", event_id=2),
            ev(user="b", ts="2024-01-07 10:00:00", event_id=3), ev(user="a", ts="2024-01-08 10:00:00", event_id=4)]
    src, out = (scratch_path(spark, f"{k}-{uuid.uuid4().hex}") for k in ("rec", "live"))
    records.write_record_files(make_events(rows), src)
    stream = mb.decode_stream(records.read_record_stream(spark, src, max_files=1))
    mb.start_live(stream, "recent_behaviors", f"{out}/t", f"{out}/c", available_now=True, ttl_seconds=3600).awaitTermination()
    got = {(r.user_id, r["rank"], r.timestamp.day) for r in mb.read_live(spark, f"{out}/t").collect()}
    assert got == {("a", 1, 8), ("b", 1, 7)}


def test_source_options_reach_the_reader(spark, monkeypatch):
    """A1: what the job sets on the Kafka reader (no broker needed)."""
    from clickweave.sources import kafka
    seen = {}

    class Reader:
        def format(self, name):
            seen["format"] = name
            return self

        def option(self, key, value):
            seen[key] = value
            return self

        def load(self):
            return "frame"

    class Session:
        readStream = Reader()

    assert kafka.read_kafka(Session(), "h:9092", "t1,t2", "earliest", options={"maxOffsetsPerTrigger": "500"}) == "frame"
    assert seen == {"format": "kafka", "kafka.bootstrap.servers": "h:9092", "subscribe": "t1,t2", "startingOffsets": "earliest",
                    "failOnDataLoss": "false", "maxOffsetsPerTrigger": "500"}


def test_empty_batch_and_preview(spark, make_events):
    """An empty batch writes nothing and is released."""
    base = scratch_path(spark, f"empty-{uuid.uuid4().hex}")
    sink = mb.BatchSink(lake_path=f"{base}/lake", features_path=f"{base}/f", feature_mode="lookback")
    events = as_records(make_events([ev(event_id=i) for i in range(3)]))
    sink(events.where("false"), 0)
    assert sink.counts == {} and not list(spark.sparkContext._jsc.getPersistentRDDs())
    sink(events, 1)
    assert sink.counts == {1: 3} and not list(spark.sparkContext._jsc.getPersistentRDDs())
    assert lake.preview(lake.read_lake(spark, f"{base}/lake"), 2).count() == 2
