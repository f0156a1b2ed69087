import uuid

from conftest import SF_SMALL
from pyspark.sql import functions as F

from clickweave.schema import EVENT_COLUMNS
from clickweave.session import scratch_path
from clickweave.sources import kafka, lake
from clickweave.sources.fixtures import behavior_events


def test_decode_keeps_bad_rows(spark):
    vals = ['{"user_id":"u1","product_price":12.5,"timestamp":"2024-01-05T10:00:00.5+09:00"}',
            'not json', '{"user_id":"u2","product_price":"cheap"}', '{"product_id":"p"}',
            '{"user_id":"u3","extra":1}', None]
    rec = spark.createDataFrame([(b"k", v.encode() if v else None, "t", 0, i, None)
                                 for i, v in enumerate(vals)],
                                "key binary, value binary, topic string, partition int, offset long, "
                                "timestamp timestamp")
    out = {r.offset: r for r in kafka.decode_events(rec).collect()}
    assert len(out) == 6
    assert out[0].user_id == "u1" and out[0].product_price == 12.5
    assert str(out[0].timestamp) == "2024-01-05 01:00:00.500000"
    assert out[1].user_id is None
    assert out[2].user_id == "u2" and out[2].product_price is None
    assert out[3].product_id == "p" and out[3].user_id is None
    assert out[4].user_id == "u3" and out[5].user_id is None
    filled = kafka.fill_event_time(kafka.decode_events(rec), now="2024-02-01 00:00:00")
    assert str(filled.where("offset = 1").first().timestamp) == "2024-02-01 00:00:00"


def test_encode_decode_roundtrip(spark):
    events = behavior_events(spark, SF_SMALL).withColumn("product_price", F.col("product_price")
                                                          .cast("float").cast("double"))
    rec = kafka.encode_events(events)
    assert [f.name for f in rec.schema.fields] == ["key", "value", "headers", "topic"]
    back = kafka.decode_events(rec).select(*EVENT_COLUMNS)
    assert back.exceptAll(events.select(*EVENT_COLUMNS)).count() == 0
    assert events.select(*EVENT_COLUMNS).exceptAll(back).count() == 0
    h = rec.select(F.col("headers")[0]["key"], F.col("headers")[0]["value"].cast("string")).first()
    assert h[0] == "event_type"


def test_lake_pruning_and_replay(spark):
    path = scratch_path(spark, f"lake-test-{uuid.uuid4().hex}")
    events = behavior_events(spark, SF_SMALL)
    lake.write_lake(events, path, batch_id=7)
    lake.write_lake(events, path, batch_id=7)           # a replayed batch replaces its files
    back = lake.read_lake(spark, path)
    assert back.count() == events.count()
    day = lake.time_range(back, *lake.day_range("2024-01-03"))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "PushedFilters: [IsNotNull(timestamp)" in plan
    n = events.where("timestamp >= '2024-01-03' AND timestamp < '2024-01-04'").count()
    assert day.count() == n
    assert lake.time_range(back, None, "2024-01-04T00:00:00+00:00").count() == events.count()


def test_day_range_and_preview(spark):
    assert lake.day_range("2025-08-27") == ("2025-08-27T00:00:00+00:00", "2025-08-28T00:00:00+00:00")
    assert lake.preview(behavior_events(spark, SF_SMALL), 5).count() == 5


def test_codec_property(spark):
    from datetime import datetime

    from hypothesis import given, settings
    from hypothesis import strategies as st

    text = st.one_of(st.none(), st.text(max_size=12))
    event = st.tuples(text, text, text,
                      st.datetimes(min_value=datetime(2000, 1, 1), max_value=datetime(2100, 1, 1)),
                      text, text, st.one_of(st.none(), st.floats(-1e6, 1e6, width=32)), text, text, text)

    @settings(max_examples=5, deadline=None)
    @given(st.lists(event, min_size=1, max_size=20))
    def roundtrip(rows):
        ddl = ", ".join(f"{c} {t}" for c, t in zip(EVENT_COLUMNS, ["string"] * 3 + ["timestamp"] + ["string"] * 2
                                                    + ["double"] + ["string"] * 3))
        df = spark.createDataFrame([tuple(r) for r in rows], ddl)
        back = kafka.decode_events(kafka.encode_events(df)).select(*EVENT_COLUMNS)
        assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))

    roundtrip()


def test_lake_files_per_day(spark):
    path = scratch_path(spark, f"lake-files-{uuid.uuid4().hex}")
    events = behavior_events(spark, SF_SMALL)
    lake.write_lake(events, path, files_per_day=3)
    back = lake.read_lake(spark, path)
    assert back.count() == events.count()
    per_day = back.select("event_date", F.input_file_name().alias("f")).distinct() \
        .groupBy("event_date").count().agg(F.max("count")).first()[0]
    assert per_day <= 3
