import uuid

from conftest import SF_SMALL
from pyspark.sql import functions as F

from clickweave.operators import aggregates as agg
from clickweave.operators import recommend as rec
from clickweave.session import scratch_path
from clickweave.sources.fixtures import behavior_events
from clickweave.sources.models import load_model, save_model


def test_label_order_with_ties(spark):
    rows = [("a", "x"), ("b", "x"), ("b", "y"), ("c", "z"), ("c", "y"), (None, "y"), ("d", "w")]
    df = spark.createDataFrame(rows, "user_id string, product_id string")
    users = {r.label: r.idx for r in rec.fit_labels(df, "user_id").collect()}
    assert users == {"b": 0, "c": 1, "a": 2, "d": 3}
    items = {r.label: r.idx for r in rec.fit_labels(df, "product_id").collect()}
    assert items == {"y": 0, "x": 1, "w": 2, "z": 3}


def test_dictionary_across_many_partitions(spark):
    labels = spark.range(0, 5000, numPartitions=7).select(
        F.format_string("l%05d", "id").alias("label"), (F.col("id") % 13).alias("freq"))
    d = rec.index_labels(labels).toPandas()
    exp = labels.toPandas().sort_values(["freq", "label"], ascending=[False, True]).reset_index(drop=True)
    assert list(d.sort_values("idx")["label"]) == list(exp["label"])
    assert sorted(d["idx"]) == list(range(5000))


def test_als_properties_and_save_load(spark):
    scores = agg.interaction_strength(behavior_events(spark, SF_SMALL))
    dicts = rec.fit_indexers(scores)
    enc = rec.encode(scores, dicts)
    assert enc.count() == scores.count()
    model = rec.fit_als(enc, max_iter=5)
    recs = rec.recommend_all(model, dicts, n=5).toPandas()
    assert recs.groupby("user_id").size().max() <= 5
    assert recs.user_id.nunique() == scores.select("user_id").distinct().count()
    for _, g in recs.groupby("user_id"):
        g = g.sort_values("rank")
        assert list(g["rank"]) == list(range(1, len(g) + 1))
        assert (g["rating"].diff().dropna() <= 1e-6).all()
        assert (g["rating"] >= 0).all()
    some = scores.select("user_id").distinct().limit(3)
    sub = rec.recommend(model, dicts, some.union(spark.createDataFrame([("nobody",)], "user_id string")), n=5)
    assert sub.select("user_id").distinct().count() == 3
    root = save_model(model, dicts, scratch_path(spark, f"models-{uuid.uuid4().hex}"), version="v1")
    model2, dicts2 = load_model(spark, root)
    again = rec.recommend_all(model2, dicts2, n=5).toPandas()
    key = ["user_id", "rank"]
    a = recs.sort_values(key).reset_index(drop=True)
    b = again.sort_values(key).reset_index(drop=True)
    assert (a["product_id"] == b["product_id"]).all()
