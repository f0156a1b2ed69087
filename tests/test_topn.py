import numpy as np
import pytest
from conftest import SF_SMALL

from clickweave.operators import aggregates as agg
from clickweave.operators import recommend as rec
from clickweave.operators import topn
from clickweave.operators.lookup import lookup
from clickweave.sources.fixtures import behavior_events
from clickweave.sources.models import load_model, save_model


def frame(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors)], "id int, features array<double>")


def plain(users, items, n):
    out = []
    for u, x in enumerate(users):
        score = items @ x
        best = sorted(range(len(items)), key=lambda i: (-score[i], i))[:n]
        out += [(u, r + 1, i, score[i]) for r, i in enumerate(best)]
    return out


def check(got, want):
    got = sorted(tuple(r) for r in got.collect())
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g[3] - w[3]) < 1e-9 for g, w in zip(got, want))


@pytest.mark.parametrize("n, block", [(3, 8), (10, 16), (40, 7)])
def test_equals_all_pairs_with_ties_zeros_and_negatives(spark, n, block):
    rng = np.random.default_rng(n)
    users = rng.integers(-2, 4, (60, 4)).astype(float)
    users[3] = 0
    items = rng.integers(-2, 3, (90, 4)) * rng.choice([0, 1, 1, 5], (90, 1)).astype(float)
    best, _ = topn.top_n(frame(spark, users), frame(spark, items), n, block_items=block, group_users=25)
    check(best, plain(users, items, n))


def test_few_items_null_vectors_and_empty_tables(spark):
    users, items = frame(spark, [[1, 0], [0, 1]]), frame(spark, [[2, 1], [1, 3]])
    best, _ = topn.top_n(users, items, 5)
    assert sorted(map(tuple, best.collect())) == [(0, 1, 0, 2.0), (0, 2, 1, 1.0), (1, 1, 1, 3.0), (1, 2, 0, 1.0)]
    nulls = spark.createDataFrame([(None, [1.0, 1.0]), (7, None)], "id int, features array<double>")
    best, _ = topn.top_n(users.union(nulls), items.union(nulls), 1)
    assert sorted(r.user for r in best.collect()) == [0, 1]
    assert topn.top_n(users.where("false"), items, 2)[0].count() == 0
    assert topn.top_n(users, items.where("false"), 2)[0].count() == 0


def test_long_vectors_end_the_search(spark):
    """Lengths that fall like a power law, all directions positive, as
    non-negative factors have them: most blocks are never met."""
    rng = np.random.default_rng(1)
    items = rng.uniform(0.5, 1, (3000, 6)) * (1 + np.arange(3000)[:, None]) ** -0.7
    users = rng.uniform(0, 1, (200, 6))
    best, visits = topn.top_n(frame(spark, users), frame(spark, items), 10, block_items=64)
    check(best, plain(users, items, 10))
    assert 0 < visits.share < 0.2 and visits.total == 200 * 47
    plan = best._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_equals_the_model_scores_of_every_pair(spark):
    scores = agg.interaction_strength(behavior_events(spark, SF_SMALL))
    dicts = rec.fit_indexers(scores)
    model = rec.fit_als(rec.encode(scores, dicts), max_iter=3)
    best, _ = topn.top_n(model.userFactors, model.itemFactors, 7, block_items=16)
    got = {(r.user, r.rank): r for r in best.collect()}
    rows = model.recommendForAllUsers(7).collect()
    assert len(got) == sum(len(r.recommendations) for r in rows)
    for r in rows:
        for k, x in enumerate(r.recommendations):
            assert abs(got[r.user_idx, k + 1].score - x.rating) < 1e-4
    ranked = rec.recommend_all(model, dicts, 7)
    assert ranked.count() == len(got)
    assert "Cartesian" not in ranked._jdf.queryExecution().toString()


def test_lookup_of_hot_and_cold_keys(spark):
    rows = spark.range(2000).selectExpr("id", "cast(if(id % 3 = 0, 5, id % 400) as int) as k")
    table = spark.range(10, 420).selectExpr("cast(id as int) as k", "concat('n', id) as name").unionAll(
        spark.createDataFrame([(5, "n5")], "k int, name string"))
    rows = rows.union(spark.createDataFrame([(5000, None)], "id long, k int"))
    for how in ("inner", "left"):
        want = sorted(map(str, rows.join(table.where("k <> 5"), "k", how).select("id", "k", "name").collect()))
        for share in (0.0, 0.01, 1.0):
            got = lookup(rows, table.where("k <> 5"), "k", share, how).select("id", "k", "name")
            assert sorted(map(str, got.collect())) == want
    want = sorted(map(tuple, rows.join(table, "k").select("id", "k", "name").collect()))
    for share in (0.0, 0.01, 1.0):
        assert sorted(map(tuple, lookup(rows, table, "k", share).select("id", "k", "name").collect())) == want
    assert lookup(rows.where("false"), table, "k").count() == 0


def test_unfinished_model_is_not_loaded(spark, tmp_path):
    scores = agg.interaction_strength(behavior_events(spark, SF_SMALL))
    dicts = rec.fit_indexers(scores)
    model = rec.fit_als(rec.encode(scores, dicts), max_iter=1)
    roots = {save_model(model, dicts, str(tmp_path / "m")) for _ in range(2)}
    assert len(roots) == 2  # in one second or not
    load_model(spark, roots.pop())
    model.write().save(str(tmp_path / "half" / "als"))
    with pytest.raises(FileNotFoundError):
        load_model(spark, str(tmp_path / "half"))
