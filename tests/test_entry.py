import __spark_entry__ as entry


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() == 1000
    assert len(df.columns) == 11 + 14


def test_every_oracle_has_a_query():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    library = {k for k in q if k != "pipeline" and not k.startswith("op")}
    assert {"recommend_top10", "recommend_all"} == library - set(o)
