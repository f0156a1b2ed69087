"""Scoring jobs over saved artifacts.

``recommend_users`` answers "top-N products for these users" for a list of
ids given on the driver (a small literal frame, A13), and
``recommend_everyone`` writes the top-N of every known user as a table, from
which a lookup is a filter.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from ..operators.recommend import recommend, recommend_all
from ..sources.models import load_model


def recommend_users(spark: SparkSession, model_root: str, user_ids: list[str], n: int = 10) -> DataFrame:
    """``user_id, rank, product_id, rating`` for the given ids; unknown ids
    give no rows."""
    model, dicts = load_model(spark, model_root)
    users = spark.createDataFrame([(u,) for u in user_ids], "user_id string")
    return recommend(model, dicts, users, n=n)


def recommend_everyone(spark: SparkSession, model_root: str, out: str, n: int = 10) -> str:
    model, dicts = load_model(spark, model_root)
    recommend_all(model, dicts, n=n).write.mode("overwrite").parquet(out)
    return out


def main(argv=None):
    p = argparse.ArgumentParser(description="write top-N recommendations of every user")
    p.add_argument("--model", required=True, help="versioned artifact folder written by train")
    p.add_argument("--out", required=True)
    p.add_argument("-n", type=int, default=10)
    a = p.parse_args(argv)
    from ..session import get_session
    print(recommend_everyone(get_session(), a.model, a.out, a.n))


if __name__ == "__main__":
    main()
