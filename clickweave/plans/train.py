"""Batch training job (G7): lake -> time range -> interaction scores ->
dictionaries -> ALS -> versioned artifacts."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint
from ..operators.aggregates import interaction_strength_sql
from ..operators.ranking import ranking_metrics, summary
from ..operators.recommend import encode, fit_als, fit_indexers, recommend
from ..sources.lake import day_range, read_lake, time_range
from ..sources.models import save_model


def interactions_for_range(spark: SparkSession, events: DataFrame, start: str | None,
                           end: str | None) -> DataFrame:
    """Interaction scores of the events in ``[start, end)`` (A6 + A8 + C1).

    The scores feed three jobs (two dictionaries and ALS), so they are
    checkpointed once into the shared checkpoint folder instead of
    re-scanning the lake per job.
    """
    scored = interaction_strength_sql(spark, time_range(events, start, end))
    return checkpoint(scored)


def train(spark: SparkSession, lake_path: str, start: str | None, end: str | None, out: str,
          rank: int = 10, max_iter: int = 10, reg: float = 0.1, version: str | None = None) -> str:
    events = read_lake(spark, lake_path)
    interactions = interactions_for_range(spark, events, start, end)
    dicts = fit_indexers(interactions)
    model = fit_als(encode(interactions, dicts), rank=rank, max_iter=max_iter, reg=reg)
    return save_model(model, dicts, out, version=version)


def evaluate(spark: SparkSession, lake_path: str, start: str | None, cut: str, end: str, n: int = 10, rank: int = 10,
             max_iter: int = 10, reg: float = 0.1) -> DataFrame:
    """Quality of a model trained on ``[start, cut)`` for what its users do in
    ``[cut, end)``: per-user metrics (``operators.ranking``). Users that the
    model doesn't know have hits 0."""
    events = read_lake(spark, lake_path)
    before = time_range(events, start or "1970-01-01T00:00:00+00:00", cut)
    interactions = checkpoint(interaction_strength_sql(spark, before))
    dicts = fit_indexers(interactions)
    model = fit_als(encode(interactions, dicts), rank=rank, max_iter=max_iter, reg=reg)
    later = time_range(events, cut, end).select("user_id", "product_id")
    return ranking_metrics(recommend(model, dicts, later, n=n), later, n)


def main(argv=None):
    p = argparse.ArgumentParser(description="train the recommender on a time range of the lake")
    p.add_argument("--lake", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--start")
    p.add_argument("--end")
    p.add_argument("--day", help="UTC day, instead of --start/--end")
    p.add_argument("--holdout-from", help="also report the quality of a model trained on the events before this time")
    a = p.parse_args(argv)
    start, end = day_range(a.day) if a.day else (a.start, a.end)
    from ..session import get_session
    spark = get_session()
    if a.holdout_from:
        if not end:
            p.error("--holdout-from needs --end or --day")
        print(summary(evaluate(spark, a.lake, start, a.holdout_from, end)).first().asDict())
    print(train(spark, a.lake, start, end, a.out))


if __name__ == "__main__":
    main()
