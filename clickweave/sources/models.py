"""Model artifacts (A10): the ALS model and both dictionaries are written
below one versioned folder, so a reader never mixes a model with the
dictionaries of another training run."""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import SparkSession

from ..operators.recommend import Dictionaries


def _join(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *parts])


def save_model(model: ALSModel, dicts: Dictionaries, base: str, version: str | None = None) -> str:
    """Write ``<base>/<version>/{als,users,products}`` and return the version
    folder. ``published`` is written last and marks the artifact as whole; two
    trainings of one second get versions of their own."""
    version = version or f"{time.strftime('v%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:8]}"
    root = _join(base, version)
    model.write().overwrite().save(_join(root, "als"))
    dicts.users.write.mode("overwrite").parquet(_join(root, "users"))
    dicts.products.write.mode("overwrite").parquet(_join(root, "products"))
    spark = dicts.users.sparkSession
    spark.createDataFrame([(version, model.rank)], "version string, rank int").coalesce(1).write.mode("overwrite").json(_join(root, "published"))
    return root


def load_model(spark: SparkSession, root: str) -> tuple[ALSModel, Dictionaries]:
    """The artifacts of one version; ``FileNotFoundError`` for a folder whose
    training has not come to its end."""
    try:
        spark.read.json(_join(root, "published"))
    except AnalysisException as e:
        raise FileNotFoundError(f"no published model in {root}") from e
    model = ALSModel.load(_join(root, "als"))
    dicts = Dictionaries(spark.read.parquet(_join(root, "users")),
                         spark.read.parquet(_join(root, "products")))
    return model, dicts
