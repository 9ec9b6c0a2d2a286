"""Model registry: saved pipelines plus a table saying which is newest.

Each save writes the whole ``PipelineModel`` (assembler included, so the
feature order travels with the model) and appends one row to a Parquet
registry table. Loading picks ``max_by(path, trained_at)``; an empty
registry or a model whose last stage is not a supported classifier is an
error.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    LinearSVCModel,
    LogisticRegressionModel,
    NaiveBayesModel,
    RandomForestClassificationModel,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SUPPORTED = (DecisionTreeClassificationModel, RandomForestClassificationModel, LinearSVCModel,
             LogisticRegressionModel, NaiveBayesModel)
REGISTRY_SCHEMA = ("model string, path string, features string, target string, "
                   "metric string, value double, trained_at timestamp")


class RegistryError(RuntimeError):
    pass


def register(spark: SparkSession, registry: str, model: PipelineModel, name: str, path: str,
             features: Sequence[str], target: str, metric: str, value: float) -> None:
    model.write().overwrite().save(path)
    row = [(name, path, json.dumps(list(features)), target, metric, float(value),
            dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))]
    spark.createDataFrame(row, REGISTRY_SCHEMA).coalesce(1).write.mode("append").parquet(registry)


def entries(spark: SparkSession, registry: str) -> DataFrame:
    return spark.read.schema(REGISTRY_SCHEMA).parquet(registry)


def _newest(spark: SparkSession, registry: str) -> DataFrame:
    """The newest row; of rows with one time, the largest path."""
    return entries(spark, registry).agg(F.max_by(F.struct("*"), F.struct("trained_at", "path")).alias("r"))


def latest(spark: SparkSession, registry: str) -> dict:
    """Newest registry row as a dict (one aggregate, one row to the driver)."""
    try:
        row = _newest(spark, registry).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise RegistryError(f"no model registered under {registry}") from e
    if row is None or row["r"] is None:
        raise RegistryError(f"no model registered under {registry}")
    r = row["r"].asDict()
    r["features"] = json.loads(r["features"])
    return r


def load(path: str) -> PipelineModel:
    """A saved pipeline that ends in a supported classifier."""
    model = PipelineModel.load(path)
    if not isinstance(model.stages[-1], SUPPORTED):
        raise RegistryError(f"unsupported model type: {type(model.stages[-1]).__name__}")
    return model


def load_latest(spark: SparkSession, registry: str) -> tuple[dict, PipelineModel]:
    info = latest(spark, registry)
    return info, load(info["path"])


def model_card(spark: SparkSession, registry: str) -> DataFrame:
    """Newest model: name, ordered features, target, selection metric."""
    return (_newest(spark, registry).filter("r is not null").select("r.*")
            .select("model", F.from_json("features", "array<string>").alias("features"),
                    "target", "metric", "value", "trained_at"))
