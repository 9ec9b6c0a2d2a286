"""Scoring requests with a saved pipeline: batch or stream, same transform.

A request is ``(request_id, features map<string,double>)``. Requests missing
any required feature, or holding null or NaN for it, are rejected with those
names; extra keys are ignored and key order does not matter, because values
are looked up by name and assembled in the model's own feature order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

REQUEST_SCHEMA = "request_id bigint, features map<string,double>"
OUTPUT_COLUMNS = ["request_id", "status", "model", "prediction", "risk", "probability", "missing"]


def missing_features(map_col: str, required: Sequence[str]):
    """Required names that the map lacks or holds as null or NaN."""
    need = F.array(*[F.lit(c) for c in required])
    value = lambda name: F.element_at(F.col(map_col), name)
    return F.filter(need, lambda name: F.coalesce(value(name).isNull() | F.isnan(value(name)), F.lit(True)))


def score(model: PipelineModel, name: str, requests: DataFrame, required: Sequence[str],
          map_col: str = "features") -> DataFrame:
    """Scored and rejected requests in one frame; scored + rejected = input.

    One pass: a rejected request goes through the model with zeros in the
    gaps, and its outputs are set to null. No value of a request can fail
    the job.
    """
    tagged = requests.select("request_id", missing_features(map_col, required).alias("missing"), F.col(map_col).alias("_m"))
    value = lambda c: F.element_at("_m", F.lit(c))
    wide = tagged.select("request_id", "missing", *[
        F.when(F.array_contains("missing", F.lit(c)), F.lit(0.0)).otherwise(value(c)).alias(c) for c in required])
    pred = model.transform(wide)
    ok = F.size("missing") == 0
    prob = (F.get(vector_to_array(F.col("probability")), 1) if "probability" in pred.columns
            else F.lit(None).cast("double"))
    return pred.select(
        "request_id", F.when(ok, "scored").otherwise("rejected").alias("status"), F.lit(name).alias("model"),
        F.when(ok, F.col("prediction").cast("int")).alias("prediction"),
        F.when(ok, F.col("prediction") == 1).alias("risk"),
        F.when(ok, F.round(prob, 4)).alias("probability"), "missing")


def requests_from_json(df: DataFrame, body_col: str = "body", id_col: str = "request_id") -> DataFrame:
    """Parse JSON request bodies ``{"features": {name: number, ...}}``.

    A body that does not parse gives a null map, which ``score`` rejects
    with every required name missing.
    """
    parsed = F.from_json(F.col(body_col), "features map<string,double>")
    m = F.coalesce(parsed["features"], F.create_map().cast("map<string,double>"))
    return df.select(F.col(id_col).cast("bigint").alias("request_id"), m.alias("features"))


def requests_from_table(df: DataFrame, features: Sequence[str], id_col: str,
                        drop_key_when=None, extra_key: str | None = None) -> DataFrame:
    """Turn table rows into requests (a map per row).

    ``drop_key_when`` (a Column) removes the first feature's key on matching
    rows to exercise rejection; ``extra_key`` adds an unused key.
    """
    pairs = []
    for c in features:
        pairs += [F.lit(c), F.col(c).cast("double")]
    if extra_key:
        pairs += [F.lit(extra_key), F.lit(0.0)]
    m = F.create_map(*pairs)
    if drop_key_when is not None:
        m = F.when(drop_key_when, F.map_filter(m, lambda k, v: k != F.lit(features[0]))).otherwise(m)
    return df.select(F.col(id_col).cast("bigint").alias("request_id"), m.alias("features"))
