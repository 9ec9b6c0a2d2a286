"""Filter-type feature selection: correlation with the target, ranked."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import NO_SPREAD, corr_from_sums
from ..functions.reshape import stack_long

CORR_DIGITS = 4     # the source rounds correlations to 4 places and ranks those
MATRIX_DIGITS = 10


def centers(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """A value near the middle of each column, one scan: its mean, or for a constant column its value.

    Sums of squares and products are taken of offsets from it, so they lose nothing for a column far from zero.
    """
    x = [F.col(c).cast("double") for c in columns]
    row = df.agg(*[a for i, v in enumerate(x) for a in (F.avg(v).alias(f"m{i}"), F.min(v).alias(f"lo{i}"),
                                                        F.max(v).alias(f"hi{i}"))]).first()
    return {c: row[f"lo{i}"] if row[f"lo{i}"] == row[f"hi{i}"] else row[f"m{i}"]
            for i, c in enumerate(columns) if row[f"m{i}"] is not None}


def corr_target(df: DataFrame, predictors: Sequence[str], target: str, digits: int = CORR_DIGITS,
                center: Mapping[str, float] | None = None) -> DataFrame:
    """(variable, correlation) for every predictor over the rows where it and the target exist.

    Two scans: a middle value of every column (``centers``; none if ``center`` is given), then the
    sums of the offsets from it.
    """
    center = centers(df, [*predictors, target]) if center is None else center
    value = lambda c: F.col(c).cast("double") - F.lit(float(center.get(c, 0.0)))
    y, aggs, out = value(target), [], []
    for i, p in enumerate(predictors):
        x = F.when(y.isNotNull(), value(p))
        of_x = F.when(x.isNotNull(), y)
        aggs += [F.count(x).alias(f"n{i}"), F.sum(x).alias(f"x{i}"), F.sum(of_x).alias(f"y{i}"),
                 F.sum(x * x).alias(f"xx{i}"), F.sum(of_x * of_x).alias(f"yy{i}"), F.sum(x * y).alias(f"xy{i}")]
        r = corr_from_sums(*[F.col(f"{s}{i}") for s in ("n", "x", "y", "xx", "yy", "xy")])
        out.append((F.round(r, digits) + F.lit(0.0)).alias(f"r{i}"))     # + 0.0: no negative zero
    wide = df.agg(*aggs).select(*out)
    return stack_long(wide, [([p], [f"r{i}"]) for i, p in enumerate(predictors)],
                      ["variable", "correlation"])


def corr_matrix(df: DataFrame, columns: Sequence[str], digits: int = MATRIX_DIGITS,
                center: Mapping[str, float] | None = None) -> DataFrame:
    """Upper triangle of the correlation matrix as (var_a, var_b, r), pair by pair:
    a row counts for every pair of columns that both have a value in it.

    Offsets from the columns' middle values (null as 0; ``centers``, unless ``center`` is given), their squares
    and presence flags form one vector, and its Gram matrix, a single tree aggregation, holds
    all pairwise sums; only that 3k x 3k matrix reaches the driver. A constant column gives null.
    """
    spark, k = df.sparkSession, len(columns)
    center = centers(df, columns) if center is None else center
    x = [F.coalesce(F.col(c).cast("double") - F.lit(float(center.get(c, 0.0))), F.lit(0.0)) for c in columns]
    parts = [*x, *[v * v for v in x], *[F.col(c).isNotNull().cast("double") for c in columns]]
    wide = df.select(*[p.alias(f"c{i}") for i, p in enumerate(parts)])
    vec = VectorAssembler(inputCols=wide.columns, outputCol="v").transform(wide).select("v")
    vec = MLUtils.convertVectorColumnsFromML(vec, "v")
    gram = RowMatrix(vec).computeGramianMatrix().toArray() if not df.isEmpty() else None
    rows = []
    for i, a in enumerate(columns):
        for j in range(i + 1, k):
            r = None
            if gram is not None:
                n, sx, sy = gram[2 * k + i][2 * k + j], gram[i][2 * k + j], gram[j][2 * k + i]
                sxx, syy, sxy = gram[k + i][2 * k + j], gram[k + j][2 * k + i], gram[i][j]
                vx, vy = n * sxx - sx * sx, n * syy - sy * sy
                varies = vx > NO_SPREAD * n * sxx and vy > NO_SPREAD * n * syy
                r = float((n * sxy - sx * sy) / (math.sqrt(vx) * math.sqrt(vy))) if varies else None
            rows.append((a, columns[j], r))
    out = spark.createDataFrame(rows, "var_a string, var_b string, r double")
    return out.withColumn("r", F.round("r", digits))


def rank_features(corr: DataFrame, top_n: int = 10) -> DataFrame:
    """Rank by |correlation| descending, ties by name, null last; flag the top.

    The window has no partition key, but it runs on one row per predictor.
    """
    w = Window.orderBy(F.abs(F.col("correlation")).desc_nulls_last(), F.col("variable"))
    return (corr.withColumn("rank", F.row_number().over(w))
                .withColumn("selected", (F.col("rank") <= top_n) & F.col("correlation").isNotNull()))


def select_features(df: DataFrame, predictors: Sequence[str], target: str, top_n: int = 10) -> DataFrame:
    return rank_features(corr_target(df, predictors, target), top_n)


def selected_list(ranked: DataFrame) -> list[str]:
    """The chosen names in rank order (at most one row per predictor)."""
    return [r["variable"] for r in ranked.filter("selected").orderBy("rank").select("variable").collect()]
