"""Ranking quality of a score: precision-recall and ROC areas, exact at every distinct score.

Rows are counted by score first, so a score that many rows share is one entry. The running
counts over scores come from ``rank.prefix_sums``: ranges of scores, sums of whole ranges, and
a window inside each range alone. A point's predecessor on either curve is its own running
count less its own rows, so the areas are one aggregate. Spark ML's evaluator thins its
curve to about 1,000 points and sorts all scores; the areas here are not thinned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rank import prefix_sums


def curve(df: DataFrame, score: str | Column, label: str, ranges: int | None = None) -> DataFrame:
    """(score, n, positives, called, hits): per distinct score, highest first, its rows and the running counts
    of rows called positive at it and of positives among them. Rows with a null or NaN score or a null label are left out."""
    s = (F.col(score) if isinstance(score, str) else score).cast("double")
    rows = df.select(s.alias("score"), (F.col(label).cast("double") == 1.0).cast("long").alias("positive"))
    counts = (rows.filter(F.col("score").isNotNull() & ~F.isnan("score") & F.col("positive").isNotNull())
              .groupBy("score").agg(F.count(F.lit(1)).alias("n"), F.sum("positive").alias("positives")))
    return prefix_sums(counts, [-F.col("score")], {"called": "n", "hits": "positives"}, ranges)


def ranking_metrics(df: DataFrame, score: str | Column, label: str, ranges: int | None = None) -> DataFrame:
    """One row: rows, positives, auc_pr (trapezoids, from the first point's precision at recall 0, as
    Spark ML draws it), average_precision (steps) and auc_roc; null where a class is missing."""
    points = curve(df, score, label, ranges)
    called, hits, n, pos = F.col("called"), F.col("hits"), F.col("n"), F.col("positives")
    precision = hits / called
    before = F.when(called > n, (hits - pos) / F.nullif(called - n, F.lit(0))).otherwise(precision)
    sums = points.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum("positives"), F.lit(0)).alias("positives"),
                      F.sum(pos * (precision + before) / 2).alias("pr"), F.sum(pos * precision).alias("ap"),
                      F.sum((n - pos) * (hits - pos / 2)).alias("roc"))
    return sums.select("rows", "positives", F.try_divide("pr", "positives").alias("auc_pr"),
                       F.try_divide("ap", "positives").alias("average_precision"),
                       F.try_divide("roc", F.col("positives") * (F.col("rows") - F.col("positives"))).alias("auc_roc"))
