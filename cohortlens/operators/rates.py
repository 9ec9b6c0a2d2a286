"""Rates of the target by group, by factor and by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.reshape import stack_long


def score_gradient(df: DataFrame, target: str, score: str) -> DataFrame:
    """Per score level: non-null target count, mean, percent."""
    return (df.groupBy(score)
              .agg(F.count(F.col(target)).alias("n"), F.avg(F.col(target)).alias("rate"))
              .withColumn("rate_pct", F.col("rate") * 100)
              .orderBy(score))


def score_gradient_having(df: DataFrame, target: str, score: str, min_n: int = 100) -> DataFrame:
    """Same with all rows counted and small groups dropped after aggregation."""
    return (df.groupBy(score)
              .agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(target)).alias("rate"))
              .filter(F.col("n") >= min_n)
              .withColumn("rate_pct", F.col("rate") * 100)
              .orderBy(score))


def group_rate(df: DataFrame, keys: Sequence[str], target: str, drop_null_keys: bool = True) -> DataFrame:
    """Count and mean of the target per key combination (partial + final agg).

    Rows with a null key are left out by default, as the source's group-by
    did; Spark alone would report them as a null group.
    """
    if drop_null_keys:
        df = df.na.drop(subset=list(keys))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(target)).alias("rate"))


def _factor_counts(df: DataFrame, variables: Sequence[str], target: str) -> DataFrame:
    """(variable, value, n, cases) by pre-aggregating on all the variables first.

    ``n`` counts rows with a target, so cases / n is the mean of the target;
    null keys are left out; keys keep their values (as doubles).

    The first aggregate has at most prod(distinct values) groups (2^k for k
    binaries), so every row is hashed once, not k times; only that small
    result is unpivoted and re-aggregated.
    """
    pre = (df.select(*[F.col(v).cast("double").alias(v) for v in variables],
                     F.col(target).cast("bigint").alias("_y"))
             .groupBy(*variables)
             .agg(F.count("_y").alias("_n"), F.sum("_y").alias("_c")))
    long = stack_long(pre, [([v], [v]) for v in variables], ["variable", "value"], keep=["_n", "_c"])
    return (long.filter(F.col("value").isNotNull()).groupBy("variable", "value")
                .agg(F.sum("_n").cast("bigint").alias("n"),
                     F.coalesce(F.sum("_c"), F.lit(0)).cast("bigint").alias("cases"))
                .filter("n > 0"))


def prevalence_by_factor(df: DataFrame, variables: Sequence[str], target: str) -> DataFrame:
    """Target rate for every value of every listed variable, sorted."""
    return (_factor_counts(df, variables, target).withColumn("value", F.col("value").cast("int"))
            .withColumn("rate", F.col("cases") / F.col("n"))
            .orderBy("variable", "value"))


def rounded_report(df: DataFrame, rate: str = "rate", digits: int = 2) -> DataFrame:
    """Report form of a rate table: the percent, rounded."""
    return df.withColumn(f"{rate}_pct", F.round(F.col(rate) * 100, digits)).drop(rate)


def binary_only(variables: Sequence[str], binary: Sequence[str]) -> list[str]:
    """Restrict a variable list to the known 0/1 columns, keeping its order."""
    known = set(binary)
    return [v for v in variables if v in known]


def rate_by_key(df: DataFrame, keys: Sequence[str], target: str) -> DataFrame:
    """Target rate per value of each key, all keys in one scan."""
    return (_factor_counts(df, keys, target)
            .withColumn("rate", F.col("cases") / F.col("n"))
            .orderBy("variable", "value"))


def factor_gap(prevalence: DataFrame, top: int = 12) -> DataFrame:
    """Long -> wide on value 0/1, keep complete variables, |rate1 - rate0|, top ``top``."""
    wide = (prevalence.groupBy("variable").pivot("value", [0, 1]).agg(F.first("rate"))
                      .withColumnsRenamed({"0": "rate_0", "1": "rate_1"})
                      .na.drop(subset=["rate_0", "rate_1"]))
    return (wide.withColumn("gap", F.abs(F.col("rate_1") - F.col("rate_0")))
                .orderBy(F.col("gap").desc(), F.col("variable"))
                .limit(top))


def prevalence(df: DataFrame, target: str) -> float:
    """Global mean of the target (one-row aggregate, one scalar to the driver)."""
    return df.agg(F.avg(F.col(target))).first()[0]
