"""Grouping wide rows on a 128-bit digest, exact whatever the digests do.

Grouping on many columns shuffles all of them for every distinct row. Here the
first pass counts digests: 16 bytes and a count for each distinct row, after partial
aggregation. A digest that one row holds stands for that row alone. Only rows whose
digest several rows share are grouped on their columns, in a second pass, so two rows
with one digest are never taken for the same. Where few rows repeat, little more than
digests moves; where most do, grouping on the columns at once (``profile``) is better.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rank import digest, stored

KEY = ("_digest_a", "_digest_b")


def distinct_groups(df: DataFrame, columns: Sequence[str], **aggregates: Column) -> DataFrame:
    """(n, aggregates..): one row for each distinct combination of ``columns``, nulls being equal."""
    keyed = df.select("*", *[d.alias(k) for d, k in zip(digest(columns), KEY, strict=True)])
    measures = [F.count(F.lit(1)).alias("n"), *[a.alias(name) for name, a in aggregates.items()]]
    counts = stored(keyed.groupBy(*KEY).agg(*measures), "digests")
    shared = counts.filter("n > 1").select(*KEY)
    repeated = keyed.join(shared, list(KEY), "left_semi").groupBy(*columns).agg(*measures)
    names = ["n", *aggregates]
    return counts.filter("n = 1").select(*names).unionByName(repeated.select(*names))


def duplicate_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each identical group, and the number of groups."""
    return distinct_groups(df, columns).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"), F.count(F.lit(1)).alias("distinct_rows"))


def label_conflicts(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Feature combinations, and those seen with more than one label."""
    groups = distinct_groups(df.filter(F.col(target).isNotNull()), features, lo=F.min(target), hi=F.max(target))
    return groups.agg(F.count(F.lit(1)).alias("combinations"),
                      F.coalesce(F.sum((F.col("lo") != F.col("hi")).cast("int")), F.lit(0)).cast("bigint").alias("conflicting"))
