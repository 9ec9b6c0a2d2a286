"""Cleaning and derived columns (narrow, partition-local: no shuffle)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import health_score, right_closed_band
from ..spec import SurveySpec


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null or NaN in any of ``columns`` (default: all)."""
    return df.na.drop("any", subset=list(columns) if columns else None)


def keep_range(df: DataFrame, column: str, lo: float, hi: float) -> DataFrame:
    """Inclusive range filter; a NaN fails it (NaN <= hi is false)."""
    return df.filter(F.col(column).between(lo, hi))


def derive(df: DataFrame, spec: SurveySpec) -> DataFrame:
    """Add the 0-7 health score and the right-closed age band."""
    return df.withColumns({
        spec.score_col: health_score(spec.score),
        spec.band_col: right_closed_band(F.col(spec.age), spec.age_edges, spec.age_labels),
    })


def clean_and_derive(df: DataFrame, spec: SurveySpec) -> DataFrame:
    df = drop_incomplete(df, spec.columns)
    df = keep_range(df, spec.measure, *spec.measure_range)
    return derive(df, spec)


def narrow(df: DataFrame, keep: Sequence[str] = (), to: str = "short") -> DataFrame:
    """Cast every column except ``keep`` to ``to``; out-of-range values become null.

    double -> short truncates toward zero (3.9 -> 3), as the source's int16
    cast does; ``try_cast`` turns overflow into null instead of failing the
    job, and ``reject_count`` measures it.
    """
    return df.select(*[F.col(c) if c in keep else F.col(c).try_cast(to).alias(c)
                       for c in df.columns])


def narrow_curated(df: DataFrame, spec: SurveySpec) -> DataFrame:
    keep = [spec.band_col] + ([spec.id_col] if spec.id_col else [])
    return narrow(df, keep=keep)


def reject_count(df: DataFrame, columns: Sequence[str], to: str = "short") -> DataFrame:
    """Per column, how many non-null values the narrowing cast would null out."""
    aggs = [F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(to).isNull()).alias(c)
            for c in columns]
    row = df.agg(*aggs)
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return row.selectExpr(f"stack({len(columns)}, {pairs}) AS (variable, rejected)")


def curated(raw: DataFrame, spec: SurveySpec) -> DataFrame:
    """raw -> clean -> derive -> narrow: the curated table."""
    return narrow_curated(clean_and_derive(raw, spec), spec)
