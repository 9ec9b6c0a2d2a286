"""Data-quality checks: reconciliation, pruned-plan evidence, result guards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class GuardError(RuntimeError):
    pass


def reconcile(manifest: DataFrame, actual: DataFrame, dataset_col: str = "dataset") -> DataFrame:
    """(dataset, expected, actual, ok): the producer's count vs what was read.

    ``actual`` is a (dataset, rows) aggregate of the consumer's own read.
    """
    exp = manifest.groupBy(dataset_col).agg(F.max_by("rows", "written_at").alias("expected"))
    return (exp.join(actual.withColumnRenamed("rows", "actual"), on=dataset_col, how="full_outer")
               .withColumn("ok", F.coalesce(F.col("expected") == F.col("actual"), F.lit(False))))


def assert_reconciled(report: DataFrame) -> None:
    bad = report.filter(~F.col("ok")).limit(20).collect()
    if bad:
        raise GuardError(f"row counts do not reconcile: {[r.asDict() for r in bad]}")


def plan_text(df: DataFrame) -> str:
    """The formatted physical plan as text (what ``explain`` prints)."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def assert_partition_pruned(df: DataFrame, key: str) -> None:
    text = plan_text(df)
    if "PartitionFilters: [" not in text or key not in text.split("PartitionFilters: [", 1)[1].split("]", 1)[0]:
        raise GuardError(f"no partition filter on {key} in plan:\n{text}")


def report_guard(df: DataFrame, max_rows: int = 500) -> DataFrame:
    """Only an aggregated result may reach a report: fewer than ``max_rows``.

    ``limit(max_rows).count()`` reads at most ``max_rows`` rows, so the check
    costs the same on a billion-row mistake.
    """
    n = df.limit(max_rows).count()
    if n >= max_rows:
        raise GuardError(f"{n}+ rows: reports take aggregated results only")
    return df
