"""Column expressions shared by the operators. All JVM-side built-ins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..spec import ScoreRule


def as_int(cond: Column) -> Column:
    return cond.cast("int")


def health_score(rule: ScoreRule) -> Column:
    """0-7: one point per healthy component (see ``ScoreRule``)."""
    c = F.col
    parts = [
        c(rule.non_smoker) == 0,
        c(rule.active) == 1,
        (c(rule.fruit) == 1) & (c(rule.vegetables) == 1),
        c(rule.measure) < rule.healthy_below,
        c(rule.pressure) == 0,
        c(rule.cholesterol) == 0,
        c(rule.diabetes) == 0,
    ]
    total = as_int(parts[0])
    for p in parts[1:]:
        total = total + as_int(p)
    return total


def right_closed_band(col: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval (edges[i], edges[i+1]] holding ``col``; null outside.

    ``Bucketizer`` is left-closed, so the bands are written out instead.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per interval")
    out = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        cond = (col > lo) & (col <= hi)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(None).cast("string"))


def safe_corr(a: str | Column, b: str | Column) -> Column:
    """Pearson correlation over the rows where both values exist; null for a constant input.

    ``corr`` fails with DIVIDE_BY_ZERO under ANSI mode; the population
    covariance over the product of population deviations is the same value,
    with either side set to null where the other one is.
    """
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    x, y = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


NO_SPREAD = 1e-13       # a variance under this share of the mean square is rounding, not spread


def corr_from_sums(n: Column, sx: Column, sy: Column, sxx: Column, syy: Column, sxy: Column) -> Column:
    """Pearson correlation from sums of offsets over the rows where both values exist; null without spread."""
    vx, vy = n * sxx - sx * sx, n * syy - sy * sy
    varies = (vx > F.lit(NO_SPREAD) * n * sxx) & (vy > F.lit(NO_SPREAD) * n * syy)
    return F.when(varies, F.try_divide(n * sxy - sx * sy, F.sqrt(vx) * F.sqrt(vy)))


def portable_uniform(seed: int, *keys: Column) -> Column:
    """Uniform [0, 1) from the md5 of the keys' text, in steps of 2^-32: any engine computes the same value.

    For small tables such as a search's population; ``hashed_uniform`` is cheaper for data.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def hashed_uniform(seed: int, *keys: Column, resolution: int = 1 << 30) -> Column:
    """Uniform [0, 1) from a hash of the keys: same value whatever the layout.

    Unlike ``rand(seed)`` it does not depend on partitioning, so a retried or
    re-planned task reproduces it exactly.
    """
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(resolution)) / F.lit(float(resolution))


def equal_width_bin(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """1-based equal-width bin; the maximum falls in the last bin, a constant in bin 1."""
    raw = F.floor(F.try_divide(F.lit(bins) * (x - lo), hi - lo)).cast("bigint") + F.lit(1)
    return (F.when(x.isNull(), F.lit(None).cast("bigint"))
            .when(hi == lo, F.lit(1).cast("bigint"))
            .otherwise(F.least(raw, F.lit(bins).cast("bigint"))))


def class_weight(target: str, prevalence: Column | float) -> Column:
    """(1 - p) / p for positives, 1 for negatives."""
    p = prevalence if isinstance(prevalence, Column) else F.lit(float(prevalence))
    return F.when(F.col(target) == 1, (F.lit(1.0) - p) / p).otherwise(F.lit(1.0))
