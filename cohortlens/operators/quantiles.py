"""Exact quantiles of continuous columns by distributed selection.

A quantile with linear interpolation needs the values at the two ranks around
``(n - 1) * p``. Each wanted rank has a range of values that holds it, and the number
of values before the range. Rounds narrow the ranges:

1. one aggregate sketches the values of a range (``percentile_approx``, bounded
   memory) and gives two of them, ``a`` and ``b``, next to the rank on a grid of quantiles;
2. one aggregate counts, exactly, the values under a, at a, between, at b and over b. The
   part that holds the rank is the next range; a and b themselves are single values.

A round leaves about ``3 / GRID`` of a range, whatever the distribution and its ties, so
three or four rounds narrow 10^12 rows. A range of at most ``LEAF`` values is read off its
value counts. Ranges are rows of a small table by group and variable that is joined to
the values; nothing is collected, and no task sees more than ``LEAF`` distinct values.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.reshape import stack_long
from .rank import stored

GRID = 1000                     # quantiles of a range that are sketched
ACCURACY = 20_000
LEAF = 50_000


def long_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by.., variable, value): one row per value; nulls and NaN are left out."""
    wide = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    long = stack_long(wide, [([c], [c]) for c in columns], ["variable", "value"], keep=list(by))
    return long.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def _beside(left: DataFrame, right: DataFrame, keys: list[str], *also: Column) -> DataFrame:
    """Join on ``keys``, nulls being equal; the right side's copies of the keys go."""
    renamed = right.select(*[F.col(c).alias(f"_{c}") if c in keys else F.col(c) for c in right.columns])
    on = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + list(also))
    return left.join(renamed, on).drop(*[f"_{k}" for k in keys])


def _inside(values: DataFrame, ranges: DataFrame, keys: list[str]) -> DataFrame:
    """Each value beside the ranges of its group and variable that hold it."""
    return _beside(values, ranges, keys, F.col("value") >= F.col("lo"), F.col("value") <= F.col("hi"))


def _narrowed(values: DataFrame, ranges: DataFrame, keys: list[str], grid: int, accuracy: int) -> DataFrame:
    """The ranges after a round."""
    of_range = [*keys, "rank", "below", "size", "lo", "hi"]
    points = F.percentile_approx("value", [i / grid for i in range(grid + 1)], accuracy)
    cell = F.floor((F.col("rank") - F.col("below")) * grid / F.col("size")).cast("int")
    near = lambda shift: F.get("points", F.greatest(F.lit(0), F.least(F.lit(grid), cell + F.lit(shift))))
    edged = stored(_inside(values, ranges, keys).groupBy(*of_range).agg(points.alias("points"))
                   .select(*of_range, near(-1).alias("a"), near(2).alias("b")), "quantile-edges")
    v, a, b = F.col("value"), F.col("a"), F.col("b")
    parts = [v < a, v == a, (v > a) & (v < b), (v == b) & (b > a), v > b]
    counted = _inside(values, edged, keys).groupBy(*of_range, "a", "b").agg(
        *[x for i, part in enumerate(parts) for x in (
            F.count_if(part).alias(f"n{i}"), F.min(F.when(part, v)).alias(f"lo{i}"), F.max(F.when(part, v)).alias(f"hi{i}"))])
    # the first part whose end is over the rank
    start, chosen = F.col("below"), None
    for i in range(len(parts)):
        part = F.struct(start.alias("below"), F.col(f"n{i}").alias("size"), F.col(f"lo{i}").alias("lo"), F.col(f"hi{i}").alias("hi"))
        start = start + F.col(f"n{i}")
        chosen = F.when(F.col("rank") < start, part) if chosen is None else chosen.when(F.col("rank") < start, part)
    return counted.select(*keys, "rank", chosen.alias("part")).select(*keys, "rank", "part.*")


def exact_quantiles(values: DataFrame, probabilities: Sequence[float], by: Sequence[str] = (), grid: int = GRID,
                    leaf: int = LEAF, accuracy: int = ACCURACY) -> DataFrame:
    """(by.., variable, p, quantile) of ``values(by.., variable, value)``, with linear interpolation
    between the two values around rank ``(n - 1) * p``. Groups without values give no row."""
    keys = [*by, "variable"]
    stats = stored(values.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"), F.min("value").alias("lo"),
                                             F.max("value").alias("hi")), "quantile-stats")
    position = (F.col("size") - 1) * F.col("p")
    wanted = (stats.select("*", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("p"))
              .select("*", F.floor(position).alias("first"), F.ceil(position).alias("last"),
                      (position - F.floor(position)).alias("share")))
    ranges = stored(wanted.select(*keys, F.explode(F.array("first", "last")).alias("rank"),
                                  F.lit(0).cast("long").alias("below"), "size", "lo", "hi").distinct(), "quantile-ranges")
    open_ranges = (F.col("size") > leaf) & (F.col("lo") < F.col("hi"))
    while not ranges.filter(open_ranges).isEmpty():
        narrowed = _narrowed(values, ranges.filter(open_ranges), keys, grid, accuracy)
        ranges = stored(narrowed.unionByName(ranges.filter(~open_ranges)), "quantile-ranges")
    # one value needs no look-up; the others are read off their value counts
    single = ranges.filter("lo = hi").select(*keys, "rank", F.col("lo").alias("value"))
    counts = (_inside(values, ranges.filter("lo < hi"), keys)
              .groupBy(*keys, "rank", "below", "value").agg(F.count(F.lit(1)).alias("n")))
    running = Window.partitionBy(*keys, "rank").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    read = (counts.withColumn("end", F.col("below") + F.sum("n").over(running))
            .filter((F.col("rank") < F.col("end")) & (F.col("rank") >= F.col("end") - F.col("n")))
            .select(*keys, "rank", "value"))
    found = stored(single.unionByName(read), "quantile-values")
    lows = found.withColumnsRenamed({"rank": "first", "value": "_lo"})
    highs = found.withColumnsRenamed({"rank": "last", "value": "_hi"})
    both = _beside(_beside(wanted, lows, [*keys, "first"]), highs, [*keys, "last"])
    return both.select(*keys, "p", (F.col("_lo") + F.col("share") * (F.col("_hi") - F.col("_lo"))).alias("quantile"))
