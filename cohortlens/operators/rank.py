"""Positions in a total order over the whole table, without a window that holds it.

The rows are stored once, so that each has a lasting address (file, row in the
file). They are dealt to ranges of the order by ``repartitionByRange``, sorted inside
each range and stored again: file ``i`` then holds the i-th stretch of the order, and
a row's position is the rows of the files before plus its own place in its file. Rows
that the order does not tell apart are ordered by a hash of their address, so a
group of equal rows of any size spreads over many ranges. Addresses are data, so
a retried task gives the same positions. Only one count per file meets in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import work_path

ROWS_PER_RANGE = 500_000       # what one task sorts
MIN_RANGES = 8
_PLACES = ("_file", "_row")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared work folder and read back."""
    spark: SparkSession = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _with_places(table: DataFrame) -> DataFrame:
    """A stored table with the number of each row's file and its place there."""
    return table.select("*", F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long").alias("_file"),
                        F.col("_metadata.row_index").alias("_row"))


def digest(columns: Sequence[str | Column], seed: int = 0) -> list[Column]:
    """128 bits of the columns' values as two 64-bit columns. A null adds nothing to a hash, so the
    pattern of nulls is hashed too."""
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    nulls = F.concat(F.lit(""), *[F.when(c.isNull(), "1").otherwise("0") for c in cols])
    return [F.xxhash64(F.lit(seed + i), nulls, *cols) for i in (1, 2)]


def _ordered(df: DataFrame, order: Sequence[str | Column], ranges: int | None, name: str) -> DataFrame:
    """Columns of ``df``, and ``_file``, ``_row``: files hold consecutive stretches of the order.
    Columns that the order names are sorted as they are, others travel as keys."""
    source = stored(df, f"{name}-rows")
    if ranges is None:
        ranges = max(MIN_RANGES, math.ceil(source.count() / ROWS_PER_RANGE))
    keys = [F.col(c if isinstance(c, str) else f"_k{i}") for i, c in enumerate(order)]
    made = [c.alias(f"_k{i}") for i, c in enumerate(order) if not isinstance(c, str)]
    salted = _with_places(source).select(*source.columns, *made, F.xxhash64(*_PLACES).alias("_salt"), *_PLACES)
    by = [*keys, F.col("_salt"), *map(F.col, _PLACES)]
    dealt = salted.repartitionByRange(ranges, *by).sortWithinPartitions(*by).select(*source.columns)
    return _with_places(stored(dealt, f"{name}-ordered"))


def _offsets(ordered: DataFrame, **sums: Column) -> DataFrame:
    """(_file, _before, _sum_<name>..): rows, and sums, of all files before each one; a row per file."""
    per_file = ordered.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"),
                                            *[F.sum(c).alias(f"_of_{n}") for n, c in sums.items()])
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    return per_file.select("_file", F.coalesce(F.sum("_rows").over(before), zero).alias("_before"),
                           *[F.coalesce(F.sum(f"_of_{n}").over(before), zero).alias(f"_sum_{n}") for n in sums])


def global_rank(df: DataFrame, order: Sequence[str | Column], name: str = "rank", ranges: int | None = None) -> DataFrame:
    """``df`` with its 0-based position by ``order``; rows that tie there come in a fixed random order."""
    return _ranked(_ordered(df, order, ranges, "rank"), df.columns, name)


def _ranked(ordered: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """The ``columns`` of an ordered table and the position of each row."""
    return (ordered.join(F.broadcast(_offsets(ordered)), "_file")      # a row per file
            .select(*columns, (F.col("_before") + F.col("_row")).alias(name)))


def rank_within(df: DataFrame, within: Sequence[str], order: Sequence[str | Column] = (), name: str = "rank",
                ranges: int | None = None) -> DataFrame:
    """``df`` with its 0-based position by ``order`` among the rows with equal ``within`` (nulls are equal).

    A group begins at its least position in the whole, one aggregate. Groups that reach over several files are fewer
    than the files and their starts are broadcast; their rows do not meet by group. Other groups of more than one row
    hold a file's rows at most and are looked up by a join; groups of one row need no look-up.
    """
    parts = digest(within)
    keyed = df.select("*", *[p.alias(f"_g{i}") for i, p in enumerate(parts)])
    ranked = _ranked(_ordered(keyed, ["_g0", "_g1", *order], ranges, "rank"), [*keyed.columns, "_file"], "_position")
    groups = stored(ranked.groupBy("_g0", "_g1").agg(
        F.min("_position").alias("_start"), F.count(F.lit(1)).alias("_n"), (F.min("_file") < F.max("_file")).alias("_wide"))
        .filter("_n > 1").drop("_n"), "rank-groups")
    found = ranked.join(F.broadcast(groups.filter("_wide").drop("_wide")), ["_g0", "_g1"], "left")
    start = F.col("_start")
    narrow = groups.filter("NOT _wide").select(F.col("_g0").alias("_h0"), F.col("_g1").alias("_h1"),
                                               F.lit(True).alias("_looked"), F.col("_start").alias("_begin"))
    if not narrow.isEmpty():
        # rows that have their start already go anywhere, so that none of the tasks gets a wide group
        apart = lambda i: F.when(start.isNull(), F.col(f"_g{i}")).otherwise(F.xxhash64("_position", F.lit(i)))
        found = (found.select("*", apart(0).alias("_h0"), apart(1).alias("_h1"), start.isNull().alias("_looked"))
                 .join(narrow, ["_h0", "_h1", "_looked"], "left"))
        start = F.coalesce("_start", "_begin")
    return found.select(*df.columns, F.coalesce(F.col("_position") - start, F.lit(0).cast("long")).alias(name))


def row_ids(df: DataFrame, columns: Sequence[str] | None = None, name: str = "row_id", seed: int = 42,
            ranges: int | None = None) -> DataFrame:
    """``df`` with a unique text id: 128 bits of the row's values and the number of the copy (0, 1, ..).

    The same table gives the same set of ids whatever its layout; which of several equal rows gets
    which number is all that depends on it.
    """
    columns = list(columns or df.columns)
    a, b = digest(columns, seed)
    counted = rank_within(df, columns, name="_copy", ranges=ranges)
    return counted.select(*df.columns, F.concat(F.lower(F.lpad(F.hex(a), 16, "0")), F.lower(F.lpad(F.hex(b), 16, "0")),
                                                F.lit("-"), F.col("_copy").cast("string")).alias(name),
                          F.col("_copy").alias(f"{name}_copy"))


def prefix_sums(df: DataFrame, order: Sequence[str | Column], sums: dict[str, str], ranges: int | None = None) -> DataFrame:
    """``df`` with running sums, this row's included: ``sums`` names them and the column that each adds up.

    Sums of whole files before come from one row a file; inside a file a window runs over that file alone.
    """
    ordered = _ordered(df, order, ranges, "prefix")
    offsets = _offsets(ordered, **{n: F.col(c) for n, c in sums.items()})
    inside = Window.partitionBy("_file").orderBy("_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = ordered.select(*df.columns, "_file", *[F.sum(c).over(inside).alias(f"_in_{n}") for n, c in sums.items()])
    return running.join(offsets, "_file").select(
        *df.columns, *[(F.col(f"_sum_{n}") + F.col(f"_in_{n}")).alias(n) for n in sums])
