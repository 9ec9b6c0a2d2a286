"""Wide-to-long helpers built on ``stack`` (stays in whole-stage codegen)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def stack_long(df: DataFrame, rows: Sequence[tuple[Sequence[str], Sequence[str]]],
               out: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One output row per entry of ``rows`` for every input row.

    Each entry is ``(labels, columns)``: string literals first, then the input
    columns whose values fill the remaining output columns. All entries must
    have the same shape and compatible types.
    """
    parts = []
    for labels, cols in rows:
        parts.extend(_lit(x) for x in labels)
        parts.extend(_q(c) for c in cols)
    expr = f"stack({len(rows)}, {', '.join(parts)}) AS ({', '.join(_q(o) for o in out)})"
    return df.selectExpr(*[_q(k) for k in keep], expr)
