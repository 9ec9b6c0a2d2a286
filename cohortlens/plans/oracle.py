"""DuckDB SQL for the oracle side of every checked query.

Written by hand per query, over the same analog view, so the Spark plan and
the SQL are independent paths to the same rows. Shared pieces (the raw view,
cleaning, narrowing) are CTEs generated from the same ``SurveySpec``.
"""

from __future__ import annotations

from collections.abc import Sequence

from ..operators.profile import STAT_DIGITS
from ..operators.select import CORR_DIGITS, MATRIX_DIGITS
from ..sources.analog import ANALOG_SQL, ANALOG_SQL_NO_ID
from ..spec import ANALOG, SurveySpec

S = ANALOG


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def score_sql(spec: SurveySpec) -> str:
    r = spec.score
    parts = [f"{r.non_smoker} = 0", f"{r.active} = 1", f"({r.fruit} = 1 AND {r.vegetables} = 1)",
             f"{r.measure} < {r.healthy_below}", f"{r.pressure} = 0", f"{r.cholesterol} = 0",
             f"{r.diabetes} = 0"]
    return " + ".join(f"CAST({p} AS INTEGER)" for p in parts)


def band_sql(spec: SurveySpec) -> str:
    e, labels = spec.age_edges, spec.age_labels
    whens = " ".join(f"WHEN {spec.age} > {lo} AND {spec.age} <= {hi} THEN '{lab}'"
                     for lo, hi, lab in zip(e[:-1], e[1:], labels))
    return f"CASE {whens} ELSE NULL END"


def ctes(spec: SurveySpec = S) -> str:
    not_null = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in spec.columns)
    lo, hi = spec.measure_range
    narrowed = ", ".join(f"TRY_CAST(trunc({c}) AS SMALLINT) AS {c}" for c in spec.columns)
    return f"""raw AS ({ANALOG_SQL}),
clean AS (
  SELECT *, {score_sql(spec)} AS {spec.score_col}, {band_sql(spec)} AS {spec.band_col}
  FROM raw WHERE {not_null} AND {spec.measure} BETWEEN {lo} AND {hi}),
curated AS (
  SELECT {spec.id_col}, {narrowed}, TRY_CAST({spec.score_col} AS SMALLINT) AS {spec.score_col}, {spec.band_col}
  FROM clean)"""


def with_ctes(body: str, extra: str = "") -> str:
    return f"WITH {ctes()}{',' + extra if extra else ''}\n{body}"


T = S.target
PRED = S.predictors
ALL = list(S.columns)


def safe_corr_sql(a: str, b: str) -> str:
    d = f"(stddev_pop({a}) * stddev_pop({b}))"
    return f"CASE WHEN {d} = 0 THEN NULL ELSE covar_pop({a}, {b}) / {d} END"


def union_from_row(row_cte: str, rows: Sequence[tuple[Sequence[str], Sequence[str]]],
                   out: Sequence[str]) -> str:
    sels = []
    for labels, cols in rows:
        vals = [f"'{x}'" for x in labels] + list(cols)
        sels.append("SELECT " + ", ".join(f"{v} AS {q(o)}" for v, o in zip(vals, out)) + f" FROM {row_cte}")
    return "\nUNION ALL ".join(sels)


def factor_counts_sql(src: str, variables: Sequence[str], kind: str = "DOUBLE") -> str:
    on = ", ".join(variables)
    return f"""SELECT variable, CAST(value AS {kind}) AS value, COUNT({T}) AS n,
       CAST(SUM({T}) AS BIGINT) AS cases, CAST(AVG({T}) AS DOUBLE) AS rate
FROM (UNPIVOT (SELECT {on}, {T} FROM {src}) ON {on} INTO NAME variable VALUE value)
WHERE {T} IS NOT NULL GROUP BY variable, value"""


def corr_target_sql() -> str:
    cols = ", ".join(f"round({safe_corr_sql(p, T)}, {CORR_DIGITS}) + CAST(0 AS DOUBLE) AS r{i}" for i, p in enumerate(PRED))
    body = union_from_row("w", [([p], [f"r{i}"]) for i, p in enumerate(PRED)], ["variable", "correlation"])
    return with_ctes(body, f"\nw AS (SELECT {cols} FROM clean)")


def corr_nulls_sql() -> str:
    """Pairwise over rows before cleaning, by the engine's own correlation."""
    cols = ", ".join(f"round(corr({p}, {T}), {CORR_DIGITS}) + CAST(0 AS DOUBLE) AS r{i}" for i, p in enumerate(PRED))
    body = union_from_row("w", [([p], [f"r{i}"]) for i, p in enumerate(PRED)], ["variable", "correlation"])
    return with_ctes(body, f"\nw AS (SELECT {cols} FROM raw)")


def assembled_sql(top_n: int = 10) -> str:
    """(id, position, value) of the selected features in rank order."""
    wide = ", ".join(f"CAST({p} AS DOUBLE) AS {p}" for p in PRED)
    return f"""SELECT v.{S.id_col}, CAST(f.rank - 1 AS INTEGER) AS position, v.value
FROM ({with_ctes(f"SELECT * FROM (UNPIVOT (SELECT {S.id_col}, {wide} FROM curated) ON {', '.join(PRED)} INTO NAME variable VALUE value)")}) v
JOIN ({feature_rank_sql(top_n)}) f ON v.variable = f.variable AND f.selected"""


def request_status_sql() -> str:
    """Status and missing names of the requests of ``modelling.requests``."""
    name = lambda k: f"(SELECT variable FROM ({feature_rank_sql(10)}) f WHERE rank = {k})"
    return f"""SELECT request_id, CASE WHEN missing = '' THEN 'scored' ELSE 'rejected' END AS status, missing
FROM (SELECT {S.id_col} AS request_id, concat_ws(',', CASE WHEN {S.id_col} % 97 = 0 THEN a END,
        CASE WHEN {S.id_col} % 89 = 1 THEN b END, CASE WHEN {S.id_col} % 83 = 2 THEN c END) AS missing
      FROM ({with_ctes(f"SELECT {S.id_col} FROM curated")}) r,
        (SELECT {name(1)} AS a, {name(2)} AS b, {name(3)} AS c) n) s"""


def rule_metrics_sql(rule: str) -> str:
    """Classification metrics of the 0/1 prediction ``rule``."""
    return metrics_sql(f"SELECT {T} AS y, CASE WHEN {rule} THEN 1 ELSE 0 END AS p FROM clean")


def metrics_sql(predicted: str, extra: str = "") -> str:
    """Classification metrics of ``predicted`` (y, p), a query over the shared CTEs and ``extra`` ones."""
    return with_ctes("""SELECT
  (n11 + n00) / n AS accuracy,
  (n1 * p1 + n0 * p0) / n AS precision, (n1 * r1 + n0 * r0) / n AS recall,
  (n1 * 2 * p1 * r1 / (p1 + r1) + n0 * 2 * p0 * r0 / (p0 + r0)) / n AS f1,
  r1 AS recall_pos, 2 * p1 * r1 / (p1 + r1) AS f1_pos
FROM (SELECT *, n11 / (n11 + n01) AS p1, n11 / n1 AS r1, n00 / (n00 + n10) AS p0, n00 / n0 AS r0 FROM t)""", f"""{extra}
t AS (SELECT CAST(COUNT(*) AS DOUBLE) AS n, CAST(COUNT(*) FILTER (WHERE y = 1) AS DOUBLE) AS n1,
        CAST(COUNT(*) FILTER (WHERE y = 0) AS DOUBLE) AS n0,
        CAST(COUNT(*) FILTER (WHERE y = 1 AND p = 1) AS DOUBLE) AS n11,
        CAST(COUNT(*) FILTER (WHERE y = 0 AND p = 0) AS DOUBLE) AS n00,
        CAST(COUNT(*) FILTER (WHERE y = 0 AND p = 1) AS DOUBLE) AS n01,
        CAST(COUNT(*) FILTER (WHERE y = 1 AND p = 0) AS DOUBLE) AS n10
      FROM ({predicted}))""")


def feature_rank_sql(top_n: int = 10) -> str:
    inner = corr_target_sql()
    return f"""SELECT variable, correlation,
       row_number() OVER (ORDER BY abs(correlation) DESC NULLS LAST, variable) AS rank,
       (row_number() OVER (ORDER BY abs(correlation) DESC NULLS LAST, variable) <= {top_n}
        AND correlation IS NOT NULL) AS selected
FROM ({inner}) c"""


def corr_matrix_sql() -> str:
    pairs = [(a, b) for i, a in enumerate(ALL) for b in ALL[i + 1:]]
    cols = ", ".join(f"round({safe_corr_sql(a, b)}, {MATRIX_DIGITS}) AS r{i}" for i, (a, b) in enumerate(pairs))
    body = union_from_row("w", [([a, b], [f"r{i}"]) for i, (a, b) in enumerate(pairs)], ["var_a", "var_b", "r"])
    return with_ctes(body, f"\nw AS (SELECT {cols} FROM clean)")


def describe_sql(columns: Sequence[str], by: str | None = None) -> str:
    aggs = []
    for i, c in enumerate(columns):
        aggs += [f"COUNT({c}) AS n{i}", f"AVG({c}) AS mean{i}",
                 f"round(stddev_samp({c}), {STAT_DIGITS}) AS sd{i}",
                 f"CAST(MIN({c}) AS DOUBLE) AS min{i}",
                 f"round(quantile_cont({c}, 0.25), {STAT_DIGITS}) AS q1{i}",
                 f"round(quantile_cont({c}, 0.5), {STAT_DIGITS}) AS med{i}",
                 f"round(quantile_cont({c}, 0.75), {STAT_DIGITS}) AS q3{i}",
                 f"CAST(MAX({c}) AS DOUBLE) AS max{i}"]
    stats = ["n", "mean", "sd", "min", "q1", "med", "q3", "max"]
    out = ["variable", "count", "mean", "std", "min", "q25", "q50", "q75", "max"]
    sels = []
    for i, c in enumerate(columns):
        vals = [f"'{c}'"] + [f"{s}{i}" for s in stats]
        keep = f"{by}, " if by else ""
        sels.append(f"SELECT {keep}" + ", ".join(f"{v} AS {q(o)}" for v, o in zip(vals, out)) + " FROM w")
    group = f" GROUP BY {by}" if by else ""
    keep = f"{by}, " if by else ""
    return with_ctes("\nUNION ALL ".join(sels), f"\nw AS (SELECT {keep}{', '.join(aggs)} FROM clean{group})")


def null_counts_sql() -> str:
    aggs = ", ".join(f"COUNT({c}) AS nn{i}, COUNT(*) FILTER (WHERE {c} IS NULL) AS nu{i}" for i, c in enumerate(ALL))
    body = union_from_row("w", [([c], [f"nn{i}", f"nu{i}"]) for i, c in enumerate(ALL)],
                          ["variable", "non_null", "nulls"])
    return with_ctes(body, f"\nw AS (SELECT {aggs} FROM raw)")


def histogram_sql(bins: int = 30) -> str:
    rng = ", ".join(f"CAST(MIN({c}) AS DOUBLE) AS lo{i}, CAST(MAX({c}) AS DOUBLE) AS hi{i}" for i, c in enumerate(ALL))
    sels = []
    for i, c in enumerate(ALL):
        x = f"CAST({c} AS DOUBLE)"
        b = (f"CASE WHEN {c} IS NULL THEN NULL WHEN hi{i} = lo{i} THEN CAST(1 AS BIGINT) "
             f"ELSE LEAST(CAST(floor({bins} * ({x} - lo{i}) / (hi{i} - lo{i})) AS BIGINT) + 1, {bins}) END")
        sels.append(f"SELECT '{c}' AS variable, {b} AS bin, lo{i} AS lo, hi{i} AS hi FROM clean, r")
    every = " UNION ALL ".join(f"SELECT '{c}' AS variable, bin, lo{i} AS lo, hi{i} AS hi FROM r, range(1, {bins + 1}) b(bin)"
                               for i, c in enumerate(ALL))
    body = f"""SELECT variable, bin, CAST(SUM(k) AS BIGINT) AS n, lo, hi
FROM (SELECT *, 1 AS k FROM ({' UNION ALL '.join(sels)}) t WHERE bin IS NOT NULL
      UNION ALL SELECT *, 0 AS k FROM ({every}) e) u GROUP BY variable, bin, lo, hi"""
    return with_ctes(body, f"\nr AS (SELECT {rng} FROM clean)")


def zero_share_sql(columns: Sequence[str]) -> str:
    aggs = ", ".join(f"AVG(CAST(COALESCE({c} = 0, false) AS INTEGER)) AS z{i}" for i, c in enumerate(columns))
    body = union_from_row("w", [([c], [f"z{i}"]) for i, c in enumerate(columns)], ["variable", "zero_share"])
    return with_ctes(body, f"\nw AS (SELECT {aggs} FROM raw)")


def prevalence_sql(src: str = "curated", variables: Sequence[str] = S.binary) -> str:
    return with_ctes(factor_counts_sql(src, variables, "INTEGER") + "\nORDER BY variable, value")


def factor_gap_sql(top: int = 12) -> str:
    p = factor_counts_sql("curated", S.binary, "INTEGER")
    return with_ctes(f"""SELECT variable, rate_0, rate_1, abs(rate_1 - rate_0) AS gap
FROM (SELECT variable, MAX(CASE WHEN value = 0 THEN rate END) AS rate_0,
             MAX(CASE WHEN value = 1 THEN rate END) AS rate_1
      FROM ({p}) p GROUP BY variable) w
WHERE rate_0 IS NOT NULL AND rate_1 IS NOT NULL
ORDER BY gap DESC, variable LIMIT {top}""")


RAW_NO_ID = ANALOG_SQL_NO_ID
