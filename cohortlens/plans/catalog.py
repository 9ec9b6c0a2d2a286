"""Registered queries: name -> Spark plan over a table folder, and its oracle SQL.

Every query reads the driver tables (through the survey analog) so its work
grows with them. Keys with an entry in ``ORACLE`` are checked value by value
against DuckDB; the others (fitted models and the subset search) are checked
for rows and by the unit tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import profile as P
from ..operators import rates as R
from ..operators import select as SEL
from ..operators import split as SP
from ..sources import analog
from ..sources import files as IO
from ..session import counting_session, planning_session, work_path
from ..spec import ANALOG
from . import oracle as O

S = ANALOG
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

GROUP_MIN_N = 100              # smaller groups are left out of a report
FINE_KEYS = (S.score_col, S.age, S.sex)
RATE_KEYS = ("GenHlth", "Age", "Income")
ZERO_SHARE_COLS = ("MentHlth", "PhysHlth")
SCORE_PARTS = ("Smoker", "PhysActivity", "Fruits", "Veggies", "HighBP", "HighChol", "Diabetes")
SPLIT_BUCKET_SQL = f"({S.id_col} % 10007) * 7919 % 100"   # portable 0..99 bucket


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# -- shared frames --------------------------------------------------------------

def raw(spark: SparkSession, sf: str) -> DataFrame:
    return analog.raw_analog(planning_session(spark), sf)


def clean(spark: SparkSession, sf: str) -> DataFrame:
    return C.clean_and_derive(raw(spark, sf), S)


def curated(spark: SparkSession, sf: str) -> DataFrame:
    return C.narrow_curated(clean(spark, sf), S)


def write_curated(spark: SparkSession, sf: str) -> str:
    """Write the curated table partitioned by age band; return its path."""
    path = work_path(spark, "curated")
    IO.write_partitioned(curated(spark, sf), path, S.band_col)
    return path


# -- projections, filters, derived columns ---------------------------------------

@register("score_gradient", O.with_ctes(
    f"SELECT {S.score_col}, COUNT({O.T}) AS n, AVG({O.T}) AS rate, AVG({O.T}) * 100 AS rate_pct "
    f"FROM clean GROUP BY {S.score_col} ORDER BY {S.score_col}"))
def q_score_gradient(spark, sf):
    return R.score_gradient(clean(spark, sf), S.target, S.score_col)


@register("score_gradient_having", O.with_ctes(
    f"SELECT {S.score_col}, COUNT(*) AS n, AVG({O.T}) AS rate, AVG({O.T}) * 100 AS rate_pct "
    f"FROM curated GROUP BY {S.score_col} HAVING COUNT(*) >= {GROUP_MIN_N} ORDER BY {S.score_col}"))
def q_score_gradient_having(spark, sf):
    return R.score_gradient_having(curated(spark, sf), S.target, S.score_col, GROUP_MIN_N)


@register("fine_rate_having", O.with_ctes(
    f"SELECT {', '.join(FINE_KEYS)}, COUNT(*) AS n, AVG({O.T}) AS rate FROM curated "
    f"GROUP BY {', '.join(FINE_KEYS)} HAVING COUNT(*) >= {GROUP_MIN_N}"))
def q_fine_rate_having(spark, sf):
    """Groups on both sides of the limit at every scale."""
    return R.group_rate(curated(spark, sf), FINE_KEYS, S.target).filter(F.col("n") >= GROUP_MIN_N)


@register("band_sex_rate", O.with_ctes(
    f"SELECT {S.band_col}, {S.sex}, COUNT(*) AS n, AVG({O.T}) AS rate "
    f"FROM curated WHERE {S.band_col} IS NOT NULL AND {S.sex} IS NOT NULL GROUP BY {S.band_col}, {S.sex}"))
def q_band_sex_rate(spark, sf):
    return R.group_rate(curated(spark, sf), [S.band_col, S.sex], S.target)


@register("project", O.with_ctes(f"SELECT {S.id_col}, {O.T}, {S.measure}, {S.age}, {S.score_col} FROM clean"))
def q_project(spark, sf):
    return clean(spark, sf).select(S.id_col, S.target, S.measure, S.age, S.score_col)


@register("clean", O.with_ctes("SELECT * FROM clean"))
def q_clean(spark, sf):
    return clean(spark, sf)


@register("health_score", O.with_ctes(f"SELECT {S.id_col}, {', '.join(SCORE_PARTS)}, {S.measure}, {S.score_col} FROM clean"))
def q_health_score(spark, sf):
    return clean(spark, sf).select(S.id_col, *SCORE_PARTS, S.measure, S.score_col)


@register("age_band", O.with_ctes(f"SELECT {S.id_col}, {S.age}, {S.band_col} FROM clean"))
def q_age_band(spark, sf):
    return clean(spark, sf).select(S.id_col, S.age, S.band_col)


@register("narrow_cast", O.with_ctes("SELECT * FROM curated"))
def q_narrow_cast(spark, sf):
    return curated(spark, sf)


@register("narrow_rejects", O.with_ctes(
    O.union_from_row("w", [([c], [f"x{i}"]) for i, c in enumerate(O.ALL)], ["variable", "rejected"]),
    "\nw AS (SELECT " + ", ".join(
        f"COUNT(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST(trunc({c}) AS SMALLINT) IS NULL) AS x{i}"
        for i, c in enumerate(O.ALL)) + " FROM raw)"))
def q_narrow_rejects(spark, sf):
    return C.reject_count(raw(spark, sf), S.columns)


@register("class_weight", O.with_ctes(
    f"SELECT {S.id_col}, {O.T}, CASE WHEN {O.T} = 1 THEN (1.0 - p) / p ELSE 1.0 END AS {S.weight_col} "
    f"FROM curated, (SELECT AVG({O.T}) AS p FROM curated) g"))
def q_class_weight(spark, sf):
    from ..functions.columns import class_weight
    df = curated(spark, sf)
    p = R.prevalence(df, S.target)
    return df.select(S.id_col, S.target, class_weight(S.target, p).alias(S.weight_col))


@register("outlier_count", O.with_ctes(
    f"SELECT COUNT(*) FILTER (WHERE {S.measure} > {S.measure_range[1]}) AS outliers, COUNT(*) AS rows FROM raw"))
def q_outlier_count(spark, sf):
    return P.outlier_count(raw(spark, sf), S.measure, S.measure_range[1])


@register("zero_share", O.zero_share_sql(ZERO_SHARE_COLS))
def q_zero_share(spark, sf):
    return P.zero_share(raw(spark, sf), ZERO_SHARE_COLS)


# -- profile ---------------------------------------------------------------------

@register("profile", O.with_ctes(
    f"SELECT COUNT(*) AS rows, CAST(0 AS BIGINT) + " +
    " + ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL)" for c in O.ALL) +
    f" AS nulls, CAST(SUM({O.T}) AS BIGINT) AS positives, "
    f"CAST(100 AS DOUBLE) * CAST(SUM({O.T}) AS BIGINT) / COUNT(*) AS positive_pct, "
    f"CAST({len(S.columns) + 3} AS BIGINT) AS n_columns, "
    f"COUNT(*) FILTER (WHERE {S.band_col} IS NULL) AS band_missing FROM clean"))
def q_profile(spark, sf):
    return P.profile(clean(spark, sf), S)


@register("null_counts", O.null_counts_sql())
def q_null_counts(spark, sf):
    return P.null_counts(raw(spark, sf), S.columns)


@register("describe", O.describe_sql(O.ALL))
def q_describe(spark, sf):
    return P.describe(clean(spark, sf), S.columns, coded=S.columns)       # the contract's columns are codes


@register("describe_by_target", O.describe_sql([S.measure], by=O.T))
def q_describe_by_target(spark, sf):
    return P.describe(clean(spark, sf), [S.measure], by=S.target, coded=S.columns)


@register("value_counts", O.with_ctes(
    f"SELECT {O.T}, COUNT(*) AS n FROM raw WHERE {O.T} IS NOT NULL GROUP BY {O.T} ORDER BY n DESC, {O.T}"))
def q_value_counts(spark, sf):
    return P.value_counts(raw(spark, sf), S.target)


@register("value_share", O.with_ctes(
    f"SELECT {O.T}, n, CAST(n AS DOUBLE) / SUM(n) OVER () AS share FROM "
    f"(SELECT {O.T}, COUNT(*) AS n FROM raw WHERE {O.T} IS NOT NULL GROUP BY {O.T}) c ORDER BY n DESC"))
def q_value_share(spark, sf):
    return P.value_share(raw(spark, sf), S.target)


@register("duplicate_rows", O.with_ctes(
    f"SELECT CAST(SUM(n - 1) AS BIGINT) AS duplicate_rows, COUNT(*) AS distinct_rows FROM "
    f"(SELECT COUNT(*) AS n FROM clean GROUP BY {', '.join(O.ALL)}) g"))
def q_duplicate_rows(spark, sf):
    return P.duplicate_rows(clean(spark, sf), S.columns)


@register("label_conflicts", O.with_ctes(
    f"SELECT COUNT(*) AS combinations, COUNT(*) FILTER (WHERE lo <> hi) AS conflicting FROM "
    f"(SELECT MIN({O.T}) AS lo, MAX({O.T}) AS hi FROM clean WHERE {O.T} IS NOT NULL "
    f"GROUP BY {', '.join(O.PRED)}) g"))
def q_label_conflicts(spark, sf):
    return P.label_conflicts(clean(spark, sf), S.predictors, S.target)


@register("histogram", O.histogram_sql(30))
def q_histogram(spark, sf):
    return P.histogram(clean(spark, sf), S.columns, 30)


_ORDER = [S.id_col] + list(S.columns)


@register("head_tail", O.with_ctes(
    f"(SELECT *, 'head' AS side FROM clean ORDER BY {', '.join(_ORDER)} LIMIT 5) UNION ALL "
    f"(SELECT *, 'tail' AS side FROM clean ORDER BY {', '.join(c + ' DESC' for c in _ORDER)} LIMIT 5)"))
def q_head_tail(spark, sf):
    return P.head_tail(clean(spark, sf), _ORDER, 5)


# -- rates -------------------------------------------------------------------------

@register("prevalence_by_factor", O.prevalence_sql())
def q_prevalence_by_factor(spark, sf):
    return R.prevalence_by_factor(curated(spark, sf), S.binary, S.target)


@register("rate_by_key", O.with_ctes(O.factor_counts_sql("clean", RATE_KEYS)))
def q_rate_by_key(spark, sf):
    return R.rate_by_key(clean(spark, sf), RATE_KEYS, S.target)


@register("rate_by_key_nulls", O.with_ctes(O.factor_counts_sql("raw", ["MentHlth", S.age])))
def q_rate_by_key_nulls(spark, sf):
    """Before cleaning, where a key has nulls."""
    return R.rate_by_key(raw(spark, sf), ["MentHlth", S.age], S.target)


@register("prevalence_selected", f"""SELECT * FROM ({O.prevalence_sql()}) p
WHERE variable IN (SELECT variable FROM ({O.feature_rank_sql(10)}) f WHERE selected)""")
def q_prevalence_selected(spark, sf):
    """Prevalence of the selected features that are binary."""
    chosen = SEL.selected_list(SEL.select_features(clean(spark, sf), S.predictors, S.target, 10))
    return R.prevalence_by_factor(curated(spark, sf), R.binary_only(chosen, S.binary), S.target)


@register("prevalence_report", f"""SELECT variable, value, n, cases, round(rate * 100, 2) AS rate_pct
FROM ({O.prevalence_sql()}) p""")
def q_prevalence_report(spark, sf):
    return R.rounded_report(R.prevalence_by_factor(curated(spark, sf), S.binary, S.target))


@register("factor_gap", O.factor_gap_sql(12))
def q_factor_gap(spark, sf):
    return R.factor_gap(R.prevalence_by_factor(curated(spark, sf), S.binary, S.target), 12)


@register("union_all", O.with_ctes(
    f"SELECT 'age_band' AS variable, {S.band_col} AS value, COUNT(*) AS n, AVG({O.T}) AS rate "
    f"FROM curated GROUP BY {S.band_col} UNION ALL "
    f"SELECT 'Sex' AS variable, CAST({S.sex} AS VARCHAR) AS value, COUNT(*) AS n, AVG({O.T}) AS rate "
    f"FROM curated GROUP BY {S.sex}"))
def q_union_all(spark, sf):
    cur = curated(spark, sf)
    by_band = (R.group_rate(cur, [S.band_col], S.target)
               .select(F.lit("age_band").alias("variable"), F.col(S.band_col).alias("value"), "n", "rate"))
    by_sex = (R.group_rate(cur, [S.sex], S.target)
              .select(F.lit("Sex").alias("variable"), F.col(S.sex).cast("string").alias("value"), "n", "rate"))
    return by_band.unionByName(by_sex)


@register("dedup", O.with_ctes(f"SELECT DISTINCT {O.T}, {', '.join(SCORE_PARTS)} FROM curated"))
def q_dedup(spark, sf):
    return curated(spark, sf).select(S.target, *SCORE_PARTS).dropDuplicates()


# -- selection -----------------------------------------------------------------------

@register("corr_target", O.corr_target_sql())
def q_corr_target(spark, sf):
    return SEL.corr_target(clean(spark, sf), S.predictors, S.target)


@register("corr_target_nulls", O.corr_nulls_sql())
def q_corr_target_nulls(spark, sf):
    """Before cleaning, where predictors have nulls: pair by pair."""
    return SEL.corr_target(raw(spark, sf), S.predictors, S.target)


@register("feature_selection", O.feature_rank_sql(10))
def q_feature_selection(spark, sf):
    return (SEL.select_features(clean(spark, sf), S.predictors, S.target, 10)
            .withColumn("rank", F.col("rank").cast("bigint")))


@register("corr_matrix", O.corr_matrix_sql())
def q_corr_matrix(spark, sf):
    return SEL.corr_matrix(clean(spark, sf), S.columns)


@register("selection_roundtrip", O.feature_rank_sql(10))
def q_selection_roundtrip(spark, sf):
    """The ranked selection written as a CSV side table and read back (S6, S7)."""
    path = work_path(spark, "selection")
    IO.write_selection(SEL.select_features(clean(spark, sf), S.predictors, S.target, 10), path)
    return IO.read_selection(spark, path)


# -- splits and joins -------------------------------------------------------------------

@register("split_anti", O.with_ctes(f"SELECT * FROM curated WHERE NOT ({SPLIT_BUCKET_SQL} < 80)"))
def q_split_anti(spark, sf):
    """The held-out side as the complement of the sample (left anti join)."""
    cur = curated(spark, sf)
    train, _ = SP.hash_split(cur, [], 0.8, bucket=F.expr(SPLIT_BUCKET_SQL), buckets=100)
    return SP.complement(cur, train, S.id_col)


@register("split_hash", O.with_ctes(
    f"SELECT *, CASE WHEN {SPLIT_BUCKET_SQL} < 80 THEN 'train' ELSE 'test' END AS side FROM curated"))
def q_split_hash(spark, sf):
    """The scale form: one pass, a predicate per side, no join."""
    cur = curated(spark, sf)
    train, test = SP.hash_split(cur, [], 0.8, bucket=F.expr(SPLIT_BUCKET_SQL), buckets=100)
    return (train.withColumn("side", F.lit("train"))
                 .unionByName(test.withColumn("side", F.lit("test"))))


@register("join_target", """SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, o.o_orderpriority,
       c.c_acctbal, CAST(c.c_mktsegment = 'BUILDING' AS INTEGER) AS label
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def q_join_target(spark, sf):
    """Features and target from two tables, joined on an explicit id.

    No broadcast hint: AQE converts to a broadcast join when the measured
    side is under ``autoBroadcastJoinThreshold`` and otherwise keeps the
    sort-merge join (skew-split by AQE)."""
    orders = analog.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    cust = analog.table(spark, sf, "customer").select(
        F.col("c_custkey"), "c_acctbal", (F.col("c_mktsegment") == "BUILDING").cast("int").alias("label"))
    return orders.join(cust, orders.o_custkey == cust.c_custkey, "inner").drop("c_custkey")


# -- sources and sinks ---------------------------------------------------------------------

def _write_raw_csv(spark, sf) -> str:
    path = work_path(spark, "raw_csv")
    IO.write_csv(analog.raw_analog(spark, sf, with_id=False), path)
    return path


@register("scan_csv", O.RAW_NO_ID)
def q_scan_csv(spark, sf):
    """Raw analog written as CSV, read back under the contract."""
    return IO.scan_csv(spark, _write_raw_csv(spark, sf), S)


@register("schema_contract", "SELECT COUNT(*) AS rows, CAST(0 AS BIGINT) AS corrupt, true AS header_ok FROM lineitem")
def q_schema_contract(spark, sf):
    path = _write_raw_csv(spark, sf)
    ok = not IO.header_report(IO.csv_headers(spark, path), S)
    return (IO.scan_csv(spark, path, S, corrupt_col="_corrupt")
            .select(S.target, "_corrupt")                # the reader gives the raw text only beside a column
            .agg(F.sum(F.lit(1).cast("long") + F.col(S.target).cast("long") * 0).alias("rows"),
                 F.count("_corrupt").alias("corrupt")).withColumn("header_ok", F.lit(ok)))


@register("curated_roundtrip", O.with_ctes("SELECT * FROM curated"))
def q_curated_roundtrip(spark, sf):
    return IO.scan_parquet(spark, write_curated(spark, sf))


@register("scan_parquet", O.with_ctes(f"SELECT {O.T}, {S.measure}, {S.band_col} FROM curated"))
def q_scan_parquet(spark, sf):
    return IO.scan_parquet(spark, write_curated(spark, sf), S.curated_schema).select(S.target, S.measure, S.band_col)


@register("partition_pruned", O.with_ctes(f"SELECT * FROM curated WHERE {S.band_col} = '{S.age_labels[-1]}'"))
def q_partition_pruned(spark, sf):
    from ..operators.quality import assert_partition_pruned
    df = IO.scan_parquet(spark, write_curated(spark, sf)).filter(F.col(S.band_col) == S.age_labels[-1])
    assert_partition_pruned(df, S.band_col)
    return df


@register("reconcile", O.with_ctes(
    "SELECT 'curated' AS dataset, COUNT(*) AS expected, COUNT(*) AS actual, true AS ok FROM curated"))
def q_reconcile(spark, sf):
    from ..operators.quality import assert_reconciled, reconcile
    path, mpath = work_path(spark, "curated"), work_path(spark, "manifest")
    # the producer counts in the write job, the consumer in the files' footers
    rows = IO.write_counted(curated(counting_session(spark), sf), path, S.band_col)
    IO.write_manifest(spark, mpath, "curated", rows, S.curated_schema)
    actual = spark.createDataFrame([("curated", IO.stored_rows(spark, path))], "dataset string, rows bigint")
    report = reconcile(IO.read_manifest(spark, mpath), actual)
    assert_reconciled(report)
    return report


@register("prevalence_roundtrip", O.prevalence_sql())
def q_prevalence_roundtrip(spark, sf):
    path = work_path(spark, "prevalence")
    IO.write_parquet(R.prevalence_by_factor(curated(spark, sf), S.binary, S.target), path)
    return IO.scan_parquet(spark, path)


@register("report_guard", ORACLE["score_gradient"])
def q_report_guard(spark, sf):
    from ..operators.quality import report_guard
    return report_guard(R.score_gradient(clean(spark, sf), S.target, S.score_col))
