"""The survey analog over the driver's ``lineitem`` table.

The driver tables hold no survey, so every checked query runs over a view in
the 22-column heart contract whose columns are derived row by row from
``lineitem``. The expressions are written once, in SQL that Spark and DuckDB
both read the same way, so the Spark plan (``selectExpr``) and the DuckDB
oracle (``ANALOG_SQL``) start from identical rows. Every lineitem row becomes
one respondent; the work grows with the table.

Roles: target <- large discounted quantity; BMI <- quantity (1-50, kept
2-48); Age code <- ship month (1-12); Sex <- order key parity; the other
flags come from returnflag, linestatus, tax, discount, line number and key
residues. ``MentHlth`` is missing for about 2 % of rows, so cleaning and
null counting have real work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..spec import ANALOG, HEART_COLUMNS

# Fixed values: (column, SQL expression over lineitem), in contract order.
ANALOG_EXPRS = (
    ("HeartDiseaseorAttack", "CASE WHEN l_quantity * (1 - l_discount) >= 42 THEN 1 ELSE 0 END"),
    ("HighBP", "CASE WHEN l_linenumber > 3 THEN 1 ELSE 0 END"),
    ("HighChol", "l_suppkey % 2"),
    ("CholCheck", "CASE WHEN l_suppkey % 25 = 0 THEN 0 ELSE 1 END"),
    ("BMI", "l_quantity"),
    ("Smoker", "CASE WHEN l_linestatus <> 'F' THEN 1 ELSE 0 END"),
    ("Stroke", "CASE WHEN l_partkey % 20 = 0 THEN 1 ELSE 0 END"),
    ("Diabetes", "l_partkey % 3"),
    ("PhysActivity", "CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END"),
    ("Fruits", "CASE WHEN l_tax < 0.04 THEN 1 ELSE 0 END"),
    ("Veggies", "CASE WHEN l_discount < 0.05 THEN 1 ELSE 0 END"),
    ("HvyAlcoholConsump", "CASE WHEN l_orderkey % 17 = 0 THEN 1 ELSE 0 END"),
    ("AnyHealthcare", "CASE WHEN l_suppkey % 10 = 0 THEN 0 ELSE 1 END"),
    ("NoDocbcCost", "CASE WHEN l_partkey % 11 = 0 THEN 1 ELSE 0 END"),
    ("GenHlth", "1 + l_partkey % 5"),
    ("MentHlth", "CASE WHEN l_partkey % 50 = 0 THEN NULL "
                 "WHEN l_orderkey % 3 = 0 THEN l_orderkey % 31 ELSE 0 END"),
    ("PhysHlth", "CASE WHEN l_suppkey % 4 = 0 THEN day(l_shipdate) - 1 ELSE 0 END"),
    ("DiffWalk", "CASE WHEN l_tax >= 0.07 THEN 1 ELSE 0 END"),
    ("Sex", "l_orderkey % 2"),
    ("Age", "month(l_shipdate)"),
    ("Education", "1 + l_suppkey % 6"),
    ("Income", "1 + l_orderkey % 8"),
)
ID_EXPR = "l_orderkey * 8 + l_linenumber"

assert tuple(n for n, _ in ANALOG_EXPRS) == HEART_COLUMNS


def analog_select_list(with_id: bool = True) -> list[str]:
    cols = [f"CAST({e} AS DOUBLE) AS {n}" for n, e in ANALOG_EXPRS]
    if with_id:
        cols.insert(0, f"CAST({ID_EXPR} AS BIGINT) AS {ANALOG.id_col}")
    return cols


# The same view for DuckDB (``lineitem`` is a registered view there).
ANALOG_SQL = "SELECT " + ",\n       ".join(analog_select_list()) + "\nFROM lineitem"
ANALOG_SQL_NO_ID = "SELECT " + ",\n       ".join(analog_select_list(False)) + "\nFROM lineitem"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_analog(spark: SparkSession, sf_dir: str, with_id: bool = True) -> DataFrame:
    """The raw survey analog: contract columns as double (plus an id)."""
    return table(spark, sf_dir, "lineitem").selectExpr(*analog_select_list(with_id))
