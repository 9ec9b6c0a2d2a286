"""Registered queries against their DuckDB twins on the smallest driver tables."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF}/lineitem.parquet"), reason="driver tables absent")

BASE = [k for k in queries() if not k.startswith("op") and k != "pipeline"]
SQL = [k for k in BASE if k in oracle_sql()]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


def _key(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("lineitem", "orders", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_sql_key_is_registered():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("key", SQL)
def test_matches_duckdb(spark, duck, key):
    df = queries()[key](spark, SF)
    rows = df.collect()
    res = duck.execute(oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _key(df.columns, rows) == _key(dcols, res.fetchall())


@pytest.mark.parametrize("key", [k for k in BASE if k not in SQL])
def test_runs_as_registered(spark, key):
    df = queries()[key](spark, SF)
    assert df.count() > 0


def test_entry_runs(spark):
    out = entry(spark).collect()
    assert len(out) > 0 and sum(r.n for r in out) > 0
