import os

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import clean as C
from cohortlens.operators.quality import (GuardError, assert_partition_pruned, plan_text, reconcile,
                                          report_guard)
from cohortlens.sources import files as IO
from cohortlens.spec import HEART
from fixtures import frame, row


def _write_csv(path, header, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.csv"), "w") as f:
        f.write(",".join(header) + "\n")
        for ln in lines:
            f.write(ln + "\n")


def test_contract_ok_and_nulls(spark, tmp_dir):
    line = ",".join("1" for _ in HEART.columns)
    empty = ",".join([""] + ["1"] * (len(HEART.columns) - 1))
    bad = ",".join(["x"] + ["1"] * (len(HEART.columns) - 1))
    _write_csv(tmp_dir, HEART.columns, [line, empty, bad])
    df = IO.scan_csv(spark, tmp_dir, HEART)
    assert df.columns == list(HEART.columns)
    assert df.filter(F.col(HEART.target).isNull()).count() == 2
    assert C.drop_incomplete(df, HEART.columns).count() == 1


def test_contract_renamed_column(spark, tmp_dir):
    cols = list(HEART.columns)
    cols[4] = "BodyMass"
    _write_csv(tmp_dir, cols, [",".join("1" for _ in cols)])
    with pytest.raises(IO.ContractError):
        IO.scan_csv(spark, tmp_dir, HEART)


def test_contract_swapped_columns(spark, tmp_dir):
    cols = list(HEART.columns)
    cols[1], cols[2] = cols[2], cols[1]
    _write_csv(tmp_dir, cols, [",".join("1" for _ in cols)])
    with pytest.raises(IO.ContractError):
        IO.scan_csv(spark, tmp_dir, HEART)


def test_partitioned_roundtrip_pruning_and_reconcile(spark, tmp_dir):
    rows = [row(Age=float(a)) for a in range(1, 14) for _ in range(3)]
    cur = C.curated(frame(spark, rows), HEART)
    path = os.path.join(tmp_dir, "curated")
    IO.write_partitioned(cur, path, HEART.band_col)
    back = IO.scan_parquet(spark, path)
    assert back.count() == len(rows)
    assert sorted(d for d in os.listdir(path) if "=" in d) == [f"{HEART.band_col}={b}" for b in HEART.age_labels]
    pruned = back.filter(F.col(HEART.band_col) == "4_70ymas")
    assert_partition_pruned(pruned, HEART.band_col)
    assert pruned.count() == 9
    mpath = os.path.join(tmp_dir, "manifest")
    IO.write_manifest(spark, mpath, "curated", len(rows), back.schema)
    actual = back.agg(F.count(F.lit(1)).alias("rows")).withColumn("dataset", F.lit("curated"))
    rep = reconcile(IO.read_manifest(spark, mpath), actual).collect()
    assert rep[0].ok and rep[0].expected == rep[0].actual == len(rows)


def test_projection_reaches_scan(spark, tmp_dir):
    cur = C.curated(frame(spark, [row()]), HEART)
    path = os.path.join(tmp_dir, "p")
    IO.write_partitioned(cur, path, HEART.band_col)
    text = plan_text(IO.scan_parquet(spark, path).select("BMI", "Sex"))
    schema_line = [ln for ln in text.splitlines() if "ReadSchema" in ln][0]
    assert "BMI" in schema_line and "Smoker" not in schema_line


def test_report_guard(spark):
    assert report_guard(spark.range(10)).count() == 10
    with pytest.raises(GuardError):
        report_guard(spark.range(500))
