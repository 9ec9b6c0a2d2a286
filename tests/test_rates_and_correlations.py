"""Nulls, non-integer keys, storage and contracts that can fail."""
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortlens import session
from cohortlens.functions.columns import safe_corr
from cohortlens.operators import profile as P
from cohortlens.operators import rates as R
from cohortlens.operators import search as GA
from cohortlens.operators import select as SEL
from cohortlens.operators import split as SP
from cohortlens.operators.quality import GuardError, assert_reconciled, reconcile
from cohortlens.sources import files as IO
from cohortlens.spec import DIABETES, HEART

ROWS = [(1.0, 2.0, 9.0), (None, 1.0, 1.0), (3.0, 5.0, 2.0), (4.0, None, 7.0), (None, 30.0, 3.0), (6.0, 5.5, None)]


def test_correlations_are_pairwise(spark):
    pdf = pd.DataFrame(ROWS, columns=["a", "b", "c"], dtype=float)
    df = spark.createDataFrame(ROWS, "a double, b double, c double")
    want = pdf.corr()
    assert df.agg(safe_corr("a", "b")).first()[0] == pytest.approx(want.loc["a", "b"])
    got = {r.variable: r.correlation for r in SEL.corr_target(df, ["b", "c"], "a", digits=9).collect()}
    assert got == pytest.approx({"b": round(want.loc["a", "b"], 9), "c": round(want.loc["a", "c"], 9)})
    for r in SEL.corr_matrix(df, ["a", "b", "c"]).collect():
        assert r.r == pytest.approx(want.loc[r.var_a, r.var_b], abs=1e-9)
    far = df.select(F.col("a"), (F.col("b") + 1e9).alias("b"))
    assert SEL.corr_target(far, ["b"], "a", 6, center={"b": 1e9}).first().correlation == round(want.loc["a", "b"], 6)
    assert [r.r for r in SEL.corr_matrix(df.filter("false"), ["a", "b"]).collect()] == [None]


def test_rate_by_key_keeps_keys_and_ignores_nulls(spark):
    df = spark.createDataFrame([(1.2, 1), (1.9, 0), (1.9, None), (None, 1), (3.0, None)], "k double, y int")
    got = {r.value: (r.n, r.cases, r.rate) for r in R.rate_by_key(df, ["k"], "y").collect()}
    assert got == {1.2: (1, 1, 1.0), 1.9: (1, 0, 0.0)}
    report = R.rounded_report(R.rate_by_key(df, ["k"], "y")).collect()
    assert [r.rate_pct for r in report] == [100.0, 0.0]


def test_reconcile_fails_on_a_lost_file(spark, tmp_dir):
    source = spark.range(100).withColumn("k", F.col("id") % 3)
    path, manifest = os.path.join(tmp_dir, "t"), os.path.join(tmp_dir, "m")
    source.repartition(4).write.parquet(path)
    IO.write_manifest(spark, manifest, "t", source.count(), source.schema)
    lost = next(f for f in sorted(os.listdir(path)) if f.endswith(".parquet"))
    kept = [os.path.join(path, f) for f in os.listdir(path) if f.endswith(".parquet") and f != lost]
    actual = spark.read.parquet(*kept).agg(F.count(F.lit(1)).alias("rows")).withColumn("dataset", F.lit("t"))
    report = reconcile(IO.read_manifest(spark, manifest), actual)
    assert not report.first().ok
    with pytest.raises(GuardError):
        assert_reconciled(report)


def test_every_header_is_checked(spark, tmp_dir):
    line = ",".join("1" for _ in HEART.columns)
    swapped = [HEART.columns[1], HEART.columns[0], *HEART.columns[2:]]
    for i, header in enumerate((HEART.columns, swapped)):
        with open(os.path.join(tmp_dir, f"part-{i}.csv"), "w") as f:
            f.write(",".join(header) + "\n" + line + "\n")
    assert len(IO.header_report(IO.csv_headers(spark, tmp_dir), HEART)) == 1
    with pytest.raises(IO.ContractError):
        IO.scan_csv(spark, tmp_dir, HEART)


def test_corrupt_rows_are_kept_for_counting(spark, tmp_dir):
    good = ",".join("1" for _ in HEART.columns)
    with open(os.path.join(tmp_dir, "part-0.csv"), "w") as f:
        f.write(",".join(HEART.columns) + "\n" + good + "\n" + good.replace("1", "x", 1) + "\n")
    df = IO.scan_csv(spark, tmp_dir, HEART, corrupt_col="_bad").cache()
    assert df.filter("_bad is not null").count() == 1 and df.count() == 2


def test_storage_needs_a_shared_folder(monkeypatch):
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(session.StorageError):
        session.checkpoint_root(Session())


def test_planning_session_leaves_the_callers_settings(spark):
    before = spark.conf.get("spark.sql.constraintPropagation.enabled", "true")
    child = session.planning_session(spark)
    assert child.conf.get("spark.sql.constraintPropagation.enabled") == "false"
    assert spark.conf.get("spark.sql.constraintPropagation.enabled", "true") == before


def test_describe_approx_is_close(spark):
    df = spark.range(1000).select((F.col("id") * 1.0).alias("x"))
    r = P.describe(df, ["x"], approx_accuracy=10000).first()
    assert abs(r.q50 - 499.5) <= 1 and r["count"] == 1000


def test_sample_split_is_complete(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(400)], "id long, y int").cache()
    train, test = SP.sample_split(df, "y", "id", 0.8)
    assert train.count() + test.count() == 400 and train.join(test, "id").isEmpty()


def test_search_without_repeats_and_run_log(spark):
    pop = spark.createDataFrame([(i, [1, 0, 1]) for i in range(4)], GA.POP_SCHEMA)
    rows = GA.fresh_copies(pop, 3, 1, 1).orderBy("cand_id").collect()
    assert rows[0].genes == [1, 0, 1] and len({tuple(r.genes) for r in rows}) > 1
    log = GA.run_log_summary(spark.createDataFrame([(1, 0.1, 0.1, 4.0), (2, 0.1, 0.1, 9.0)],
                                                   "generation int, best double, mean double, elapsed_s double")).first()
    assert log.seconds_per_generation == 3.0


def test_diabetes_contract():
    assert len(DIABETES.columns) == 22 and DIABETES.target not in DIABETES.predictors
    assert set(DIABETES.binary) <= set(DIABETES.predictors)
