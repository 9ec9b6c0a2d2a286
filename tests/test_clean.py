import math

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import clean as C
from cohortlens.spec import HEART
from fixtures import frame, row


def test_drop_null_nan_and_range(spark):
    rows = [row(BMI=11.99), row(BMI=12.0), row(BMI=60.0), row(BMI=60.01),
            row(MentHlth=None), row(Income=math.nan), row(BMI=math.nan)]
    out = C.clean_and_derive(frame(spark, rows), HEART).select("BMI").collect()
    assert sorted(r.BMI for r in out) == [12.0, 60.0]


def test_health_score_components(spark):
    cases = [
        (row(), 7),
        (row(HighBP=1.0, HighChol=1.0, BMI=31.0, Smoker=1.0, Diabetes=2.0, PhysActivity=0.0,
             Fruits=0.0, Veggies=0.0), 0),
        (row(BMI=24.99), 7), (row(BMI=25.0), 6),
        (row(Fruits=1.0, Veggies=0.0), 6), (row(Fruits=0.0, Veggies=1.0), 6), (row(Fruits=1.0, Veggies=1.0), 7),
        (row(Diabetes=0.0), 7), (row(Diabetes=1.0), 6), (row(Diabetes=2.0), 6),
    ]
    df = frame(spark, [r for r, _ in cases])
    got = [r.health_score for r in C.derive(df, HEART).select(HEART.score_col).collect()]
    assert got == [s for _, s in cases]


def test_age_band_right_closed(spark):
    codes = [0, 1, 4, 5, 7, 8, 10, 11, 13, 14]
    want = [None, "1_18a39", "1_18a39", "2_40a54", "2_40a54", "3_55a69", "3_55a69", "4_70ymas", "4_70ymas", None]
    df = frame(spark, [row(Age=float(a)) for a in codes])
    got = [r.age_band for r in C.derive(df, HEART).select(HEART.band_col).collect()]
    assert got == want


def test_narrow_cast_truncates_and_counts_rejects(spark):
    df = spark.createDataFrame([(3.9,), (40000.0,), (-2.7,), (None,)], "x double")
    got = [r.x for r in C.narrow(df).collect()]
    assert got == [3, None, -2, None]
    rej = C.reject_count(df, ["x"]).collect()
    assert rej[0].rejected == 1


def test_curated_types(spark):
    cur = C.curated(frame(spark, [row()]), HEART)
    types = dict(cur.dtypes)
    assert types["BMI"] == "smallint" and types[HEART.score_col] == "smallint"
    assert types[HEART.band_col] == "string"


def test_drop_incomplete_subset(spark):
    df = spark.createDataFrame([(1.0, None), (None, 2.0), (3.0, 4.0)], "a double, b double")
    assert C.drop_incomplete(df, ["a"]).count() == 2
    assert C.drop_incomplete(df).count() == 1


@pytest.mark.parametrize("lo,hi,n", [(12, 60, 2), (0, 100, 3)])
def test_keep_range(spark, lo, hi, n):
    df = spark.createDataFrame([(11.0,), (12.0,), (60.0,)], "BMI double")
    kept = C.keep_range(df, "BMI", lo, hi)
    assert kept.count() == n
    assert kept.filter((F.col("BMI") < lo) | (F.col("BMI") > hi)).count() == 0
