import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import profile as P
from cohortlens.operators import rates as R
from cohortlens.operators import select as SEL
from cohortlens.operators.model import ModelError, with_class_weight


def test_constant_column_corr_null_and_ranked_last(spark):
    df = spark.createDataFrame([(float(i % 2), float(i), 5.0, float(i)) for i in range(20)], "y double, a double, c double, b double")
    corr = SEL.corr_target(df, ["a", "c", "b"], "y")
    ranked = {r.variable: r for r in SEL.rank_features(corr, top_n=2).collect()}
    assert ranked["c"].correlation is None and ranked["c"].rank == 3 and not ranked["c"].selected
    # equal |correlation|: broken by name
    assert ranked["a"].rank == 1 and ranked["b"].rank == 2


def test_corr_matrix_constant_is_null(spark):
    df = spark.createDataFrame([(float(i), 1.0, float(-i)) for i in range(10)], "a double, k double, b double")
    m = {(r.var_a, r.var_b): r.r for r in SEL.corr_matrix(df, ["a", "k", "b"]).collect()}
    assert m[("a", "k")] is None and m[("a", "b")] == -1.0


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0, 7.0), (0.5, 7.0), (30.0, 7.0), (29.99, 7.0)], "x double, k double")
    h = {(r.variable, r.bin): r.n for r in P.histogram(df, ["x", "k"], 30).collect()}
    assert h[("x", 1)] == 2 and h[("x", 30)] == 2
    assert h[("k", 1)] == 4 and len(h) == 60             # empty bins are rows too
    assert sum(v for (var, _), v in h.items() if var == "k") == 4
    assert sum(v for (var, _), v in h.items() if var == "x") == 4


def test_describe_matches_pandas(spark):
    vals = [1.0, 2.0, 2.0, 3.0, 7.0, 7.0, 9.0, 10.0, 4.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    d = P.describe(df, ["x"]).collect()[0]
    s = pd.Series(vals).describe()
    assert d["count"] == s["count"] and d["mean"] == pytest.approx(s["mean"])
    assert d["std"] == pytest.approx(s["std"], abs=1e-8)
    for tag, key in (("q25", "25%"), ("q50", "50%"), ("q75", "75%")):
        assert d[tag] == pytest.approx(s[key])
    assert d["min"] == 1.0 and d["max"] == 10.0


def test_duplicates_and_conflicts(spark):
    df = spark.createDataFrame([(1, 0, 0), (1, 0, 0), (1, 0, 0), (2, 0, 0), (2, 0, 1), (3, 1, 1)], "a int, b int, y int")
    assert P.duplicate_rows(df, ["a", "b", "y"]).collect()[0].duplicate_rows == 2
    lc = P.label_conflicts(df, ["a", "b"], "y").collect()[0]
    assert (lc.combinations, lc.conflicting) == (3, 1)


def test_value_share_sums_to_one(spark):
    df = spark.createDataFrame([(x,) for x in [1, 1, 2, 3, 3, 3, None]], "v int")
    rows = P.value_share(df, "v").collect()
    assert sum(r.share for r in rows) == pytest.approx(1.0) and rows[0].v == 3


def test_gradient_having_threshold(spark):
    rows = [(0, 1)] * 99 + [(1, 0)] * 100
    df = spark.createDataFrame(rows, "score int, y int")
    got = R.score_gradient_having(df, "y", "score", 100).collect()
    assert [(r.score, r.n) for r in got] == [(1, 100)]


def test_prevalence_totals_and_gap(spark):
    rows = [(i % 2, 1, (i // 2) % 2, int(i % 3 == 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "a int, always int, b int, y int")
    prev = R.prevalence_by_factor(df, ["a", "always", "b"], "y")
    per_var = {r.variable: r.n for r in prev.groupBy("variable").agg(F.sum("n").alias("n")).collect()}
    assert per_var == {"a": 60, "always": 60, "b": 60}
    gap = {r.variable for r in R.factor_gap(prev).collect()}
    assert "always" not in gap and gap == {"a", "b"}
    plan = prev._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_class_weight_requires_both_classes(spark):
    df = spark.createDataFrame([(0,), (0,)], "y int")
    with pytest.raises(ModelError):
        with_class_weight(df, "y", "w", 0.0)
    w = with_class_weight(spark.createDataFrame([(0,), (1,), (0,), (0,)], "y int"), "y", "w", 0.25)
    assert [r.w for r in w.collect()] == [1.0, 3.0, 1.0, 1.0]


def test_null_band_counted_and_dropped_from_groups(spark):
    from cohortlens.operators import clean as C
    from cohortlens.spec import HEART
    from fixtures import frame, row
    df = C.derive(frame(spark, [row(Age=0.0), row(Age=14.0), row(Age=3.0)]), HEART)
    assert P.profile(df, HEART).collect()[0].band_missing == 2
    groups = R.group_rate(df, [HEART.band_col], HEART.target).collect()
    assert [(g.age_band, g.n) for g in groups] == [("1_18a39", 1)]
    assert len(R.group_rate(df, [HEART.band_col], HEART.target, drop_null_keys=False).collect()) == 2
