"""Operators that are exact at any size: positions, quantiles, histograms, correlations, ranking, search trees."""
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import candidate_trees as CT
from cohortlens.operators import digest as DG
from cohortlens.operators import model as M
from cohortlens.operators import profile as P
from cohortlens.operators import quantiles as Q
from cohortlens.operators import rank as RK
from cohortlens.operators import search as GA
from cohortlens.operators import select as SEL
from cohortlens.operators import split as SP
from cohortlens.operators.quality import plan_text
from cohortlens.operators.ranking import ranking_metrics


def hot_rows(n=900, seed=1):
    """A third of the rows alike, nulls, and other repeats."""
    rng = random.Random(seed)
    rows = [(None if rng.random() < 0.1 else rng.randrange(40), rng.choice(["x", "y", None]), rng.randrange(2))
            for _ in range(2 * n // 3)]
    return rows + [(7, "x", 1)] * (n // 3)


# ---------------------------------------------------------------- positions

def test_global_rank_is_a_numbering_in_order(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "a int, b string, y int").repartition(5)
    got = sorted(RK.global_rank(df, ["a", "b"], ranges=6).collect(), key=lambda r: r["rank"])
    assert [r["rank"] for r in got] == list(range(len(rows)))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")
    assert [key(r) for r in got] == sorted(map(key, rows))


def test_equal_rows_spread_over_ranges(spark):
    df = spark.range(3000).select(F.lit(1).alias("a"))
    files = RK._ordered(df, [F.col("a")], 6, "t").groupBy("_file").count().collect()
    assert len(files) == 6 and max(r["count"] for r in files) < 1500


def test_rows_of_a_wide_group_do_not_meet_by_group(spark):
    rows = [(i % 2, i % 7) for i in range(400)]
    ranked = RK.rank_within(spark.createDataFrame(rows, "y int, a int"), ["y"], ["a"], ranges=8)
    for y in (0, 1):
        assert sorted(r["rank"] for r in ranked.filter(F.col("y") == y).collect()) == list(range(200))
    plan = plan_text(ranked)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    mixed = [(None if i < 200 else 1000 + i // 3, i) for i in range(320)]        # one wide group, many of three rows
    got = defaultdict(list)
    for r in RK.rank_within(spark.createDataFrame(mixed, "k int, a int"), ["k"], ["a"], ranges=8).collect():
        got[r.k].append((r.a, r["rank"]))
    assert len(got) == len({k for k, _ in mixed})
    assert all([n for _, n in sorted(x)] == list(range(len(x))) for x in got.values())


def test_rank_within_starts_anew(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "a int, b string, y int")
    found = defaultdict(list)
    for r in RK.rank_within(df, ["b"], ["a"], ranges=5).collect():
        found[r.b].append((r["rank"], r.a))
    for b, got in found.items():
        got.sort()
        assert [r for r, _ in got] == list(range(sum(x[1] == b for x in rows)))
        values = [(a is not None, a or 0) for _, a in got]
        assert values == sorted(values)


def test_row_ids_are_unique_and_count_copies(spark):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "a int, b string, y int")
    got = RK.row_ids(df, ranges=4).collect()
    assert len({r.row_id for r in got}) == len(rows)
    assert Counter((r.a, r.b, r.y, r.row_id_copy) for r in got) == Counter(
        (*row, i) for row, n in Counter(rows).items() for i in range(n))
    again = {r.row_id for r in RK.row_ids(df.repartition(7), ranges=9).collect()}
    assert again == {r.row_id for r in got}
    assert RK.row_ids(df.limit(0)).count() == 0


def test_folds_of_every_class_differ_by_one_at_most(spark):
    df = spark.createDataFrame(hot_rows(1000), "a int, b string, y int")
    counts = SP.stratified_folds(df, "y", 3).groupBy("y", "fold").count().collect()
    for y in (0, 1):
        sizes = [r["count"] for r in counts if r.y == y]
        assert len(sizes) == 3 and max(sizes) - min(sizes) <= 1
    assert sum(r["count"] for r in counts) == df.count()


def test_prefix_sums(spark):
    rows = [(i, i % 7) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, v int").repartition(6)
    total, want = 0, {}
    for a, v in rows:
        total += v
        want[a] = total
    assert {r.a: r.s for r in RK.prefix_sums(df, ["a"], {"s": "v"}, ranges=7).collect()} == want


def test_groups_by_digest_are_exact_even_where_digests_clash(spark, monkeypatch):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "a int, b string, y int")
    want = Counter(rows)
    seen = defaultdict(set)
    for a, b, y in rows:
        seen[a, b].add(y)
    for clash in (False, True):
        if clash:                                         # three digests for all rows
            monkeypatch.setattr(DG, "digest", lambda columns: [F.pmod(F.hash(*columns), F.lit(3)), F.lit(0)])
        got = DG.duplicate_rows(df, ["a", "b", "y"]).first()
        assert (got.duplicate_rows, got.distinct_rows) == (len(rows) - len(want), len(want))
        got = DG.label_conflicts(df, ["a", "b"], "y").first()
        assert (got.combinations, got.conflicting) == (len(seen), sum(len(v) > 1 for v in seen.values()))
    empty = DG.duplicate_rows(df.limit(0), ["a", "b"]).first()
    assert (empty.duplicate_rows, empty.distinct_rows) == (0, 0)


# ---------------------------------------------------------------- quantiles and histograms

def quantile(values, p):
    values = sorted(values)
    h = (len(values) - 1) * p
    lo, hi = values[math.floor(h)], values[math.ceil(h)]
    return lo + (h - math.floor(h)) * (hi - lo)


@pytest.mark.parametrize("shape", ["uniform", "steep", "ties", "two", "one"])
def test_quantiles_by_many_rounds(spark, shape):
    rng = random.Random(3)
    make = {"uniform": rng.random, "steep": lambda: math.exp(60 * rng.random() - 30) * rng.choice([-1, 1]),
            "ties": lambda: rng.choice([0.5, 0.5, 0.5, rng.random()]), "two": lambda: float(rng.randrange(2)), "one": lambda: 4.25}
    rows = [(g, make[shape]()) for g in ("a", "b", None) for _ in range(400 if g else 7)]
    df = spark.createDataFrame(rows + [("a", None), ("a", float("nan")), ("empty", None)], "g string, x double")
    got = Q.exact_quantiles(Q.long_values(df, ["x"], ["g"]), [0.0, 0.25, 0.5, 0.9, 1.0], ["g"], grid=8, leaf=10, accuracy=200)
    found = {(r.g, r.p): r.quantile for r in got.collect()}
    assert set(found) == {(g, p) for g in ("a", "b", None) for p in (0.0, 0.25, 0.5, 0.9, 1.0)}
    for (g, p), v in found.items():
        assert v == quantile([x for h, x in rows if h == g], p)


def test_quartiles_of_a_million_doubles(spark):
    df = spark.range(1_000_000, numPartitions=8).select(
        (F.xxhash64("id") / F.lit(2.0 ** 40)).alias("x"), (F.col("id") % 5).cast("double").alias("coded"))
    row = {r.variable: r for r in P.describe(df, ["x", "coded"]).collect()}
    values = np.sort(np.array(df.select("x").toPandas()["x"]))
    for name, p in P.QUARTILES:
        assert row["x"][name] == pytest.approx(np.quantile(values, p), abs=1e-9)
    assert row["coded"].q50 == 2.0 and row["x"]["count"] == 1_000_000


def test_histogram_counts_bins_before_the_shuffle(spark):
    rng = random.Random(8)
    xs = [rng.random() * 10 for _ in range(500)] + [None, float("nan")]
    df = spark.createDataFrame([(x, 3.0, None) for x in xs], "x double, flat double, none double")
    got = {(r.variable, r.bin): r.n for r in P.histogram(df, ["x", "flat", "none"], 7).collect()}
    kept = [x for x in xs if x is not None and x == x]
    want, _ = np.histogram(kept, 7)
    assert [got["x", b] for b in range(1, 8)] == want.tolist()
    assert got["flat", 1] == len(xs) and sum(got["flat", b] for b in range(2, 8)) == 0
    assert not any(v == "none" for v, _ in got)
    text = plan_text(P.histogram(df, ["x"], 7))
    assert "partial_count" in text


# ---------------------------------------------------------------- correlations

def test_correlations_far_from_zero(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(2000):
        u, v = rng.random(), rng.random()
        rows.append((1e8 + u, None if rng.random() < 0.2 else -1e8 + u + v, 1e8 + 0.1, u, 0.3))
    df = spark.createDataFrame(rows, "far double, gaps double, flat double, y double, third double")
    got = {r.variable: r.correlation for r in SEL.corr_target(df, ["far", "gaps", "flat", "third"], "y", digits=12).collect()}
    engine = df.select(F.corr("far", "y"), F.corr("gaps", "y")).first()
    assert got["far"] == pytest.approx(engine[0], abs=1e-8) and got["gaps"] == pytest.approx(engine[1], abs=1e-8)

    def exact(a, b):
        pairs = [(r[a], r[b]) for r in rows if r[a] is not None and r[b] is not None]
        return np.corrcoef(*(np.array(v) - v[0] for v in zip(*pairs, strict=True)))[0, 1]

    assert got["far"] == pytest.approx(exact(0, 3), abs=1e-11) and got["gaps"] == pytest.approx(exact(1, 3), abs=1e-11)
    assert got["flat"] is None and got["third"] is None
    matrix = {(r.var_a, r.var_b): r.r for r in SEL.corr_matrix(df, ["far", "gaps", "flat", "y"], digits=12).collect()}
    assert matrix["far", "y"] == pytest.approx(exact(0, 3), abs=1e-11)
    assert matrix["far", "gaps"] == pytest.approx(exact(0, 1), abs=1e-11)
    assert matrix["far", "flat"] is None and matrix["flat", "y"] is None


# ---------------------------------------------------------------- ranking

def test_ranking_areas_against_every_cut(spark):
    rng = random.Random(5)
    rows = [(float(rng.randrange(25)), int(rng.random() < 0.3)) for _ in range(400)] + [(3.0, 1)] * 200
    df = spark.createDataFrame(rows + [(None, 1), (float("nan"), 0), (1.0, None)], "s double, y int")
    got = ranking_metrics(df, "s", "y", ranges=5).first()
    cuts = [(sum(y for s, y in rows if s >= c), sum(s >= c for s, _ in rows)) for c in sorted({s for s, _ in rows}, reverse=True)]
    positives, n = cuts[-1]
    points = [(0.0, cuts[0][0] / cuts[0][1])] + [(h / positives, h / c) for h, c in cuts]
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(points, points[1:], strict=False))
    steps = sum((b[0] - a[0]) * b[1] for a, b in zip(points, points[1:], strict=False))
    roc = [(0.0, 0.0)] + [((c - h) / (n - positives), h / positives) for h, c in cuts]
    assert (got.rows, got.positives) == (n, positives)
    assert got.auc_pr == pytest.approx(area) and got.average_precision == pytest.approx(steps)
    assert got.auc_roc == pytest.approx(sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(roc, roc[1:], strict=False)))
    from pyspark.ml.evaluation import BinaryClassificationEvaluator as E
    clean = spark.createDataFrame(rows, "s double, y int").withColumn("y", F.col("y").cast("double"))
    assert got.auc_pr == pytest.approx(E(rawPredictionCol="s", labelCol="y", metricName="areaUnderPR").evaluate(clean))
    one = ranking_metrics(df.filter("y = 1"), "s", "y").first()
    assert one.auc_roc is None and one.auc_pr == pytest.approx(1.0)


def test_naive_bayes_parameters(spark):
    from pyspark.ml.classification import NaiveBayes
    rng = random.Random(6)
    rows = [(rng.random() * 3, float(rng.randrange(4)), float(rng.random() < 0.4)) for _ in range(300)]
    df = M.assembled(spark.createDataFrame(rows, "a double, b double, y double"), ["a", "b"], "y")
    fitted = NaiveBayes(modelType="gaussian", labelCol="y", featuresCol=M.FEATURES).fit(df)
    got = {(r.label, r.feature): r for r in M.naive_bayes_parameters(fitted, ["a", "b"], spark).collect()}
    largest = max(np.var([r[0] for r in rows]), np.var([r[1] for r in rows]))
    for label in (0, 1):
        mine = np.array([r[:2] for r in rows if r[2] == label])
        for i, f in enumerate("ab"):
            assert got[label, f].mean == pytest.approx(mine[:, i].mean())
            assert got[label, f].variance == pytest.approx(mine[:, i].var() + 1e-9 * largest)
        assert got[label, "a"].log_prior == pytest.approx(math.log(len(mine) / len(rows)))


# ---------------------------------------------------------------- the search's trees

def survey(spark, n=1500, seed=4):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        a, b, c, d = rng.randrange(5), rng.randrange(3), rng.randrange(12), rng.random()
        y = int(a + 2 * (b == 1) + (c > 7) + 2 * d + rng.random() * 2 > 5.2)
        rows.append((float(a), float(b), float(c), d, y))
    return spark.createDataFrame(rows + rows[:300], "a double, b double, c double, d double, y int")


@pytest.mark.parametrize("depth", [1, 3, 5])
def test_trees_grown_together_equal_spark_ml(spark, depth):
    df = survey(spark).withColumn("d", F.floor(F.col("d") * 9).cast("double"))          # few values, so that every cut is exact
    predictors = ["a", "b", "c", "d"]
    cfg = GA.SearchConfig(folds=3, max_depth=depth, parallelism=4, fold_method="hash")
    masks = [[1, 1, 1, 1], [1, 0, 0, 1], [0, 1, 1, 0], [0, 0, 0, 1], [0, 0, 0, 0], [1, 1, 1, 0]]
    data = GA.FitnessData(df, predictors, "y", 3, 42, fold_method="hash")
    try:
        want = GA.fitness(data, masks, cfg)
    finally:
        data.release()
    trees = CT.CandidateTrees(df, predictors, "y", 3, depth, 42, "hash")
    assert trees(masks) == pytest.approx(want, abs=1e-12)
    assert trees(masks)[4] == 0.0


def test_trees_use_continuous_predictors_and_remember(spark):
    df = survey(spark)
    trees = CT.CandidateTrees(df, ["a", "b", "c", "d"], "y", 3, 4, 42, max_bins=16)
    assert len(trees.edges[3]) <= 15 and trees.edges[0] == [0.0, 1.0, 2.0, 3.0]
    with_d, without = trees([[1, 1, 1, 1], [1, 1, 1, 0]])
    assert with_d > without > 0.3
    known = dict(trees.scores)
    assert trees([[1, 1, 1, 0], [1, 1, 1, 1]]) == [without, with_d] and trees.scores == known
    with pytest.raises(ValueError):
        CT.CandidateTrees(df.filter("y = 1"), ["a"], "y")


def test_search_by_trees_does_not_depend_on_layout(spark):
    df = survey(spark, 600)
    cfg = GA.SearchConfig(generations=2, size=8, keep=4, folds=2, max_depth=3)
    a = GA.search(df, ["a", "b", "c", "d"], "y", cfg)[1].select("generation", "best", "mean").collect()
    b = GA.search(df.repartition(9), ["a", "b", "c", "d"], "y", cfg)[1].select("generation", "best", "mean").collect()
    assert len(a) == len(b) == 2 and all(x.best > 0 for x in a)


def test_merit_and_speed_up(spark):
    df = survey(spark, 400)
    score = GA.MeritScorer(df, ["a", "b", "c"], "y")
    assert score([[0, 0, 0]]) == [0.0] and score([[1, 0, 0]]) == [float(score.relevance[0])]
    assert score([[1, 1, 0]])[0] == (2 * sum(score.relevance[:2]) - score.redundancy[0, 1]) / 2
    logs = spark.createDataFrame([("slow", 1, 4.0), ("slow", 2, 9.0), ("fast", 1, 1.0), ("fast", 2, 1.5)],
                                 "run string, generation int, elapsed_s double")
    row = GA.speed_up(logs, "slow", "fast").first()
    assert (row.first_s, row.second_s, row.speed_up) == (3.0, 0.5, 6.0)


def test_search_counts_one_side_of_a_split_in_packs(spark, monkeypatch):
    """Of two sides one is counted, the other derived; a row adds one count a pack, not one a predictor."""
    counted, real = [], CT._count_nodes
    monkeypatch.setattr(CT, "_count_nodes", lambda paths, wanted, layout: counted.extend(paths) or real(paths, wanted, layout))
    trees = CT.CandidateTrees(survey(spark), ["a", "b", "c", "d"], "y", 2, 4, 42, max_bins=16)
    trees([[1, 1, 1, 1], [1, 0, 1, 0]])
    assert () in counted and len(counted) > 3
    assert not [p for p in counted if p and (*p[:-1], (*p[-1][:2], 1 - p[-1][2])) in counted]
    assert len(trees.layout.packs) < 4 and sum(map(len, trees.layout.packs)) == 4


def test_packed_codes_read_back(spark):
    for sizes in ([5, 3, 12, 7], [300, 2, 2, 40], [47, 31, 31, 12, 8, 6, 5, 3] + [2] * 60):
        layout = CT.Layout(sizes, 3)
        rng = np.random.default_rng(1)
        codes = np.stack([rng.integers(0, s, 50) for s in sizes], axis=1)
        df = spark.createDataFrame([tuple(map(int, r)) for r in codes], ", ".join(f"c{i} int" for i in range(len(sizes))))
        rows = df.select(*layout.columns(lambda p: F.col(f"c{p}")), *df.columns).collect()
        for p, g in layout.pack_of.items():
            joint = np.array([r[layout.word[g]] for r in rows]) // layout.place[g] % layout.joint[g]
            assert layout.code(p, joint).tolist() == [r[layout.words + p] for r in rows]


def test_a_task_sorts_a_bounded_range_without_copies_of_columns(spark, monkeypatch):
    """Ranges of a sort hold at most half a million rows, and named order columns are not carried twice."""
    assert RK.ROWS_PER_RANGE <= 500_000
    sorted_columns, real = [], RK.stored
    def seen(df, name):
        if name.endswith("-ordered"):
            sorted_columns.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, name)
    monkeypatch.setattr(RK, "stored", seen)
    df = spark.createDataFrame([(i % 2, i, -i) for i in range(50)], "y int, a int, b int")
    folds = SP.stratified_folds(df, "y", 3, order=["a", "b"]).collect()
    assert sorted(r.a for r in folds) == list(range(50)) and {r.a: r.fold for r in folds}[4] == 2
    assert sorted_columns and "AS _k" not in sorted_columns[0]
