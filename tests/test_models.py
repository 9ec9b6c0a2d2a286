import os

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from cohortlens.operators import model as M
from cohortlens.operators import score as SC
from cohortlens.operators import select as SEL
from cohortlens.sources import files as IO
from cohortlens.sources import registry as REG


def _data(spark, n=600):
    rows = [(i, float(i % 10), float(i % 4), ["1_18a39", "2_40a54"][i % 2], int(i % 10 > 6)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, a double, b double, band string, y int")


def test_assemble_with_string_indexer(spark):
    df = _data(spark)
    out = M.assembled(df, ["a", "band", "b"], "y", keep=["id"])
    rows = {r["id"]: r["features"] for r in out.collect()}
    assert len(rows) == df.count() and rows[13].size == 3 and (rows[13][0], rows[13][2]) == (3.0, 1.0)
    assert {v[1] for v in rows.values()} == {0.0, 1.0}


def test_learners_can_be_extended(spark):
    from pyspark.ml.classification import DecisionTreeClassifier
    own = M.LEARNERS | {"Stump": M.Learner(DecisionTreeClassifier, {"maxDepth": 1})}
    board, best, fitted = M.train_leaderboard(_data(spark), ["a", "b"], "y", ["id"], models=["Stump"], learners=own)
    assert best == "Stump" and fitted["Stump"].stages[-1].depth == 1 and board.count() == 1


def test_confusion_metrics_match_spark(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator as E
    df = spark.createDataFrame([(float(i % 3 == 0), float(i % 4 == 0)) for i in range(50)], "y double, prediction double")
    got = M.confusion_metrics(df, "y")
    for name, metric in (("accuracy", "accuracy"), ("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("f1", "f1")):
        assert got[name] == pytest.approx(E(labelCol="y", metricName=metric).evaluate(df))
    none = M.confusion_metrics(df.withColumn("prediction", F.lit(0.0)), "y")
    assert none["recall_pos"] == none["f1_pos"] == 0.0


def test_the_winner_is_saved(spark, tmp_dir):
    reg = os.path.join(tmp_dir, "registry")
    board = M.train_and_save(_data(spark), ["a", "b"], "y", ["id"], reg, os.path.join(tmp_dir, "m"),
                             models=["NaiveBayes", "LogisticRegression"])
    info, model = REG.load_latest(spark, reg)
    assert info["model"] == board.filter("best").first().model == board.first().model
    assert info["value"] == board.first().accuracy


def test_bad_requests_are_rejected_in_batch_and_stream(spark, tmp_dir):
    from cohortlens.streaming import score_stream
    _, best, fitted = M.train_leaderboard(_data(spark), ["a", "b"], "y", ["id"], models=["LogisticRegression"])
    rows = [(1, {"a": 9.0, "b": 1.0}), (2, {"a": None, "b": 1.0}), (3, {"a": float("nan"), "b": 1.0}), (4, {}), (5, None)]
    req = spark.createDataFrame(rows, SC.REQUEST_SCHEMA)
    req.write.parquet(os.path.join(tmp_dir, "src"))
    batch = SC.score(fitted[best], best, req, ["a", "b"])
    streamed = score_stream.run_available(spark, fitted[best], best, ["a", "b"], os.path.join(tmp_dir, "src"),
                                          os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ckpt"))
    want = {1: [], 2: ["a"], 3: ["a"], 4: ["a", "b"], 5: ["a", "b"]}
    for out in (batch, streamed):
        got = {r.request_id: r for r in out.collect()}
        assert {i: r.missing for i, r in got.items()} == want
        assert all((r.status == "scored") == (i == 1) and (r.prediction is None) == (i != 1) for i, r in got.items())


def test_leaderboard_all_models(spark):
    board, best, fitted = M.train_leaderboard(_data(spark), ["a", "b"], "y", split_keys=["id"], parallelism=2)
    rows = board.collect()
    assert {r.model for r in rows} == {"DecisionTree", "RandomForest", "LinearSVC", "LogisticRegression", "NaiveBayes"}
    assert rows[0].model == best and all(r.accuracy >= rows[-1].accuracy for r in rows)
    # a separable label: ranking beats the prevalence baseline
    assert all(r.auc_pr > r.baseline_auc_pr for r in rows)
    # weighted recall is accuracy
    assert all(abs(r.recall - r.accuracy) < 1e-12 for r in rows)


def test_registry_newest_and_errors(spark, tmp_dir):
    reg = os.path.join(tmp_dir, "registry")
    with pytest.raises(REG.RegistryError):
        REG.load_latest(spark, reg)
    df = _data(spark)
    _, best, fitted = M.train_leaderboard(df, ["a", "b"], "y", split_keys=["id"], models=["LogisticRegression", "NaiveBayes"])
    REG.register(spark, reg, fitted["NaiveBayes"], "NaiveBayes", os.path.join(tmp_dir, "m1"), ["a", "b"], "y", "accuracy", 0.5)
    REG.register(spark, reg, fitted["LogisticRegression"], "LogisticRegression", os.path.join(tmp_dir, "m2"),
                 ["a", "b"], "y", "accuracy", 0.6)
    info, model = REG.load_latest(spark, reg)
    assert info["model"] == "LogisticRegression" and info["features"] == ["a", "b"]
    card = REG.model_card(spark, reg).collect()
    assert len(card) == 1 and card[0].features == ["a", "b"]
    # a pipeline whose last stage is not a classifier is rejected
    odd = Pipeline(stages=[VectorAssembler(inputCols=["a"], outputCol="features")]).fit(df)
    REG.register(spark, reg, odd, "Odd", os.path.join(tmp_dir, "m3"), ["a"], "y", "accuracy", 0.0)
    with pytest.raises(REG.RegistryError):
        REG.load_latest(spark, reg)


def test_json_requests(spark):
    rows = [(1, '{"features": {"a": 9, "b": 1}}'), (2, '{"features": {"a": 9}}'), (3, "not json")]
    req = SC.requests_from_json(spark.createDataFrame(rows, "request_id long, body string"))
    df = _data(spark)
    _, best, fitted = M.train_leaderboard(df, ["a", "b"], "y", split_keys=["id"], models=["LogisticRegression"])
    out = {r.request_id: r for r in SC.score(fitted[best], best, req, ["a", "b"]).collect()}
    assert out[1].status == "scored" and out[2].missing == ["b"] and out[3].missing == ["a", "b"]


def test_selection_side_table_keeps_rank_order(spark, tmp_dir):
    df = spark.createDataFrame([(float(i % 2), float(i), float(i % 3), float(-i)) for i in range(30)],
                               "y double, a double, b double, c double")
    ranked = SEL.select_features(df, ["a", "b", "c"], "y", top_n=2)
    path = os.path.join(tmp_dir, "sel")
    IO.write_selection(ranked, path)
    back = IO.read_selection(spark, path)
    assert IO.selected_names(back) == SEL.selected_list(ranked)
    assert [r["rank"] for r in back.collect()] == [1, 2, 3]


def test_stream_scoring_equals_batch(spark, tmp_dir):
    from cohortlens.streaming import score_stream
    df = _data(spark)
    _, best, fitted = M.train_leaderboard(df, ["a", "b"], "y", split_keys=["id"], models=["LogisticRegression"])
    req = SC.requests_from_table(df, ["a", "b"], "id", drop_key_when=(F.col("id") % 50 == 0))
    src = os.path.join(tmp_dir, "src")
    req.repartition(3).write.parquet(src)
    streamed = score_stream.run_available(spark, fitted[best], best, ["a", "b"], src,
                                          os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ckpt"))
    batch = SC.score(fitted[best], best, spark.read.parquet(src), ["a", "b"])
    key = lambda rows: sorted((r.request_id, r.status, r.prediction, r.probability) for r in rows)
    assert key(streamed.collect()) == key(batch.collect())
    assert streamed.filter("status = 'rejected'").count() == 12


def test_hash_folds_cover_all_rows(spark):
    from cohortlens.operators.split import hash_folds
    df = _data(spark, 900)
    f = hash_folds(df, 3, 42, keys=["id", "a", "b", "y"])
    counts = [r.n for r in f.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(counts) == 900 and len(counts) == 3 and min(counts) > 250


def test_equal_rows_travel_once_and_count_in_full(spark):
    """A row with its number gives what its copies give: counts, weights, prevalence and metrics."""
    base = [(float(i % 7), float(i % 5), int((i % 7) + (i % 5) > 6), i) for i in range(700)]
    df = spark.createDataFrame(base, "a double, b double, y int, id int")
    grouped = M.equal_rows(df, ["a", "b"], "y", ["id"])
    train, test, p = M.prepare(df, "y", ["id"])
    assert grouped.count() <= 2 * 35
    assert {r["_train"]: r["n"] for r in grouped.groupBy("_train").agg(F.sum(M.ROWS).alias("n")).collect()} == {
        True: train.count(), False: test.count()}
    board, _, fitted = M.train_leaderboard(df, ["a", "b"], "y", ["id"], models=["NaiveBayes", "DecisionTree", "RandomForest"])
    got = {r["model"]: r for r in board.collect()}
    assert got["NaiveBayes"]["baseline_auc_pr"] == pytest.approx(p, abs=1e-12)
    prep = M.input_pipeline(df, ["a", "b"]).fit(df)
    for name in ("NaiveBayes", "DecisionTree"):
        alone = M.LEARNERS[name].build("y", "class_weight", M.SEED).fit(prep.transform(train))
        want = M.evaluate(alone.transform(prep.transform(test)), "y", M.LEARNERS[name].ranks_by)
        assert {k: got[name][k] for k in want} == pytest.approx(want, abs=1e-6)
    assert len(fitted["RandomForest"].stages[-1].trees) == 50 and got["RandomForest"]["accuracy"] > 0.95


def test_many_rows_are_fitted_one_model_after_another(spark, monkeypatch):
    import threading
    import time
    now, most, lock = set(), [], threading.Lock()

    class Watched(M.Learner):
        def build(self, label, weight, seed):
            made = super().build(label, weight, seed)
            inner = made.fit

            def fit(df):
                with lock:
                    now.add(id(made))
                    most.append(len(now))
                time.sleep(0.3)
                try:
                    return inner(df)
                finally:
                    now.discard(id(made))
            made.fit = fit
            return made
    learners = {n: Watched(x.make, x.params, x.ranks_by, x.drawn_apart) for n, x in M.LEARNERS.items() if n in ("NaiveBayes", "DecisionTree")}
    fit = lambda: M.train_leaderboard(_data(spark), ["a", "b"], "y", ["id"], learners=learners, parallelism=2)[0].drop("fit_seconds").collect()
    together = fit()
    assert max(most) == 2
    most.clear()
    monkeypatch.setattr(M, "ROWS_AT_ONCE", 10)
    assert fit() == together and max(most) == 1
