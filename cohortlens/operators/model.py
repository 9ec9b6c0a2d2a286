"""Class-weighted Spark ML classifiers, evaluated on a layout-independent split."""

from __future__ import annotations

import math
import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.columns import class_weight
from .rank import stored
from .split import hash_split, on_train_side

SEED = 42
FEATURES = "features"
ROWS = "_rows"                  # how many equal rows one stands for
ROWS_PER_PART = 500_000
ROWS_AT_ONCE = 1_000_000        # rows up to which models are fitted at the same time: more keep every core at work by themselves


class ModelError(ValueError):
    pass


@dataclass(frozen=True)
class Learner:
    """A classifier class with its parameters; ``ranks_by`` is the output that orders rows.

    A learner that draws rows at random gets equal rows as ``drawn_apart`` rows at most, each of the same
    weight (1: no draws). Up to that many equal rows are drawn one by one, as if they had not been put together."""
    make: type
    params: Mapping = field(default_factory=dict)
    ranks_by: str = "probability"
    drawn_apart: int = 1

    def build(self, label: str, weight: str | None, seed: int):
        settings = dict(self.params) | ({"weightCol": weight} if weight else {})
        if hasattr(self.make, "setSeed"):
            settings["seed"] = seed
        return self.make(featuresCol=FEATURES, labelCol=label, **settings)


# fixed values: the five classifiers and their parameters
LEARNERS: dict[str, Learner] = {
    "NaiveBayes": Learner(NaiveBayes, {"modelType": "gaussian"}),
    "LogisticRegression": Learner(LogisticRegression, {"maxIter": 50}),
    "LinearSVC": Learner(LinearSVC, {"maxIter": 50}, ranks_by="rawPrediction"),
    "DecisionTree": Learner(DecisionTreeClassifier, {"maxDepth": 8}),
    "RandomForest": Learner(RandomForestClassifier, {"maxDepth": 8, "numTrees": 50}, drawn_apart=16),
}


def input_pipeline(df: DataFrame, features: Sequence[str]) -> Pipeline:
    """Features in list order as one vector; text columns of ``df`` become category numbers,
    with one more for values not seen in fitting."""
    kind, columns, stages = dict(df.dtypes), [], []
    for name in features:
        if kind[name] == "string":
            columns.append(f"{name}__number")
            stages.append(StringIndexer(inputCol=name, outputCol=columns[-1]).setHandleInvalid("keep"))
        else:
            columns.append(name)
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=columns, outputCol=FEATURES)])


def with_class_weight(df: DataFrame, label: str, weight_col: str, prevalence: float) -> DataFrame:
    if prevalence is None or prevalence <= 0 or prevalence >= 1:
        raise ModelError(f"class weights need both classes present; prevalence={prevalence}")
    return df.withColumn(weight_col, class_weight(label, prevalence))


def prepare(df: DataFrame, label: str, split_keys: Sequence[str], weight_col: str = "class_weight",
            train_fraction: float = 0.8, seed: int = SEED, weights_from: str = "train"):
    """(train, test, prevalence). Weights come from the training side unless
    ``weights_from='all'`` (the source computed them over every row)."""
    train, test = hash_split(df, split_keys, train_fraction, seed)
    basis = df if weights_from == "all" else train
    p = basis.agg(F.avg(F.col(label).cast("double"))).first()[0]
    return (with_class_weight(train, label, weight_col, p),
            with_class_weight(test, label, weight_col, p), p)


def confusion_metrics(pred: DataFrame, label: str, prediction: str = "prediction", rows: str | None = None) -> dict:
    """Accuracy, weighted precision/recall/F1, positive-class recall/F1 from one
    label x prediction count table (at most classes x classes rows). ``rows`` says how many rows one stands for."""
    counts = {(float(r[0]), float(r[1])): r["n"] for r in
              pred.groupBy(label, prediction).agg((F.sum(rows) if rows else F.count(F.lit(1))).alias("n")).collect()}
    total = sum(counts.values())
    share = lambda a, b: a / b if b else 0.0
    per_class = {}
    for c in {y for y, _ in counts}:
        hit = counts.get((c, c), 0)
        actual = sum(n for (y, _), n in counts.items() if y == c)
        called = sum(n for (_, p), n in counts.items() if p == c)
        precision, recall = share(hit, called), share(hit, actual)
        per_class[c] = (actual, precision, recall, share(2 * precision * recall, precision + recall))
    weighted = lambda k: share(sum(v[0] * v[k] for v in per_class.values()), total)
    positive = per_class.get(1.0, (0, 0.0, 0.0, 0.0))
    return {"accuracy": share(sum(n for (y, p), n in counts.items() if y == p), total), "precision": weighted(1),
            "recall": weighted(2), "f1": weighted(3), "recall_pos": positive[2], "f1_pos": positive[3]}


def evaluate(pred: DataFrame, label: str, ranks_by: str, rows: str | None = None) -> dict:
    """``confusion_metrics`` and AUC-PR, which ranks rows by the positive class's
    entry of ``ranks_by`` (raw scores do not rank rows for every model)."""
    scored = pred.withColumn("_score", F.get(vector_to_array(F.col(ranks_by)), 1))
    auc = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="_score", metricName="areaUnderPR")
    if rows:
        auc = auc.setWeightCol(rows)
    return confusion_metrics(pred, label, rows=rows) | {"auc_pr": auc.evaluate(scored)}


def equal_rows(df: DataFrame, features: Sequence[str], label: str, split_keys: Sequence[str],
               train_fraction: float = 0.8, seed: int = SEED) -> DataFrame:
    """(features, label, _train, _rows): rows of a side that a model cannot tell apart, once with their number. One pass."""
    side = on_train_side(split_keys, train_fraction, seed).alias("_train")
    return stored(df.groupBy(*dict.fromkeys(features), label, side).agg(F.count(F.lit(1)).alias(ROWS)), "equal-rows")


def train_leaderboard(df: DataFrame, features: Sequence[str], label: str,
                      split_keys: Sequence[str], models: Sequence[str] | None = None,
                      metric: str = "accuracy", learners: Mapping[str, Learner] = LEARNERS,
                      weight_col: str = "class_weight", weights_from: str = "train",
                      parallelism: int = 1, seed: int = SEED):
    """Fit each model on the training side, score the test side.

    Returns ``(leaderboard DataFrame, best name, {name: PipelineModel})``.
    Every row of both sides counts. Rows with equal features and label travel once: their weight is
    the class weight times their number, and metrics count them as often. Both sides are persisted on disk
    for the fits and released afterwards: what a fit reads often it keeps in memory in a form of its own.
    ``parallelism`` > 1 submits fits concurrently, up to ``ROWS_AT_ONCE`` rows; of more, what several
    fits keep would not fit into memory together.
    """
    spark = df.sparkSession
    prep = input_pipeline(df, features).fit(hash_split(df, split_keys, seed=seed)[0])    # reads rows for text features only
    rows = equal_rows(df, features, label, split_keys, seed=seed)
    y = F.col(label).cast("double")
    p = (rows if weights_from == "all" else rows.filter("_train")).agg(
        F.try_divide(F.sum(y * F.col(ROWS)), F.sum(F.when(y.isNotNull(), F.col(ROWS))))).first()[0]
    weighted = with_class_weight(rows, label, weight_col, p).withColumn(weight_col, F.col(weight_col) * F.col(ROWS))
    # few files come of few bytes; the fits want every core
    n = rows.count()
    parts = max(2 * spark.sparkContext.defaultParallelism, math.ceil(n / ROWS_PER_PART))
    vectors = prep.transform(weighted).select(FEATURES, label, weight_col, ROWS, "_train").repartition(parts)
    train_v = vectors.filter("_train").persist(StorageLevel.DISK_ONLY)
    test_v = vectors.filter("NOT _train").persist(StorageLevel.DISK_ONLY)
    names = list(models or learners)

    def for_learner(learner):
        if learner.drawn_apart == 1:
            return train_v
        apart = F.least(F.lit(learner.drawn_apart).cast("long"), F.col(ROWS))
        return (train_v.withColumn(weight_col, F.col(weight_col) / apart)
                .withColumn("_part", F.explode(F.sequence(F.lit(1).cast("long"), apart))).drop("_part"))
    try:
        def run(name):
            t0 = time.perf_counter()
            fitted = learners[name].build(label, weight_col, seed).fit(for_learner(learners[name]))
            by = learners[name].ranks_by
            pred = fitted.transform(test_v).select(label, "prediction", by, ROWS).persist(StorageLevel.DISK_ONLY)
            try:
                m = evaluate(pred, label, by, ROWS)
            finally:
                pred.unpersist()
            m.update(model=name, fit_seconds=time.perf_counter() - t0)
            return name, PipelineModel(stages=[*prep.stages, fitted]), m

        if parallelism > 1 and n <= ROWS_AT_ONCE:
            with ThreadPoolExecutor(parallelism) as pool:
                results = list(pool.map(run, names))
        else:
            results = [run(n) for n in names]
    finally:
        train_v.unpersist()
        test_v.unpersist()

    scores = [r[2] for r in results]
    fitted = {r[0]: r[1] for r in results}
    cols = ["model", "accuracy", "precision", "recall", "f1", "recall_pos", "f1_pos", "auc_pr", "fit_seconds"]
    board = spark.createDataFrame([tuple(r[c] for c in cols) for r in scores],
                                  "model string, accuracy double, precision double, recall double, f1 double, "
                                  "recall_pos double, f1_pos double, auc_pr double, fit_seconds double")
    board = board.withColumn("baseline_auc_pr", F.lit(float(p)))
    # same order as the board: metric descending, ties by model name
    best = min(scores, key=lambda r: (-r[metric], r["model"]))["model"]
    return board.orderBy(F.col(metric).desc(), F.col("model")), best, fitted


def assembled(df: DataFrame, features: Sequence[str], label: str, keep: Sequence[str] = ()) -> DataFrame:
    """(kept columns, features vector, label) for every row: the model input table."""
    return input_pipeline(df, features).fit(df).transform(df).select(*keep, FEATURES, label)


def train_and_save(df: DataFrame, features: Sequence[str], label: str, split_keys: Sequence[str],
                   registry: str, model_path: str, metric: str = "accuracy", **options) -> DataFrame:
    """Fit every model, save and register the one that wins on ``metric``; the leaderboard."""
    from ..sources import registry as REG
    board, best, fitted = train_leaderboard(df, features, label, split_keys, metric=metric, **options)
    value = board.filter(F.col("model") == best).first()[metric]
    REG.register(df.sparkSession, registry, fitted[best], best, model_path, features, label, metric, value)
    return board.withColumn("best", F.col("model") == F.lit(best))


def naive_bayes_parameters(fitted, features: Sequence[str], spark) -> DataFrame:
    """(label, feature, mean, variance, log_prior) of a fitted Gaussian naive Bayes model; classes x features rows."""
    means, variances, priors = fitted.theta.toArray(), fitted.sigma.toArray(), fitted.pi.toArray()
    rows = [(label, f, float(means[label][i]), float(variances[label][i]), float(priors[label]))
            for label in range(len(priors)) for i, f in enumerate(features)]
    return spark.createDataFrame(rows, "label int, feature string, mean double, variance double, log_prior double")
