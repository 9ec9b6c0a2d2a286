"""Wrapper feature-subset search by genetic algorithm, on Spark ML.

A candidate is a 0/1 mask over the predictors; its fitness is the mean
positive-class F1 of a depth-limited, class-balanced decision tree over k
stratified folds, using only the masked features. An empty mask scores 0.0.
All trees of a generation grow together in one job a level
(``candidate_trees``). ``FitnessData`` is the other way: the predictors are
assembled once into a vector and persisted, and every (candidate, fold) pair is
a Spark ML fit, submitted concurrently.

The population is a small table (``size`` rows): selection, crossover and
mutation are DataFrame expressions driven by uniforms from an md5, so the same
seed gives the same populations whatever the parallelism, layout or engine.

``MeritScorer`` is the filter form of the fitness: what a mask's predictors tell
of the target, less what they tell of each other, from one correlation pass over
the data. With it a full run costs no model fits.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import portable_uniform
from .candidate_trees import MAX_BINS, CandidateTrees
from .select import corr_matrix, corr_target
from .split import hash_folds, stratified_folds

Scorer = Callable[[Sequence[Sequence[int]]], list[float]]
POP_SCHEMA = "cand_id bigint, genes array<int>"


@dataclass
class SearchConfig:
    generations: int = 10
    size: int = 100
    keep: int = 50              # truncation selection keeps this many
    gamma: float = 0.5          # per-gene swap probability in crossover
    mutation: float = 0.05      # per-gene flip probability, applied to every row
    folds: int = 3
    max_depth: int = 5
    max_bins: int | None = None  # None: the most distinct values of any predictor, so splits are exact
    seed: int = 42
    parallelism: int = 4
    protect: int = 0            # rows exempt from mutation (0 = as the source)
    fold_method: str = "stratified"  # exact; or "hash": no shuffle, stratified in expectation
    dedup: bool = False         # replace repeated masks of a generation by fresh random ones


class FitnessData:
    """Assembled predictors + label + fold + per-fold balanced weights, persisted."""

    def __init__(self, df: DataFrame, predictors: Sequence[str], label: str, k: int, seed: int,
                 fold_keys: Sequence[str] | None = None, fold_method: str = "hash"):
        self.predictors = list(predictors)
        self.label = label
        self.k = k
        base = df.select(*self.predictors, F.col(label).cast("double").alias("label"))
        keys = fold_keys or [*self.predictors, "label"]
        folded = (hash_folds(base, k, seed, keys=keys) if fold_method == "hash"
                  else stratified_folds(base, "label", k, seed, keys=keys))
        vec = VectorAssembler(inputCols=self.predictors, outputCol="all_features").transform(folded)
        # persisted before anything is counted: the input is read once
        self.data = vec.select("all_features", "label", "fold", *self.predictors).persist(StorageLevel.MEMORY_AND_DISK)
        counts = {(r["fold"], r["label"]): r["n"] for r in
                  self.data.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
        # a few more bins than an approximate count asks for
        distinct = self.data.agg(*[F.approx_count_distinct(c, 0.02) for c in self.predictors]).first()
        self.bins = int(max(32, 1.1 * max(distinct) + 2))
        weights = {}
        for f in range(k):
            n0 = sum(v for (fo, y), v in counts.items() if fo != f and y == 0.0)
            n1 = sum(v for (fo, y), v in counts.items() if fo != f and y == 1.0)
            if n0 == 0 or n1 == 0:
                raise ValueError(f"fold {f}: training side lacks a class (n0={n0}, n1={n1})")
            # balanced: n / (2 * n_class), computed on the training side of the fold
            weights[f] = ((n0 + n1) / (2.0 * n0), (n0 + n1) / (2.0 * n1))
        self.weights = weights

    def weight(self, fold: int):
        w0, w1 = self.weights[fold]
        return F.when(F.col("label") == 1.0, F.lit(w1)).otherwise(F.lit(w0))

    def release(self):
        self.data.unpersist()


def fold_f1(data: FitnessData, indices: Sequence[int], fold: int, cfg: SearchConfig) -> float:
    sliced = VectorSlicer(inputCol="all_features", outputCol="features", indices=list(indices)).transform(
        data.data.select("all_features", "label", "fold"))
    train = sliced.filter(F.col("fold") != fold).withColumn("weight", data.weight(fold))
    test = sliced.filter(F.col("fold") == fold)
    tree = DecisionTreeClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxMemoryInMB=1024,
                                  maxDepth=cfg.max_depth, maxBins=cfg.max_bins or data.bins, seed=cfg.seed)
    pred = tree.fit(train).transform(test)
    return positive_f1(pred)


def positive_f1(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> float:
    """F1 of class 1 = 2tp / (2tp + fp + fn), one aggregate; 0.0 when undefined
    (no predicted and no actual positives), as ``fMeasureByLabel`` gives."""
    y, p = F.col(label) == 1.0, F.col(prediction) == 1.0
    r = pred.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                 F.count_if(y & ~p).alias("fn")).first()
    den = 2 * r["tp"] + r["fp"] + r["fn"]
    return 2.0 * r["tp"] / den if den else 0.0


def fitness(data: FitnessData, genes_list: Sequence[Sequence[int]], cfg: SearchConfig,
            memo: dict | None = None) -> list[float]:
    """Mean positive-class F1 per candidate; known masks are not refitted."""
    memo = {} if memo is None else memo
    todo = []
    for g in genes_list:
        key = tuple(int(x) for x in g)
        if key not in memo and any(key):
            todo.extend((key, f) for f in range(cfg.folds))
    todo = list(dict.fromkeys(todo))

    def one(item):
        key, f = item
        return item, fold_f1(data, [i for i, x in enumerate(key) if x], f, cfg)

    if cfg.parallelism > 1:
        with ThreadPoolExecutor(cfg.parallelism) as pool:
            scores = dict(pool.map(one, todo))
    else:
        scores = dict(one(t) for t in todo)
    for key in {k for k, _ in todo}:
        memo[key] = sum(scores[(key, f)] for f in range(cfg.folds)) / cfg.folds
    return [memo.get(tuple(int(x) for x in g), 0.0) if any(g) else 0.0 for g in genes_list]


class MeritScorer:
    """Fitness of a mask from correlations: the sum of its predictors' |r| with the target, less the sum
    of |r| over its pairs divided by its size. Correlations are whole ten-thousandths, so it is exact; a
    missing one counts 0, an empty mask scores 0.0."""

    SCALE = 10_000

    def __init__(self, df: DataFrame, predictors: Sequence[str], label: str):
        whole = lambda c: F.coalesce(F.round(F.abs(F.round(c, 4)) * self.SCALE).cast("long"), F.lit(0))
        number = {p: i for i, p in enumerate(predictors)}
        self.relevance = [0] * len(number)
        for r in corr_target(df, predictors, label).select("variable", whole(F.col("correlation")).alias("w")).collect():
            self.relevance[number[r["variable"]]] = r["w"]
        self.redundancy = {(number[r["var_a"]], number[r["var_b"]]): r["w"] for r in
                           corr_matrix(df, predictors).select("var_a", "var_b", whole(F.col("r")).alias("w")).collect()}

    def __call__(self, genes_list: Sequence[Sequence[int]]) -> list[float]:
        out = []
        for genes in genes_list:
            chosen = [i for i, g in enumerate(genes) if g]
            told = sum(self.relevance[i] for i in chosen)
            shared = sum(self.redundancy[a, b] for n, a in enumerate(chosen) for b in chosen[n + 1:])
            out.append((len(chosen) * told - shared) / len(chosen) if chosen else 0.0)
        return out


def initial_population(spark: SparkSession, size: int, n_genes: int, seed: int) -> DataFrame:
    u = lambda i: portable_uniform(seed, F.lit(0), F.col("cand_id"), i)
    return (spark.range(size).withColumnRenamed("id", "cand_id")
                 .withColumn("genes", F.transform(F.sequence(F.lit(0), F.lit(n_genes - 1)),
                                                  lambda i: (u(i) < 0.5).cast("int"))))


def select_top(pop: DataFrame, keep: int) -> DataFrame:
    """Truncation: best ``keep`` by fitness, ties by id; adds 0-based ``rank``."""
    w = Window.orderBy(F.col("fitness").desc(), F.col("cand_id"))
    return pop.withColumn("rank", F.row_number().over(w) - 1).filter(F.col("rank") < keep)


def crossover(top: DataFrame, n_genes: int, gamma: float, seed: int, generation: int) -> DataFrame:
    """Uniform crossover of adjacent ranked pairs; parents + children.

    Both children of a pair share one swap mask; an unpaired last parent
    yields a copy of itself.
    """
    ranked = top.select("rank", "genes").withColumn("pair", F.floor(F.col("rank") / 2))
    a = ranked.filter(F.col("rank") % 2 == 0).select("pair", F.col("genes").alias("ga"))
    b = ranked.filter(F.col("rank") % 2 == 1).select("pair", F.col("genes").alias("gb"))
    seq = F.sequence(F.lit(0), F.lit(n_genes - 1))

    def swap(i):
        return portable_uniform(seed, F.lit(generation), F.lit(1), F.col("pair"), i) <= gamma

    joined = a.join(b, "pair", "left")
    has_b = F.col("gb").isNotNull()
    child_a = F.when(has_b, F.transform(seq, lambda i: F.when(swap(i), F.col("gb")[i]).otherwise(F.col("ga")[i]))
                     ).otherwise(F.col("ga"))
    child_b = F.transform(seq, lambda i: F.when(swap(i), F.col("ga")[i]).otherwise(F.col("gb")[i]))
    kids_a = joined.select((F.col("pair") * 2).alias("rank"), child_a.alias("genes"))
    kids_b = joined.filter(has_b).select((F.col("pair") * 2 + 1).alias("rank"), child_b.alias("genes"))
    n_par = top.count()
    parents = top.select("rank", "genes")
    kids = kids_a.unionByName(kids_b).withColumn("rank", F.col("rank") + F.lit(n_par))
    return parents.unionByName(kids).select(F.col("rank").cast("bigint").alias("cand_id"), "genes")


def mutate(pop: DataFrame, p: float, seed: int, generation: int, protect: int = 0) -> DataFrame:
    """Flip each gene with probability ``p`` (rows with id < ``protect`` exempt)."""
    def flip(g, i):
        u = portable_uniform(seed, F.lit(generation), F.lit(2), F.col("cand_id"), i)
        return F.when((u <= p) & (F.col("cand_id") >= protect), F.lit(1) - g).otherwise(g)
    return pop.withColumn("genes", F.transform(F.col("genes"), flip))


def fresh_copies(pop: DataFrame, n_genes: int, seed: int, generation: int) -> DataFrame:
    """Every mask once: a later row with the same genes gets random ones instead."""
    nth = F.row_number().over(Window.partitionBy("genes").orderBy("cand_id"))
    u = lambda i: portable_uniform(seed, F.lit(generation), F.lit(3), F.col("cand_id"), i)
    other = F.transform(F.sequence(F.lit(0), F.lit(n_genes - 1)), lambda i: (u(i) < 0.5).cast("int"))
    return pop.withColumn("_nth", nth).select("cand_id", F.when(F.col("_nth") > 1, other).otherwise(F.col("genes")).alias("genes"))


def decode(pop: DataFrame, names: Sequence[str]) -> DataFrame:
    """Add the chosen column names, in predictor order."""
    arr = F.array(*[F.lit(n) for n in names])
    picked = F.transform(F.sequence(F.lit(0), F.lit(len(names) - 1)),
                         lambda i: F.when(F.col("genes")[i] == 1, arr[i]))
    return pop.withColumn("selected", F.filter(picked, lambda x: x.isNotNull()))


def scored(spark: SparkSession, pop: DataFrame, score: Scorer) -> DataFrame:
    """The population with the fitness of every candidate."""
    rows = pop.orderBy("cand_id").collect()           # size rows: the population, not data
    fit = score([r["genes"] for r in rows])
    return spark.createDataFrame([(r["cand_id"], list(r["genes"]), f) for r, f in zip(rows, fit)],
                                 "cand_id bigint, genes array<int>, fitness double")


def next_population(pop: DataFrame, n_genes: int, cfg: SearchConfig, generation: int) -> DataFrame:
    """Selection, crossover and mutation."""
    top = select_top(pop, cfg.keep)
    new = mutate(crossover(top, n_genes, cfg.gamma, cfg.seed, generation), cfg.mutation, cfg.seed, generation, cfg.protect)
    return fresh_copies(new, n_genes, cfg.seed, generation) if cfg.dedup else new


def search(df: DataFrame, predictors: Sequence[str], label: str, cfg: SearchConfig | None = None,
           data: FitnessData | None = None, score: Scorer | None = None):
    """Run the search. Returns (best row dict, history DataFrame, last population).

    Trees of a generation grow together (``candidate_trees``) unless ``data`` asks for one Spark ML fit per
    candidate and fold; the caller releases ``data``. ``score`` replaces the fitness: prepared
    ``CandidateTrees`` to share with ``baseline``, or a ``MeritScorer``.

    The answer is the best of the last generation, as in the source (its
    "elitism" mutates the kept parents too; set ``protect`` to keep them).
    """
    cfg = cfg or SearchConfig()
    spark = df.sparkSession
    n = len(predictors)
    memo: dict = {}
    t_start = time.perf_counter()
    score = score or scorer(df, predictors, label, cfg, data, memo)
    pop = scored(spark, initial_population(spark, cfg.size, n, cfg.seed), score)
    history = []
    for gen in range(1, cfg.generations + 1):
        pop = scored(spark, next_population(pop, n, cfg, gen), score)
        s = pop.agg(F.max("fitness").alias("best"), F.avg("fitness").alias("mean")).first()
        history.append((gen, s["best"], s["mean"], time.perf_counter() - t_start))
    hist = spark.createDataFrame(history, "generation int, best double, mean double, elapsed_s double")
    final = decode(pop, predictors)
    best = final.orderBy(F.col("fitness").desc(), F.col("cand_id")).first().asDict()
    return best, hist, final


def run_log_summary(history: DataFrame) -> DataFrame:
    """Seconds per generation: total elapsed / (generations + 1), counting the
    initial population's evaluation as one generation."""
    return history.agg(F.max("generation").alias("generations"), F.max("elapsed_s").alias("total_s")) \
        .withColumn("seconds_per_generation", F.col("total_s") / (F.col("generations") + 1))


def speed_up(logs: DataFrame, first: str, second: str) -> DataFrame:
    """Seconds per generation of two named runs of ``logs(run, generation, elapsed_s)``, and how many times
    faster the second one is."""
    per_run = logs.groupBy("run").agg((F.max("elapsed_s") / (F.max("generation") + 1)).alias("s"))
    of = lambda name: F.max(F.when(F.col("run") == name, F.col("s")))
    return per_run.agg(of(first).alias("first_s"), of(second).alias("second_s")).withColumn(
        "speed_up", F.try_divide("first_s", "second_s"))


def baseline(df: DataFrame, predictors: Sequence[str], label: str, cfg: SearchConfig | None = None,
             data: FitnessData | None = None, score: Scorer | None = None) -> float:
    """Fitness of the all-ones mask (every predictor)."""
    cfg = cfg or SearchConfig()
    score = score or scorer(df, predictors, label, cfg, data, {})
    return score([[1] * len(predictors)])[0]


def scorer(df: DataFrame, predictors: Sequence[str], label: str, cfg: SearchConfig, data: FitnessData | None = None,
           memo: dict | None = None) -> Scorer:
    """The fitness by trees: grown together, or one Spark ML fit each over ``data``."""
    if data is not None:
        return lambda genes: fitness(data, genes, cfg, memo)
    return CandidateTrees(df, predictors, label, cfg.folds, cfg.max_depth, cfg.seed, cfg.fold_method,
                          cfg.max_bins or MAX_BINS)
