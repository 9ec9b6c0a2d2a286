"""Registered queries of the operators that are exact at any size: positions, folds, row
numbers, quartiles and histograms of continuous columns, correlations far from zero,
ranking areas, naive Bayes parameters, and the subset search by a filter fitness."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import digest as D
from ..operators import model as M
from ..operators import profile as P
from ..operators import rank as RK
from ..operators import search as GA
from ..operators import select as SEL
from ..operators import split as SP
from ..operators.candidate_trees import CandidateTrees
from ..operators.ranking import ranking_metrics
from ..session import planning_session
from ..sources import analog
from . import oracle as O
from .catalog import ORACLE, SCORE_PARTS, SPLIT_BUCKET_SQL, S, clean, curated, register

FOLDS = 3
PRICES = ("l_extendedprice", "charge")
SHIFT = 100_000_000
RANK_SCORE = f"(7 - {S.score_col}) * 100 + {S.measure}"
SEARCH = GA.SearchConfig()                               # the study's: 10 generations of 100, 50 kept


def prices(spark, sf):
    """Two continuous columns of ``lineitem``, with its return flag."""
    rows = analog.table(planning_session(spark), sf, "lineitem")
    return rows.selectExpr("l_returnflag", "l_extendedprice", "l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge")


PRICES_SQL = "SELECT l_returnflag, l_extendedprice, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge FROM lineitem"


# -- positions ------------------------------------------------------------------

@register("stratified_folds", O.with_ctes(
    f"SELECT {S.id_col}, {O.T}, CAST((row_number() OVER (PARTITION BY {O.T} ORDER BY {SPLIT_BUCKET_SQL}, {S.id_col}) - 1) "
    f"% {FOLDS} AS INTEGER) AS fold FROM curated"))
def q_stratified_folds(spark, sf):
    """Folds of every class that differ by at most one row."""
    rows = curated(spark, sf).select(S.id_col, S.target)
    return SP.stratified_folds(rows, S.target, FOLDS, order=[F.expr(SPLIT_BUCKET_SQL), S.id_col])


@register("row_numbers", O.with_ctes(
    f"SELECT {O.T}, {', '.join(SCORE_PARTS)}, row_number() OVER (PARTITION BY {O.T}, {', '.join(SCORE_PARTS)}) - 1 AS copy, "
    f"true AS id_is_unique FROM curated"))
def q_row_numbers(spark, sf):
    """Repeated answers get ids of their own: the copies of a row are numbered 0, 1, .."""
    answers = curated(spark, sf).select(S.target, *SCORE_PARTS)
    ids = RK.stored(RK.row_ids(answers), "row-ids")
    counts = ids.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("row_id").alias("ids"))
    unique = counts.select((F.col("rows") == F.col("ids")).alias("same"))
    return ids.select(S.target, *SCORE_PARTS, F.col("row_id_copy").alias("copy"), unique.scalar().alias("id_is_unique"))


@register("duplicate_rows_digest", ORACLE["duplicate_rows"])
def q_duplicate_rows_digest(spark, sf):
    """Repeated rows by digests: only rows that share one are grouped on all columns."""
    return D.duplicate_rows(clean(spark, sf), S.columns)


@register("label_conflicts_digest", ORACLE["label_conflicts"])
def q_label_conflicts_digest(spark, sf):
    return D.label_conflicts(clean(spark, sf), S.predictors, S.target)


# -- continuous columns -----------------------------------------------------------

def _describe_prices_sql(by: str | None) -> str:
    keep, group = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    one = lambda c: (f"SELECT {keep}'{c}' AS variable, COUNT({c}) AS \"count\", round(AVG({c}), 6) AS mean, "  # noqa: E731
                     f"round(stddev_samp({c}), 6) AS std, MIN({c}) AS min, " + ", ".join(
                         f"round(quantile_cont({c}, {p}), 6) AS {t}" for t, p in P.QUARTILES) +
                     f", MAX({c}) AS max FROM ({PRICES_SQL}) p{group}")
    return "\nUNION ALL ".join(one(c) for c in PRICES)


def _six_digits(described):
    return described.withColumns({c: F.round(c, 6) for c in ("mean", "std", *[t for t, _ in P.QUARTILES])})


@register("describe_continuous", _describe_prices_sql(None))
def q_describe_continuous(spark, sf):
    return _six_digits(P.describe(prices(spark, sf), PRICES))


@register("describe_continuous_by", _describe_prices_sql("l_returnflag"))
def q_describe_continuous_by(spark, sf):
    return _six_digits(P.describe(prices(spark, sf), PRICES, by="l_returnflag"))


def _histogram_prices_sql(bins: int) -> str:
    one = lambda c: f"""SELECT '{c}' AS variable, b.bin, lo, hi, COUNT(x.bin) AS n
FROM (SELECT MIN({c}) AS lo, MAX({c}) AS hi FROM p) r CROSS JOIN range(1, {bins + 1}) b(bin)
LEFT JOIN (SELECT LEAST(CAST(floor({bins} * ({c} - (SELECT MIN({c}) FROM p)) / ((SELECT MAX({c}) FROM p) - (SELECT MIN({c}) FROM p)))
             AS BIGINT) + 1, {bins}) AS bin FROM p) x ON x.bin = b.bin GROUP BY b.bin, lo, hi"""  # noqa: E731
    return f"WITH p AS ({PRICES_SQL})\n" + "\nUNION ALL ".join(one(c) for c in PRICES)


@register("histogram_continuous", _histogram_prices_sql(30))
def q_histogram_continuous(spark, sf):
    return P.histogram(prices(spark, sf), PRICES, 30)


# -- correlations far from zero ------------------------------------------------------

# a column near 10^8, one near -10^8 with nulls, one near 0; the target is small
SHIFTED = {"far": f"{SHIFT} + l_extendedprice / 1000", "gaps": f"CASE WHEN l_orderkey % 5 <> 0 THEN l_quantity - {SHIFT} END",
           "near": "l_discount", "flat": f"CAST({SHIFT} + 0.1 AS DOUBLE)"}
SHIFTED_TARGET = f"l_extendedprice / 1000 + l_linenumber + {SHIFT}"
_SHIFTED_SELECT = ", ".join(f"{e} AS {c}" for c, e in SHIFTED.items()) + f", {SHIFTED_TARGET} AS target"


def shifted(spark, sf):
    return analog.table(planning_session(spark), sf, "lineitem").selectExpr(*_SHIFTED_SELECT.split(", "))


# the engine's own correlation, over the same values moved back
def _corr_sql(a: str, b: str, digits: int) -> str:
    return (f"CASE WHEN MIN({a}) FILTER ({b} IS NOT NULL) = MAX({a}) FILTER ({b} IS NOT NULL) "
            f"OR MIN({b}) FILTER ({a} IS NOT NULL) = MAX({b}) FILTER ({a} IS NOT NULL) THEN NULL "
            f"ELSE round(corr({a}, {b}), {digits}) + CAST(0 AS DOUBLE) END")


@register("corr_target_shifted", "\nUNION ALL ".join(
    f"SELECT '{c}' AS variable, {_corr_sql(c, 'target', 7)} AS correlation FROM (SELECT {_SHIFTED_SELECT} FROM lineitem) s"
    for c in SHIFTED))
def q_corr_target_shifted(spark, sf):
    return SEL.corr_target(shifted(spark, sf), list(SHIFTED), "target", digits=7)


_SHIFTED_PAIRS = [(a, b) for i, a in enumerate([*SHIFTED, "target"]) for b in [*SHIFTED, "target"][i + 1:]]


@register("corr_matrix_shifted", "\nUNION ALL ".join(
    f"SELECT '{a}' AS var_a, '{b}' AS var_b, {_corr_sql(a, b, 7)} AS r FROM (SELECT {_SHIFTED_SELECT} FROM lineitem) s"
    for a, b in _SHIFTED_PAIRS))
def q_corr_matrix_shifted(spark, sf):
    return SEL.corr_matrix(shifted(spark, sf), [*SHIFTED, "target"], digits=7).withColumn("r", F.col("r") + F.lit(0.0))


# -- ranking and naive Bayes -----------------------------------------------------------

@register("ranking_metrics", O.with_ctes("""SELECT CAST(MAX(called) AS BIGINT) AS rows, CAST(MAX(hits) AS BIGINT) AS positives,
  round(SUM(pos * (hits / called + coalesce((hits - pos) / nullif(called - n, 0), hits / called)) / 2) / MAX(hits), 9) AS auc_pr,
  round(SUM(pos * hits / called) / MAX(hits), 9) AS average_precision,
  round(SUM((n - pos) * (hits - pos / 2)) / (MAX(hits) * (MAX(called) - MAX(hits))), 9) AS auc_roc
FROM c""", f"""
g AS (SELECT {RANK_SCORE} AS score, CAST(COUNT(*) AS DOUBLE) AS n, CAST(SUM({O.T}) AS DOUBLE) AS pos FROM clean GROUP BY 1),
c AS (SELECT n, pos, SUM(n) OVER w AS called, SUM(pos) OVER w AS hits FROM g
      WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""))
def q_ranking_metrics(spark, sf):
    """Areas under the precision-recall and ROC curves of a fixed score."""
    found = ranking_metrics(clean(spark, sf).withColumn("_score", F.expr(RANK_SCORE)), "_score", S.target)
    return found.withColumns({c: F.round(c, 9) for c in ("auc_pr", "average_precision", "auc_roc")})


def _bayes_sql() -> str:
    """Class means, population variances with the smoothing of the fit, and log priors, on the training side."""
    one = lambda p: (f"SELECT CAST({O.T} AS INTEGER) AS label, '{p}' AS feature, AVG({p}) AS mean, var_pop({p}) AS variance, "  # noqa: E731
                     f"ln(COUNT(*) / (SELECT CAST(COUNT(*) AS DOUBLE) FROM t)) AS log_prior FROM t GROUP BY {O.T}")
    return O.with_ctes(f"""SELECT label, feature, round(mean, 6) AS mean, round(variance + 1e-9 * largest, 6) AS variance,
  round(log_prior, 6) AS log_prior
FROM ({" UNION ALL ".join(one(p) for p in O.PRED)}) f, (SELECT greatest({', '.join(f'var_pop({p})' for p in O.PRED)}) AS largest FROM t) g""",
                       f"\nt AS (SELECT * FROM curated WHERE {SPLIT_BUCKET_SQL} < 80)")


@register("naive_bayes_parameters", _bayes_sql())
def q_naive_bayes_parameters(spark, sf):
    """What the leaderboard's naive Bayes learns of the training side."""
    train, _ = SP.hash_split(curated(spark, sf), [], 0.8, bucket=F.expr(SPLIT_BUCKET_SQL), buckets=100)
    table = M.assembled(train, S.predictors, S.target)
    return M.naive_bayes_parameters(M.LEARNERS["NaiveBayes"].build(S.target, None, M.SEED).fit(table), S.predictors, spark) \
        .withColumns({c: F.round(c, 6) for c in ("mean", "variance", "log_prior")})


def _bayes_metrics_sql() -> str:
    """The metrics of that fit's predictions on the other side."""
    stats = ", ".join(f"AVG({p}) FILTER ({O.T} = {y}) AS m{y}_{i}, var_pop({p}) FILTER ({O.T} = {y}) + 1e-9 * (SELECT largest FROM g) AS v{y}_{i}"
                      for y in (0, 1) for i, p in enumerate(O.PRED))
    like = lambda y: f"l{y} + " + " + ".join(
        f"(-0.5 * ln(2 * pi() * v{y}_{i}) - ({p} - m{y}_{i}) * ({p} - m{y}_{i}) / (2 * v{y}_{i}))" for i, p in enumerate(O.PRED))
    return O.metrics_sql(f"SELECT {O.T} AS y, CASE WHEN {like(1)} > {like(0)} THEN 1 ELSE 0 END AS p FROM "
                         f"(SELECT * FROM curated WHERE NOT ({SPLIT_BUCKET_SQL} < 80)) held, s", f"""
b AS MATERIALIZED (SELECT * FROM curated WHERE {SPLIT_BUCKET_SQL} < 80),
g AS MATERIALIZED (SELECT greatest({', '.join(f'var_pop({p})' for p in O.PRED)}) AS largest FROM b),
s AS MATERIALIZED (SELECT ln(COUNT(*) FILTER ({O.T} = 1) / CAST(COUNT(*) AS DOUBLE)) AS l1,
  ln(COUNT(*) FILTER ({O.T} = 0) / CAST(COUNT(*) AS DOUBLE)) AS l0, {stats} FROM b),""")


@register("naive_bayes_metrics", _bayes_metrics_sql())
def q_naive_bayes_metrics(spark, sf):
    """Accuracy, weighted precision, recall and F1 of the fitted naive Bayes on the held-out side."""
    train, test = SP.hash_split(curated(spark, sf), [], 0.8, bucket=F.expr(SPLIT_BUCKET_SQL), buckets=100)
    fitted = M.LEARNERS["NaiveBayes"].build(S.target, None, M.SEED).fit(M.assembled(train, S.predictors, S.target))
    found = M.confusion_metrics(fitted.transform(M.assembled(test, S.predictors, S.target)), S.target)
    return spark.createDataFrame([tuple(found.values())], ", ".join(f"{k} double" for k in found))


# -- narrowing and indexing -----------------------------------------------------------

WIDE = {"price": "l_extendedprice", "tenths": "CASE WHEN l_linenumber > 1 THEN l_extendedprice / 10 END",
        "below": "-l_orderkey * 7.5", "small": "l_quantity / 3"}
_WIDE_SQL = "SELECT " + ", ".join(f"CAST({e} AS DOUBLE) AS {c}" for c, e in WIDE.items()) + " FROM lineitem"


def wide(spark, sf):
    return analog.table(planning_session(spark), sf, "lineitem").selectExpr(
        *[f"CAST({e} AS DOUBLE) AS {c}" for c, e in WIDE.items()])


@register("narrow_rejects_wide", "\nUNION ALL ".join(
    f"SELECT '{c}' AS variable, COUNT(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST(trunc({c}) AS SMALLINT) IS NULL) AS rejected "
    f"FROM ({_WIDE_SQL}) w" for c in WIDE))
def q_narrow_rejects_wide(spark, sf):
    """Values that do not fit the narrow type, in columns where many do not."""
    return C.reject_count(wide(spark, sf), list(WIDE))


@register("narrow_cast_wide", f"SELECT {', '.join(f'TRY_CAST(trunc({c}) AS SMALLINT) AS {c}' for c in WIDE)} FROM ({_WIDE_SQL}) w")
def q_narrow_cast_wide(spark, sf):
    return C.narrow(wide(spark, sf))


@register("assemble_text", O.with_ctes(
    f"SELECT {S.id_col}, CAST(0 AS INTEGER) AS position, CAST(number AS DOUBLE) AS value FROM curated JOIN b USING ({S.band_col}) "
    f"UNION ALL SELECT {S.id_col}, 1, CAST({S.measure} AS DOUBLE) FROM curated", f"""
b AS (SELECT {S.band_col}, row_number() OVER (ORDER BY COUNT(*) DESC, {S.band_col}) - 1 AS number FROM curated GROUP BY {S.band_col})"""))
def q_assemble_text(spark, sf):
    """A text feature becomes its number by frequency, then name, in the vector."""
    from pyspark.ml.functions import vector_to_array
    table = M.assembled(curated(spark, sf), [S.band_col, S.measure], S.target, keep=[S.id_col])
    return table.select(S.id_col, F.posexplode(vector_to_array(M.FEATURES)).alias("position", "value"))


# -- fitness by trees, at depth one ------------------------------------------------------

def _stump_sql() -> str:
    fold = (f"CAST((row_number() OVER (PARTITION BY {O.T} ORDER BY {SPLIT_BUCKET_SQL}, {S.id_col}, {', '.join(O.PRED)}) - 1) "
            f"% {FOLDS} AS INTEGER)")                     # ids repeat in the analog
    number = "CASE variable " + " ".join(f"WHEN '{p}' THEN {i}" for i, p in enumerate(O.PRED)) + " END"
    impure = lambda a, b: (f"(1 - ({a} * w0 / ({a} * w0 + {b} * w1)) ** 2 - ({b} * w1 / ({a} * w0 + {b} * w1)) ** 2)")
    size = lambda a, b: f"({a} * w0 + {b} * w1)"
    best = lambda name, part, by: f"""
{name} AS (SELECT * FROM s WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY {part} ORDER BY {by}) = 1)"""  # noqa: E731
    f1 = """2 * tp / (2 * tp + fp + fn)"""
    scored = lambda name: f"""(SELECT *, CASE WHEN l1 * w1 > l0 * w0 THEN tl1 ELSE 0 END + CASE WHEN r1 * w1 > r0 * w0 THEN tr1 ELSE 0 END AS tp,
    CASE WHEN l1 * w1 > l0 * w0 THEN tl0 ELSE 0 END + CASE WHEN r1 * w1 > r0 * w0 THEN tr0 ELSE 0 END AS fp,
    CASE WHEN l1 * w1 > l0 * w0 THEN 0 ELSE tl1 END + CASE WHEN r1 * w1 > r0 * w0 THEN 0 ELSE tr1 END AS fn FROM {name})"""  # noqa: E731
    return O.with_ctes(f"""SELECT p.variable AS mask, coalesce(x.fitness, CAST(0 AS DOUBLE)) AS fitness
FROM (VALUES {', '.join(f"('{p}')" for p in O.PRED)}) p(variable)
LEFT JOIN (SELECT variable, SUM({f1}) / {FOLDS} AS fitness FROM {scored('one')} q GROUP BY variable) x ON p.variable = x.variable
UNION ALL SELECT 'all', SUM({f1}) / {FOLDS} FROM {scored('every')} q""", f"""
t AS (SELECT *, {fold} AS fold, CAST({O.T} AS INTEGER) AS y FROM curated),
c AS (SELECT variable, value, fold, CAST(SUM(y) AS DOUBLE) AS n1, CAST(COUNT(*) - SUM(y) AS DOUBLE) AS n0
  FROM (UNPIVOT (SELECT fold, y, {', '.join(f'CAST({p} AS DOUBLE) AS {p}' for p in O.PRED)} FROM t) ON {', '.join(O.PRED)}
        INTO NAME variable VALUE value) GROUP BY variable, value, fold),
k AS (SELECT f, variable, value, {number} AS number, SUM(CASE WHEN fold <> f THEN n0 ELSE 0 END) AS n0, SUM(CASE WHEN fold <> f THEN n1 ELSE 0 END) AS n1,
  SUM(CASE WHEN fold = f THEN n0 ELSE 0 END) AS t0, SUM(CASE WHEN fold = f THEN n1 ELSE 0 END) AS t1
  FROM c, range({FOLDS}) r(f) GROUP BY f, variable, value),
u AS (SELECT f, variable, value, number, SUM(n0) OVER w AS l0, SUM(n1) OVER w AS l1, SUM(t0) OVER w AS tl0, SUM(t1) OVER w AS tl1,
  SUM(n0) OVER a AS a0, SUM(n1) OVER a AS a1, SUM(t0) OVER a AS ta0, SUM(t1) OVER a AS ta1
  FROM k WINDOW w AS (PARTITION BY f, variable ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY f, variable)),
v AS (SELECT *, a0 - l0 AS r0, a1 - l1 AS r1, ta0 - tl0 AS tr0, ta1 - tl1 AS tr1, (a0 + a1) / (2 * a0) AS w0, (a0 + a1) / (2 * a1) AS w1 FROM u),
s AS (SELECT *, {impure('a0', 'a1')} - ({size('l0', 'l1')} * {impure('l0', 'l1')} + {size('r0', 'r1')} * {impure('r0', 'r1')}) / {size('a0', 'a1')} AS gain
  FROM v WHERE l0 + l1 > 0 AND r0 + r1 > 0),{best('one', 'f, variable', 'gain DESC, value')},{best('every', 'f', 'gain DESC, number, value')}""")


@register("stump_fitness", _stump_sql())
def q_stump_fitness(spark, sf):
    """Fitness of every predictor alone, and of all, by trees of depth one over exact stratified folds."""
    folded = SP.stratified_folds(curated(spark, sf), S.target, FOLDS, order=[F.expr(SPLIT_BUCKET_SQL), S.id_col, *S.predictors])
    trees = CandidateTrees(folded, S.predictors, S.target, FOLDS, max_depth=1, fold_col="fold")
    n = len(S.predictors)
    masks = [[int(i == j) for j in range(n)] for i in range(n)] + [[1] * n]
    return spark.createDataFrame(list(zip([*S.predictors, "all"], trees(masks), strict=True)), "mask string, fitness double")


# -- the subset search by correlations ---------------------------------------------------

def _uniform_sql(*keys: str) -> str:
    return f"(CAST(('0x' || substr(md5(concat_ws('|', {', '.join(keys)})), 1, 8)) AS BIGINT) / CAST(4294967296 AS DOUBLE))"


def _search_ctes(generations: int, cfg: GA.SearchConfig = SEARCH) -> str:
    """Populations as rows (cand_id, i, g), generation by generation."""
    n, seed = len(O.PRED), cfg.seed
    number = "CASE variable " + " ".join(f"WHEN '{p}' THEN {i}" for i, p in enumerate(O.PRED)) + " END"
    pair_number = lambda c: f"CASE {c} " + " ".join(f"WHEN '{p}' THEN {i}" for i, p in enumerate(O.PRED)) + " END"
    pairs = [(a, b) for i, a in enumerate(O.PRED) for b in O.PRED[i + 1:]]
    matrix = ", ".join(f"round({O.safe_corr_sql(a, b)}, 10) AS r{i}" for i, (a, b) in enumerate(pairs))
    rows = O.union_from_row("m", [([a, b], [f"r{i}"]) for i, (a, b) in enumerate(pairs)], ["var_a", "var_b", "r"])
    whole = lambda c: f"coalesce(CAST(round(abs(round({c}, 4)) * 10000) AS BIGINT), 0)"
    fitness = lambda g: f"""
f{g} AS MATERIALIZED (SELECT k.cand_id, CASE WHEN k.size = 0 THEN CAST(0 AS DOUBLE)
    ELSE (k.size * k.told - coalesce(s.shared, 0)) / CAST(k.size AS DOUBLE) END AS fitness
  FROM (SELECT cand_id, SUM(g) AS size, SUM(g * w) AS told FROM p{g} JOIN rel ON p{g}.i = rel.i GROUP BY cand_id) k
  LEFT JOIN (SELECT a.cand_id, SUM(red.w) AS shared FROM p{g} a JOIN p{g} b ON a.cand_id = b.cand_id AND a.g = 1 AND b.g = 1
             JOIN red ON red.a = a.i AND red.b = b.i GROUP BY a.cand_id) s ON s.cand_id = k.cand_id)"""  # noqa: E731
    out = f"""{O.ctes()},
m AS MATERIALIZED (SELECT {matrix} FROM clean),
rel AS MATERIALIZED (SELECT {number} AS i, {whole('correlation')} AS w FROM ({O.corr_target_sql()}) c),
red AS MATERIALIZED (SELECT {pair_number('var_a')} AS a, {pair_number('var_b')} AS b, {whole('r')} AS w FROM ({rows}) x),
p0 AS MATERIALIZED (SELECT c AS cand_id, i, CASE WHEN {_uniform_sql(str(seed), '0', 'c', 'i')} < 0.5 THEN 1 ELSE 0 END AS g
  FROM range({cfg.size}) c(c), range({n}) i(i)),{fitness(0)}"""
    for g in range(1, generations + 1):
        swap = f"{_uniform_sql(str(seed), str(g), '1', 'a.r // 2', 'a.i')} <= {cfg.gamma}"
        flip = f"{_uniform_sql(str(seed), str(g), '2', 'cand_id', 'i')} <= {cfg.mutation}"
        out += f""",
t{g} AS MATERIALIZED (SELECT r, i, g FROM p{g - 1} JOIN (SELECT cand_id, row_number() OVER (ORDER BY fitness DESC, cand_id) - 1 AS r
  FROM f{g - 1}) USING (cand_id) WHERE r < {cfg.keep}),
x{g} AS MATERIALIZED (SELECT r AS cand_id, i, g FROM t{g} UNION ALL
  SELECT a.r + (SELECT COUNT(DISTINCT r) FROM t{g}), a.i, CASE WHEN b.g IS NOT NULL AND {swap} THEN b.g ELSE a.g END
  FROM t{g} a LEFT JOIN t{g} b ON a.i = b.i AND b.r = CASE WHEN a.r % 2 = 0 THEN a.r + 1 ELSE a.r - 1 END),
p{g} AS MATERIALIZED (SELECT cand_id, i, CASE WHEN {flip} THEN 1 - g ELSE g END AS g FROM x{g}),{fitness(g)}"""
    return out


_GENES = "string_agg(CAST(g AS VARCHAR), '' ORDER BY i)"


def _merit(spark, sf):
    return GA.MeritScorer(clean(spark, sf), S.predictors, S.target)


@register("search_generation", f"""WITH {_search_ctes(1)}
SELECT 'initial' AS stage, cand_id, {_GENES} AS genes, ANY_VALUE(fitness) AS fitness FROM p0 JOIN f0 USING (cand_id) GROUP BY cand_id
UNION ALL SELECT 'selected', r, {_GENES}, NULL FROM t1 GROUP BY r
UNION ALL SELECT 'crossed', cand_id, {_GENES}, NULL FROM x1 GROUP BY cand_id
UNION ALL SELECT 'mutated', cand_id, {_GENES}, ANY_VALUE(fitness) FROM p1 JOIN f1 USING (cand_id) GROUP BY cand_id""")
def q_search_generation(spark, sf):
    """Initial population, selection, crossover and mutation of one generation, with the filter fitness."""
    n, score = len(S.predictors), _merit(spark, sf)
    start = GA.scored(spark, GA.initial_population(spark, SEARCH.size, n, SEARCH.seed), score)
    top = GA.select_top(start, SEARCH.keep)
    crossed = GA.crossover(top, n, SEARCH.gamma, SEARCH.seed, 1)
    mutated = GA.scored(spark, GA.mutate(crossed, SEARCH.mutation, SEARCH.seed, 1), score)
    stages = [("initial", start), ("selected", top.select(F.col("rank").cast("bigint").alias("cand_id"), "genes")),
              ("crossed", crossed), ("mutated", mutated)]
    out = [df.select(F.lit(name).alias("stage"), "cand_id", F.array_join(F.transform("genes", lambda g: g.cast("string")), "").alias("genes"),
                     (F.col("fitness") if "fitness" in df.columns else F.lit(None).cast("double")).alias("fitness"))
           for name, df in stages]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@register("filter_search_history", f"WITH {_search_ctes(SEARCH.generations)}\n" + "\nUNION ALL ".join(
    f"SELECT {g} AS generation, MAX(fitness) AS best, round(AVG(fitness), 6) AS mean FROM f{g}"
    for g in range(1, SEARCH.generations + 1)))
def q_filter_search_history(spark, sf):
    """Ten generations of 100 candidates: best and mean fitness of each."""
    _, history, _ = GA.search(clean(spark, sf), S.predictors, S.target, SEARCH, score=_merit(spark, sf))
    return history.select("generation", "best", F.round("mean", 6).alias("mean"))


@register("filter_search_last", f"""WITH {_search_ctes(SEARCH.generations)}
SELECT cand_id, fitness, coalesce(string_agg(CASE WHEN g = 1 THEN name END, ',' ORDER BY i), '') AS selected
FROM p{SEARCH.generations} JOIN f{SEARCH.generations} USING (cand_id)
JOIN (VALUES {", ".join(f"({i}, '{p}')" for i, p in enumerate(O.PRED))}) names(i, name) USING (i) GROUP BY cand_id, fitness""")
def q_filter_search_last(spark, sf):
    """The last population's fitness and chosen predictors."""
    _, _, final = GA.search(clean(spark, sf), S.predictors, S.target, SEARCH, score=_merit(spark, sf))
    return final.select("cand_id", "fitness", F.array_join("selected", ",").alias("selected"))
