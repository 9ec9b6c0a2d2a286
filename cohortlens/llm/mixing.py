"""Mix sources to target weights, in fixed-length blocks of words.

Method: the words of each source, its documents end to end, are cut into blocks
of ``block_words``. The mix is a number of slots per source, dealt over output
shards: a shard's source counts are a multinomial draw, conditional on the
quotas of all shards adding up to the sources' targets (the halves of a binary
tree over the shards are drawn hypergeometrically, each node from its own seed,
so any task can work out any shard by itself and a rerun draws the same). The
slots of a source are numbered through the shards; slot j takes the block at
place j mod (number of blocks) of the source's pseudorandom permutation for
that pass, a keyed Feistel network. So a block is taken floor or ceiling of
quota / blocks times. Blocks then meet documents in a join by block index.

Places in a source's stream are two-level prefix sums: within hashed groups of
documents, then over the groups, so a source with a third of all rows is many
groups. Equal rows are one entry with a number of copies, and groups go by id and
text, so an id or a null id with a third of all rows is many groups too.

Targets: sources by code point, null last, have the weights 5, 2, 1, repeating,
and share ``share`` times all words; a target stops at ``most`` times its
source's words and the excess is shared again by weight. One row per source
reaches the driver.

Defined results: a null or empty text has size 0 and takes 0; a null source is a
source of its own; every row is a document of its own, also when ids repeat or
are null; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .graph import stored
from .text import fresh, mix

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
BLOCK_WORDS = 128
SHARD_SLOTS = 512
GROUP_ROWS = 20_000
MIN_GROUPS = 64
RUNS = "_runs of the mix"
SPREAD = 12                     # standard deviations of a large draw that are worked out
_NUMPY_URN = 10**9              # numpy draws from smaller urns


def targets(sizes: list[int], weights: list[float], share: float, most: float) -> list[float]:
    """Words wanted of each source: ``share`` of all by weight, none above ``most`` times its size."""
    left, active, out = share * sum(sizes), [i for i, n in enumerate(sizes) if n > 0], [0.0] * len(sizes)
    while active:
        unit = left / sum(weights[i] for i in active)
        above = [i for i in active if unit * weights[i] > most * sizes[i]]
        if not above:
            for i in active:
                out[i] = unit * weights[i]
            break
        for i in above:
            out[i] = float(most * sizes[i])
            left -= out[i]
        active = [i for i in active if i not in set(above)]
    return out


def hypergeometric(good: int, bad: int, draws: int, rng: np.random.Generator) -> int:
    """How many of ``draws`` balls, drawn without putting back, are of the ``good`` ones.

    numpy draws from urns of under 10^9. For a larger one the probabilities around the mode are worked out
    from the ratios of neighbours, as far as ``SPREAD`` standard deviations, beyond which less than
    10^-30 is left, and one uniform number picks the count; its length grows with the root of the draws.
    """
    total = good + bad
    if total < _NUMPY_URN:
        return int(rng.hypergeometric(good, bad, draws)) if draws else 0
    lowest, highest = max(0, draws - bad), min(good, draws)
    mode = min(max(((draws + 1) * (good + 1)) // (total + 2), lowest), highest)
    deviation = math.sqrt(max(draws * (good / total) * (bad / total) * ((total - draws) / max(total - 1, 1)), 1.0))
    reach = math.ceil(SPREAD * deviation) + 2
    lo, hi = max(lowest, mode - reach), min(highest, mode + reach)
    k = np.arange(lo, hi, dtype=np.float64)               # ratio of the chance of k + 1 to that of k
    step = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(bad - draws + k + 1)
    log_chance = np.concatenate(([0.0], np.cumsum(step)))
    total_chance = np.cumsum(np.exp(log_chance - log_chance.max()))
    return lo + int(np.searchsorted(total_chance, rng.random() * total_chance[-1], side="right"))


def split_counts(counts: np.ndarray, draws: int, seed: tuple[int, ...]) -> np.ndarray:
    """How many of ``draws`` slots each source gets out of its remaining counts, source by source."""
    rng = np.random.default_rng(seed)
    if int(counts.sum()) < _NUMPY_URN:
        return rng.multivariate_hypergeometric(counts, draws, method="marginals")
    out, rest = np.zeros_like(counts), int(counts.sum())
    for i, n in enumerate(counts.tolist()):
        rest -= n
        out[i] = hypergeometric(n, rest, draws, rng)
        draws -= int(out[i])
    return out


def shard_counts(quotas: np.ndarray, shard_slots: int, seed: int, lo: int, hi: int):
    """(shard, first slot of each source, count of each source) for shards lo .. hi - 1."""
    total = int(quotas.sum())
    slots = lambda a, b: min(b * shard_slots, total) - min(a * shard_slots, total)
    todo = [(0, max(1, math.ceil(total / shard_slots)), np.zeros_like(quotas), quotas)]
    while todo:
        a, b, first, counts = todo.pop()
        if b <= lo or a >= hi:
            continue
        if b - a == 1:
            yield a, first, counts
            continue
        middle = (a + b) // 2
        left = split_counts(counts, slots(a, middle), (seed, a, b))
        todo.append((middle, b, first + left, counts - left))
        todo.append((a, middle, first, left))


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Place of each index under the key's permutation of 0 .. size - 1 (Feistel, cycle-walking)."""
    half = np.maximum(1, np.ceil(np.log2(np.maximum(size, 2)) / 2)).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        x, h, m, k = out[todo], half[todo], mask[todo], key[todo]
        left, right = x >> h, x & m
        for turn in range(4):
            left, right = right, left ^ (mix(right + k + np.uint64(turn * 0x51ED27)) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= size[todo].astype(np.uint64)]
    return out.astype(np.int64)


def _slots(quotas: list[int], blocks: list[int], shard_slots: int, seed: int):
    quota, block = np.array(quotas, dtype=np.int64), np.array(blocks, dtype=np.int64)

    def slots(batches):
        for batch in batches:
            shards = batch.column("id").to_numpy()
            for shard, first, counts in shard_counts(quota, shard_slots, seed, int(shards.min()), int(shards.max()) + 1):
                source = np.repeat(np.arange(len(quota)), counts)
                number = np.concatenate([np.arange(f, f + c) for f, c in zip(first, counts, strict=True)])
                turn, index = np.divmod(number, block[source])
                key = mix(mix(source.astype(np.uint64) + np.uint64(seed)) + turn.astype(np.uint64))
                place = permuted(index, block[source], key)
                order = np.random.default_rng((seed, 1, shard)).permutation(len(source))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(source), shard), pa.int64()), pa.array(np.arange(len(source)), pa.int32()),
                     pa.array(source[order], pa.int32()), pa.array(place[order], pa.int64())],
                    ["shard", "slot", "source_no", "block"])
    return slots


class Mix:
    """The mix of ``docs``: ``documents()``, ``slots``, ``texts()``."""

    def __init__(self, docs: DataFrame, share: float = 1.5, most: float = 2.0, block_words: int = BLOCK_WORDS,
                 shard_slots: int = SHARD_SLOTS, seed: int = 7):
        spark = docs.sparkSession
        self._docs = docs
        # equal rows are one entry with a number of copies, so no group holds many rows of one id
        each = docs.select("doc_id", "source", word_count("text").alias("size"),
                           F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
        entries = stored(each.groupBy("doc_id", "source", "size", "text_hash").agg(F.count(F.lit(1)).alias("copies")), "sized")
        rows = entries.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("n"),
                                             F.count(F.lit(1)).alias("rows")).collect()
        rows.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
        sizes = [int(r["n"]) for r in rows]
        wanted = targets(sizes, [WEIGHTS[i % len(WEIGHTS)] for i in range(len(rows))], share, most)
        blocks = [-(-n // block_words) for n in sizes]
        quotas = [min(round(w / n * b), math.floor(most * b)) if n else 0
                  for w, n, b in zip(wanted, sizes, blocks, strict=True)]
        sources = spark.createDataFrame(
            [(r["source"], i, sizes[i], wanted[i]) for i, r in enumerate(rows)],
            T.StructType([T.StructField("_source", T.StringType()), T.StructField("source_no", T.IntegerType()),
                          T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType())]))

        groups = max(MIN_GROUPS, sum(r["rows"] for r in rows) // GROUP_ROWS)
        known = (entries.join(sources, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
                 .withColumn("grp", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(groups)).cast("int"))
                 .withColumn("words", F.col("size") * F.col("copies")))
        inside = Window.partitionBy("source_no", "grp").orderBy("doc_id", "size", "text_hash")
        local = known.withColumn("entry", F.row_number().over(inside)).withColumn(
            "before", F.sum("words").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("words"))
        over_groups = Window.partitionBy("source_no").orderBy("grp")
        bases = (known.groupBy("source_no", "grp").agg(F.sum("words").alias("n"))
                 .withColumn("base", F.sum("n").over(over_groups.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
                 .drop("n"))
        every = local.join(bases, ["source_no", "grp"]).withColumn(
            "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        self._placed = stored(every.select(
            "doc_id", "source", "size", "text_hash", "copy", "source_no", "source_size", "target", "grp", "entry",
            (F.col("before") + F.col("base") + (F.col("copy") - 1) * F.col("size")).alias("start")), "placed")
        n_shards = -(-sum(quotas) // shard_slots)
        parts = max(1, min(n_shards, -(-n_shards // 64)))
        self.slots = spark.range(0, n_shards, 1, parts).mapInArrow(
            _slots(quotas, blocks, shard_slots, seed), "shard long, slot int, source_no int, block long")
        self._block_words = block_words

    def _spans(self) -> DataFrame:
        """Each document's part of each block it touches, with the times the mix takes the block."""
        n = self._block_words
        touched = (self._placed.filter("size > 0")
                   .select("source_no", "grp", "entry", "copy", "start", "size", F.explode(F.sequence(
                       F.floor(F.col("start") / n), F.floor((F.col("start") + F.col("size") - 1) / n))).alias("block"))
                   .select("source_no", "grp", "entry", "copy", "block",
                           F.greatest(F.col("block") * n - F.col("start"), F.lit(0)).alias("lo"),
                           F.least((F.col("block") + 1) * n - F.col("start"), F.col("size")).alias("hi")))
        taken = self.slots.groupBy("source_no", "block").agg(F.count(F.lit(1)).alias("times"))
        # the planner takes the slots for as few as their shards, and would broadcast them
        return touched.hint("merge").join(taken.hint("merge"), ["source_no", "block"])

    def documents(self) -> DataFrame:
        """doc_id, size, source_size, target, taken."""
        words = self._spans().groupBy("source_no", "grp", "entry", "copy").agg(
            F.sum((F.col("hi") - F.col("lo")) * F.col("times")).alias("taken"))
        return self._placed.join(words, ["source_no", "grp", "entry", "copy"], "left").select(
            "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))

    def texts(self) -> DataFrame:
        """The documents that the mix takes words of, in the columns of ``docs``, ``text``
        being those words: the taken runs in order, then those taken again."""
        runs = self._spans().groupBy("source_no", "grp", "entry", "copy").agg(
            F.sort_array(F.collect_list(F.struct("lo", "hi", "times"))).alias("_runs"))
        # equal rows are told apart by their number among them
        copy, text_hash, key, from_source, taken_hash, taken_copy = fresh(
            self._docs, "_copy", "_hash", "_id", "_source", "_taken_hash", "_taken_copy")
        taken = (self._placed.join(runs, ["source_no", "grp", "entry", "copy"])
                 .select(F.col("doc_id").alias(key), F.col("source").alias(from_source), F.col("text_hash").alias(taken_hash),
                         F.col("copy").alias(taken_copy), F.col("_runs").alias(RUNS)))
        hashed = self._docs.withColumn(text_hash, F.xxhash64(F.coalesce("text", F.lit(""))))
        among = F.row_number().over(Window.partitionBy("doc_id", "source", text_hash).orderBy(text_hash)).cast("long")
        joined = hashed.withColumn(copy, among).join(
            taken, F.col("doc_id").eqNullSafe(F.col(key)) & F.col("source").eqNullSafe(F.col(from_source))
            & (F.col(text_hash) == F.col(taken_hash)) & (F.col(copy) == F.col(taken_copy))).select(*self._docs.columns, RUNS)
        return joined.mapInArrow(_take_runs, self._docs.schema)


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def taken_text(text: str, runs: list[tuple[int, int, int]]) -> str:
    """Words lo .. hi - 1 of ``text`` for each run, its first pass and then its repeats."""
    raw = text.encode()
    starts, ends = word_bounds(raw)
    parts = []
    for turn in range(1, max((t for _, _, t in runs), default=0) + 1):
        joined: list[list[int]] = []
        for lo, hi, times in runs:
            if times >= turn:
                if joined and joined[-1][1] == lo:
                    joined[-1][1] = hi
                else:
                    joined.append([lo, hi])
        parts += [raw[starts[lo]:ends[hi - 1]] for lo, hi in joined]
    return b"\n".join(parts).decode()


def word_bounds(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    space = np.isin(np.frombuffer(raw + b" ", dtype=np.uint8), np.frombuffer(b" \t\n\x0b\x0c\r", dtype=np.uint8))
    edges = np.diff(np.concatenate(([True], space)).astype(np.int8))
    return np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)


def _take_runs(batches):
    for batch in batches:
        runs = batch.column(RUNS).to_pylist()
        texts = [taken_text(t, [(r["lo"], r["hi"], r["times"]) for r in of]) for t, of in zip(
            batch.column("text").to_pylist(), runs, strict=True)]
        names = [n for n in batch.schema.names if n != RUNS]
        yield pa.RecordBatch.from_arrays(
            [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names], names)
