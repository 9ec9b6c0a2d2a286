"""Fitness of many feature subsets at once: all their decision trees grow together, level by level.

A candidate is a mask over the predictors; its fitness is the mean positive-class F1 of a
class-balanced Gini tree over k folds. Fitting each (mask, fold) tree on its own reads the table for
every level of every tree. Here a *node* is the path of conditions that leads to it, whichever tree
it belongs to, and one job counts rows for all new nodes of a level: by fold, predictor, value
and label. Those counts hold everything a tree needs:

* the training side of a fold is the total less the fold, so folds share a node;
* masks whose trees begin alike share nodes, and counts are kept between generations;
* the best split of a node, and what the held-out fold has in each leaf, are read off the counts, so
  nothing is predicted row by row.

A generation is one job a level. The table holds small codes, equal rows once with their number; the codes of
a row are digits of one or a few whole numbers. Predictors share *packs* of at most ``PACK`` joint values: a row adds one count
per pack, and counts of single predictors are sums over a pack. Of two sides of a split the one with
fewer rows is counted, the other one is the node above less it. A task adds up one array per node and sends it once;
arrays of a node are added before the driver sees them. What reaches the driver is bounded by
the search (nodes x folds x values), not by the data.

Rows with a null or NaN predictor or label are left out. Whole-number predictors of a span up to ``max_bins`` keep all their values; others are cut at
quantiles. Splits and ties follow Spark ML's tree: largest weighted Gini gain over 0, at least one row a
side, the smallest predictor and value on ties, and class 0 on even leaves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .profile import coded_columns
from .rank import stored
from .split import hash_folds, stratified_folds

MAX_BINS = 256
CHUNK_ROWS = 1 << 18            # rows of a task that are counted at once
NODES_PER_JOB = 4096
KEPT_DEPTH = 2                  # nodes up to this depth stay known between generations
PACK = 256                      # joint values of the predictors of a pack, unless one has more by itself
WORD = 1 << 62                  # the packs of a word have fewer joint values
Path = tuple[tuple[int, int, int], ...]        # (predictor, code, side): side 0 holds codes up to it, 1 the rest


class Layout:
    """Where the codes of a row are: word ``word[g]`` holds pack g at ``place[g]``, which holds its predictors' codes."""

    def __init__(self, sizes: Sequence[int], folds: int):
        self.sizes, self.cell = [int(s) for s in sizes], 2 * folds
        self.first_bin = np.concatenate(([0], np.cumsum(self.sizes)))[:-1].astype(np.int64)
        self.packs: list[list[int]] = []
        self.joint: list[int] = []
        for p in sorted(range(len(self.sizes)), key=lambda p: (-self.sizes[p], p)):
            g = next((g for g, joint in enumerate(self.joint) if joint * self.sizes[p] <= PACK), len(self.packs))
            if g == len(self.packs):
                self.packs.append([])
                self.joint.append(1)
            self.packs[g].append(p)
            self.joint[g] *= self.sizes[p]
        self.pack_of = {p: g for g, members in enumerate(self.packs) for p in members}
        self.word, self.place, held = [], [], WORD
        for joint in self.joint:
            if held * joint >= WORD:
                held, number = 1, len(set(self.word))
            self.word.append(number)
            self.place.append(held)
            held *= joint
        self.words = len(set(self.word))
        # of each pack: where its predictors' bins are, and which joint values each bin adds up
        self.bins = [np.concatenate([self.first_bin[p] + np.arange(self.sizes[p]) for p in members]) for members in self.packs]
        self.sums = [np.concatenate([(self.code(p, np.arange(self.joint[g]))[None, :] == np.arange(self.sizes[p])[:, None])
                                     for p in members]).astype(np.float64) for g, members in enumerate(self.packs)]

    def _below(self, p: int) -> int:
        members = self.packs[self.pack_of[p]]
        return math.prod(self.sizes[q] for q in members[:members.index(p)])

    def code(self, p: int, joint: np.ndarray) -> np.ndarray:
        """The code of a predictor in joint values of its pack."""
        return joint // self._below(p) % self.sizes[p]

    def columns(self, code) -> list:
        """The words of a row; ``code(p)`` is the column of a predictor's code."""
        out: list = [F.lit(0).cast("long")] * self.words
        for p, g in self.pack_of.items():
            out[self.word[g]] = out[self.word[g]] + code(p).cast("long") * F.lit(self.place[g] * self._below(p)).cast("long")
        return out


def _count_nodes(paths: list[Path], wanted: list[np.ndarray], layout: Layout):
    """Counts of each path's rows as int64 arrays over (bins of its wanted packs' predictors, fold, label)."""
    order = sorted(range(len(paths)), key=paths.__getitem__)
    split_by = sorted({predictor for path in paths for predictor, _, _ in path})
    counted = sorted({int(g) for packs in wanted for g in packs})
    shape = (sum(layout.sizes), layout.cell)

    def count(batches) -> Iterator[pa.RecordBatch]:
        totals: list[np.ndarray | None] = [None] * len(paths)

        def add(table: pa.Table) -> None:
            words = [table.column(i).to_numpy() for i in range(layout.words)]
            cell, n = table["cell"].to_numpy().astype(np.int64), table["n"].to_numpy()
            n = None if (n == 1).all() else n.astype(np.float64)
            joint = lambda g: words[layout.word[g]] // layout.place[g] % layout.joint[g]
            index = {g: joint(g) * layout.cell + cell for g in counted}
            codes = {p: layout.code(p, joint(layout.pack_of[p])).astype(np.uint8 if layout.sizes[p] <= 256 else np.int32)
                     for p in split_by}
            del words
            stack: list[tuple[tuple, np.ndarray]] = [((), np.arange(len(cell)))]     # the prefix of the last path
            for node in order:
                path = paths[node]
                depth = 0
                while depth < min(len(path), len(stack) - 1) and stack[depth + 1][0] == path[depth]:
                    depth += 1
                del stack[depth + 1:]
                for condition in path[depth:]:
                    predictor, code, side = condition
                    rows = stack[-1][1]
                    over = codes[predictor][rows] > code
                    stack.append((condition, rows[over if side else ~over]))
                rows = stack[-1][1]
                if not len(rows):
                    continue
                weights = None if n is None else n[rows]
                if totals[node] is None:
                    totals[node] = np.zeros(shape, dtype=np.int64)
                for g in wanted[node]:
                    found = np.bincount(index[g][rows], weights, minlength=layout.joint[g] * layout.cell)
                    totals[node][layout.bins[g]] += np.rint(layout.sums[g] @ found.reshape(-1, layout.cell)).astype(np.int64)

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= CHUNK_ROWS:
                add(pa.Table.from_batches(held))
                held, size = [], 0
        if size:
            add(pa.Table.from_batches(held))
        for lo in range(0, len(paths), 256):
            part = [i for i in range(lo, min(lo + 256, len(paths))) if totals[i] is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), pa.array([totals[i].astype("<i8").tobytes() for i in part], pa.binary())],
                ["node", "counts"])
    return count


def _added(key: tuple, group: pa.Table) -> pa.Table:
    total = None
    for raw in group["counts"]:
        part = np.frombuffer(raw.as_buffer(), "<i8")
        total = part.copy() if total is None else total + part
    return pa.table({"node": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})


class CandidateTrees:
    """A table prepared for the search; calling it with masks gives their fitness.

    ``fold_col`` names folds 0 .. folds - 1 that the table has already; otherwise they are made by ``fold_method``.
    """

    def __init__(self, df: DataFrame, predictors: Sequence[str], label: str, folds: int = 3, max_depth: int = 5,
                 seed: int = 42, fold_method: str = "stratified", max_bins: int = MAX_BINS, fold_col: str | None = None):
        self.predictors, self.folds, self.max_depth = list(predictors), folds, max_depth
        own = [F.col(fold_col).cast("int").alias("fold")] if fold_col else []
        base = df.select(*[F.col(p).cast("double").alias(p) for p in self.predictors], F.col(label).cast("double").alias("label"), *own)
        base = base.filter(F.forall(F.array(*self.predictors, "label"), lambda x: x.isNotNull() & ~F.isnan(x)))
        self.edges = self._edges(base, max_bins)
        self.layout = Layout([len(e) + 1 for e in self.edges], folds)
        self.sizes, self.first_bin = np.array(self.layout.sizes, dtype=np.int64), self.layout.first_bin
        self.cells = int(self.sizes.sum())
        words = [f"w{i}" for i in range(self.layout.words)]
        packed = [c.alias(w) for w, c in zip(words, self.layout.columns(self._code), strict=True)]
        label_of = F.col("label").cast("int").alias("label")
        if fold_col:
            folded = base.select(*packed, label_of, "fold")
        elif fold_method == "hash":
            folded = hash_folds(base, folds, seed, keys=[*self.predictors, "label"]).select(*packed, label_of, "fold")
        else:                                            # only words, label and hash are sorted
            hashed = F.xxhash64(F.lit(seed), *self.predictors, "label").alias("_hash")
            folded = stratified_folds(base.select(*packed, label_of, hashed), "label", folds, order=["_hash"])
        cell = (F.col("fold").cast("int") * 2 + F.col("label")).alias("cell")
        equal = folded.select(*words, cell).groupBy(*words, "cell").agg(F.count(F.lit(1)).alias("n"))
        # as many files as keep all cores at work; a task takes its rows in chunks
        files = max(8, 2 * df.sparkSession.sparkContext.defaultParallelism)
        self.data = stored(equal.repartition(files), "search-data")
        self.known: dict[Path, tuple[np.ndarray, np.ndarray]] = {}       # counts (bin, fold, label), packs counted
        root, _ = self.counted({(): np.arange(len(self.predictors))})[()]
        of_fold = root[: int(self.sizes[0])].sum(axis=0)
        train = of_fold.sum(axis=0)[None, :] - of_fold                   # (fold, label)
        if (train == 0).any():
            raise ValueError(f"the training side of a fold lacks a class: {train.tolist()}")
        self.weights = train.sum(axis=1, keepdims=True) / (2.0 * train)  # balanced on the training side
        self.scores: dict[tuple[int, ...], float] = {}

    def _edges(self, base: DataFrame, max_bins: int) -> list[list[float]]:
        """Cut points of each predictor: a code is the number of cut points under the value."""
        whole = coded_columns(base, self.predictors, max_bins)
        row = base.agg(*[F.min(p).alias(f"lo{i}") if p in whole else
                           F.percentile_approx(p, [j / (max_bins - 1) for j in range(1, max_bins - 1)], 100 * max_bins).alias(f"q{i}")
                           for i, p in enumerate(self.predictors)],
                         *[F.max(p).alias(f"hi{i}") for i, p in enumerate(self.predictors)]).first()
        edges = []
        for i, p in enumerate(self.predictors):
            top = row[f"hi{i}"]
            if p in whole:
                lo = row[f"lo{i}"]
                edges.append([lo + j for j in range(int((top if top is not None else 0) - (lo or 0)))] if lo is not None else [])
            else:
                edges.append(sorted({v for v in row[f"q{i}"] or [] if v < top}))
        return edges

    def _code(self, i: int):
        edges = self.edges[i]
        value = F.col(self.predictors[i])
        if not edges:
            return F.lit(0).cast("short")
        if edges == [edges[0] + j for j in range(len(edges))]:           # whole numbers: no look-up
            return (F.coalesce(value, F.lit(edges[0])) - F.lit(edges[0])).cast("short")
        bound = F.array(*[F.lit(e) for e in edges])
        return F.size(F.filter(bound, lambda e: e < value)).cast("short")

    # ------------------------------------------------------------ counts

    def counted(self, wanted: dict[Path, np.ndarray]) -> dict[Path, tuple[np.ndarray, np.ndarray]]:
        """Counts of every path for at least the predictors it names; one job for those not known."""
        direct: dict[Path, np.ndarray] = {}                              # packs to count
        derived: list[tuple[Path, Path, np.ndarray]] = []                # path, its other side, packs
        for path, predictors in wanted.items():
            packs = np.unique([self.layout.pack_of[int(p)] for p in predictors])
            have = self.known.get(path)
            if have is not None:
                if np.isin(packs, have[1]).all():
                    continue
                packs = np.union1d(have[1], packs)
            above = self.known.get(path[:-1]) if path else None
            if above is not None and np.isin(packs, above[1]).all():
                predictor, code, side = path[-1]
                start = self.first_bin[predictor]
                of_side = above[0][start:start + code + 1].sum(), above[0][start + code + 1:start + self.sizes[predictor]].sum()
                if of_side[side] > of_side[1 - side]:
                    other = (*path[:-1], (predictor, code, 1 - side))
                    derived.append((path, other, packs))
                    path = other
                    have = self.known.get(path)
                    if have is not None and np.isin(packs, have[1]).all():
                        continue
                    packs = packs if have is None else np.union1d(have[1], packs)
            direct[path] = np.union1d(direct[path], packs) if path in direct else packs
        new = list(direct.items())
        shape = (self.cells, self.folds, 2)
        for at in range(0, len(new), NODES_PER_JOB):
            part = new[at:at + NODES_PER_JOB]
            found = (self.data.mapInArrow(_count_nodes([p for p, _ in part], [w for _, w in part], self.layout),
                                          "node int, counts binary")
                     .groupBy("node").applyInArrow(_added, "node int, counts binary").collect())
            arrays = {r["node"]: np.frombuffer(bytes(r["counts"]), "<i8").reshape(shape) for r in found}
            for i, (path, packs) in enumerate(part):
                self.known[path] = arrays.get(i, np.zeros(shape, np.int64)), packs
        for path, other, packs in derived:
            self.known[path] = self.known[path[:-1]][0] - self.known[other][0], packs
        return {path: self.known[path] for path in wanted}

    # ------------------------------------------------------------ trees

    def _best_split(self, counts: np.ndarray, fold: int, predictors: np.ndarray):
        """(predictor, code) of the largest weighted Gini gain on the training side, or None."""
        train = (counts.sum(axis=1) - counts[:, fold]).astype(np.float64)            # (bin, label)
        rows = np.concatenate([np.arange(self.first_bin[p], self.first_bin[p] + self.sizes[p]) for p in predictors])
        owner = np.repeat(predictors, self.sizes[predictors])
        code = rows - self.first_bin[owner]
        sums = np.cumsum(train[rows], axis=0)
        starts = np.flatnonzero(code == 0)
        before = np.concatenate((np.zeros((1, 2)), sums))[starts]
        left = sums - np.repeat(before, self.sizes[predictors], axis=0)
        total = left[starts[0] + self.sizes[predictors[0]] - 1]
        right = total[None, :] - left
        w = self.weights[fold]

        def impure(x: np.ndarray):
            weighted = x * w
            size = weighted.sum(axis=-1)
            share = np.divide(weighted, size[..., None], out=np.zeros_like(weighted), where=size[..., None] > 0)
            return 1.0 - (share * share).sum(axis=-1), size

        whole, size = impure(total[None, :])
        if size[0] <= 0:
            return None
        (gl, nl), (gr, nr) = impure(left), impure(right)
        gain = whole[0] - (nl * gl + nr * gr) / size[0]
        gain[(left.sum(axis=1) < 1) | (right.sum(axis=1) < 1)] = -1.0
        best = int(gain.argmax())
        return (int(owner[best]), int(code[best])) if gain[best] > 0 else None

    def __call__(self, genes_list: Sequence[Sequence[int]]) -> list[float]:
        masks = [tuple(int(g) for g in genes) for genes in genes_list]
        trees = [(mask, fold) for mask in dict.fromkeys(masks) if any(mask) and mask not in self.scores
                 for fold in range(self.folds)]
        hits = {tree: np.zeros(3) for tree in trees}                     # tp, fp, fn of the held-out fold
        chosen = {mask: np.flatnonzero(mask) for mask, _ in trees}
        level = [(tree, ()) for tree in trees]                           # open nodes
        for depth in range(self.max_depth):
            wanted: dict[Path, np.ndarray] = {}
            for (mask, _), path in level:
                wanted[path] = np.union1d(wanted[path], chosen[mask]) if path in wanted else chosen[mask]
            counts = self.counted(wanted)
            below = []
            for tree, path in level:
                mask, fold = tree
                here, _ = counts[path]
                split = self._best_split(here, fold, chosen[mask])
                if split is None:
                    one = chosen[mask][0]
                    self._leaf(hits[tree], here[self.first_bin[one]:self.first_bin[one] + self.sizes[one]].sum(axis=0), fold)
                    continue
                predictor, code = split
                start = self.first_bin[predictor]
                sides = (here[start:start + code + 1].sum(axis=0), here[start + code + 1:start + self.sizes[predictor]].sum(axis=0))
                for side, inside in enumerate(sides):
                    train = inside.sum(axis=0) - inside[fold]
                    if depth + 1 == self.max_depth or not train.all():   # deep enough, or of one class
                        self._leaf(hits[tree], inside, fold)
                    else:
                        below.append((tree, (*path, (predictor, code, side))))
            level = below
        f1: dict[tuple[int, ...], list[float]] = {}
        for (mask, _), (tp, fp, fn) in hits.items():
            f1.setdefault(mask, []).append(2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0.0)
        # the deep nodes of one generation are seldom met again
        self.known = {path: x for path, x in self.known.items() if len(path) <= KEPT_DEPTH}
        self.scores |= {mask: float(sum(x) / len(x)) for mask, x in f1.items()}
        return [self.scores[mask] if any(mask) else 0.0 for mask in masks]

    def _leaf(self, hits: np.ndarray, inside: np.ndarray, fold: int) -> None:
        """Add the held-out rows of a leaf; ``inside`` counts (fold, label)."""
        train = (inside.sum(axis=0) - inside[fold]) * self.weights[fold]
        negative, positive = inside[fold]
        if train[1] > train[0]:
            hits += (positive, negative, 0)
        else:
            hits += (0, 0, positive)
