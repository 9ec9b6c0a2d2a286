"""Approximate nearest neighbours: an NN-descent graph and greedy search on it.

Method: every distinct vector is a node with its ``degree`` nearest known nodes.
The graph starts from random pivots: a node meets the nodes of its nearest
pivot's cell, for several sets of pivots. A cell with too many nodes is divided by
further pivots drawn from its own, level by level, so near nodes stay together and
every vector is indexed; only nodes that no pivot tells apart (all alike in single
precision) are divided by hash. Then NN-descent
rounds join neighbours of neighbours: each node gathers a sample of its
neighbours and of the nodes that list it, the members' vectors meet at that
node, and every member learns of closer ones. Rounds go on until one changes less
than the share ``settled`` of all list entries. A query is a node; its greedy
search starts there and expands the best unexpanded nodes in hops, along the lists and to
the nodes that list them. It goes on for
as long as hops find nodes among its best ``k``, and stops after ``PATIENCE`` hops
in a row that found none; other queries do not matter to it.

Nodes live in hashed blocks, messages between blocks are packed rows, so each
step is a Spark shuffle by block and numpy inside a block. In the search, a query is one
packed row of the nodes it has measured; a hop asks the blocks of its best open
nodes for neighbours, then the blocks of those it has not measured for distances.
A member learns of ``learn`` others where it meets them, and ``members`` at most meet at one
node in a round: which ones changes from round to round.

Measure: Euclidean distance in double precision on the original vectors; ties
go to the smaller id. Copies of one vector are one node that keeps its smallest
ids, one more than a result can hold, so equal distances lose nothing.

Defined results: vectors that are null, zero, hold null or non-finite components,
have a null id or another length than the most frequent one (the smaller, on a
tie) take no part; of rows with one id the first in vector order takes part; with fewer than ``k`` others all
are returned; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .graph import stored
from .text import mix, ranges

DEGREE = 32                     # neighbours kept of a node
PIVOT_SETS = 8
CELL_ROWS = 600                 # nodes of a cell that are compared with each other, about
SAMPLE = 16                     # neighbours, and as many listing nodes, that meet in a round
SETTLED = 0.005                 # rounds end when one changes fewer of the list entries
EXPAND, PATIENCE = 64, 3         # nodes expanded in a hop; hops without a better result, then a query is done
BLOCK_ROWS = 2000
MIN_BLOCKS = 32
FAN = 256                       # pivots that divide one cell, about at most; their cells are divided further
PART_ROWS = 20_000              # nodes of a big cell that meet its pivots in one task
LEARN = 5                       # members that a member learns of where it meets others
MEMBERS = 64                    # members that meet at one node in a round
_GRAPH = "blk int, id long, vec binary, near binary, dist binary, fresh int"


def block_of(ids: np.ndarray, blocks: int) -> np.ndarray:
    return (mix(ids.astype(np.uint64)) % np.uint64(blocks)).astype(np.int32)


def usable(vec: Column) -> Column:
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vec, lambda x: x != 0), F.lit(False))


def vectors(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, vec) of the rows that take part."""
    good = table.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec")).filter(
        F.col("id").isNotNull() & usable(F.col("vec")))
    sizes = good.groupBy(F.size("vec").alias("n")).count().orderBy(F.col("count").desc(), "n").limit(1).collect()
    if not sizes:
        return good
    return good.filter(F.size("vec") == sizes[0]["n"]).groupBy("id").agg(F.min("vec").alias("vec"))


def matrix(column) -> np.ndarray:
    """Rows of a list column as a float32 matrix."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(flat)
    return np.asarray(flat.flatten(), dtype=np.float32).reshape(n, -1)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of rows (batched), from offsets to a row of ``y``: tight groups far from 0 keep their order."""
    x, y = x - y[..., :1, :], y - y[..., :1, :]
    xx, yy = (x * x).sum(-1), (y * y).sum(-1)
    return np.maximum(xx[..., :, None] + yy[..., None, :] - 2 * (x @ np.swapaxes(y, -1, -2)), 0)


def _nearest(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """The nearest of ``points`` to each row, the first on ties."""
    return np.concatenate([distances(x[at:at + 4096], points).argmin(axis=1) for at in range(0, len(x), 4096)]
                          or [np.zeros(0, np.int64)])


def _first_cells(pivots: list[np.ndarray]):
    """Rows of every set of first pivots: the cell of the nearest one."""
    def cells(batches):
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("vec"))
                for number, points in enumerate(pivots):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(x), number), pa.int32()), pa.array(_nearest(x, points).astype(np.int64)),
                         pa.array(np.full(len(x), -1)), batch.column("id"), batch.column("vec")],
                        ["pivots", "cell", "parent", "id", "vec"])
    return cells


def _divided(key: tuple, members: pa.Table, pivots: pa.Table) -> pa.Table:
    """A part of a big cell: each member goes to the cell of its nearest pivot. All parts see the same pivots."""
    points = np.unique(matrix(pivots["vec"]), axis=0) if len(pivots) else np.zeros((0, 0), np.float32)
    tells = len(points) > 1 and len(members) > 0
    nearest = _nearest(matrix(members["vec"]), points) if tells else np.zeros(len(members), np.int64)
    child = mix(mix(members["cell"].to_numpy().astype(np.uint64)) + nearest.astype(np.uint64)) >> np.uint64(1)
    return pa.table({"pivots": members["pivots"], "cell": pa.array(child.astype(np.int64)), "parent": members["cell"],
                     "id": members["id"], "vec": members["vec"]})


def pivot_cells(points: DataFrame, n: int, sets: int, cell_rows: int, seed: int, fan: int = FAN) -> DataFrame:
    """(pivots, cell, part, id, vec): every node in a cell of each set of pivots, cells of at most ``2 * cell_rows`` nodes.

    The first ``fan`` pivots of a set are nodes drawn by hash; they alone pass through the driver. A cell that is too
    big is divided by pivots drawn from its own nodes, which are a table: its nodes meet them in parts of bounded size,
    level by level. A cell that its pivots do not divide holds nodes alike in single precision; hash parts divide it.
    """
    most = 2 * cell_rows
    if n <= most:
        return points.select(*[F.lit(0).alias("pivots"), F.lit(0).cast("long").alias("cell"), F.lit(0).alias("part")], "id", "vec")
    slots = 1 << 30
    slot = lambda salt: F.pmod(F.xxhash64("id", salt), F.lit(slots))
    first = []
    for number in range(sets):
        drawn = points.orderBy(F.xxhash64("id", F.lit(seed + number)), "id").limit(max(2, min(fan, n // cell_rows))).toArrow()
        first.append(np.unique(matrix(drawn["vec"]), axis=0))
    none = F.lit(0).cast("long")
    schema = points.select(F.lit(0).alias("pivots"), none.alias("cell"), none.alias("parent"), "id", "vec").schema
    cells = points.mapInArrow(_first_cells(first), schema)
    key = ["pivots", "cell"]
    finished, level, parents = [], 0, None
    while True:
        sizes = cells.groupBy(*key).agg(F.count(F.lit(1)).alias("size"), F.min("parent").alias("parent"))
        if level:
            # a division that leaves all of a cell in one child does not tell its nodes apart
            sizes = sizes.join(parents, ["pivots", "parent", "size"], "left").withColumn("alike", F.col("whole").isNotNull())
        else:
            sizes = sizes.withColumn("alike", F.lit(False))
        sizes = stored(sizes.filter(F.col("size") > most).select(*key, "size", "alike"), "cells-big")
        if sizes.isEmpty():
            finished.append(cells.select(*key, F.lit(0).alias("part"), "id", "vec"))
            break
        beside = cells.join(sizes, key, "left")
        parts = F.ceil(F.col("size") / cell_rows).cast("int")
        spread = F.pmod(F.xxhash64("id", F.lit(seed + 31)), F.coalesce(parts, F.lit(1))).cast("int")
        finished.append(beside.filter(F.col("size").isNull() | F.col("alike")).select(*key, spread.alias("part"), "id", "vec"))
        big = sizes.filter(~F.col("alike"))
        level += 1
        members = cells.join(big.drop("alike"), key).withColumn(
            "part", F.pmod(F.xxhash64("id", F.lit(seed + 53)), F.ceil(F.col("size") / PART_ROWS).cast("int")).cast("int"))
        wanted = F.greatest(F.lit(2), F.least(F.lit(fan), F.floor(F.col("size") / cell_rows)))
        drawn = members.filter(slot(F.lit(seed + 97 * level)) < F.ceil((wanted + 6) * slots / F.col("size")))
        every = F.explode(F.sequence(F.lit(0), F.ceil(F.col("size") / PART_ROWS).cast("int") - 1))
        pivots = stored(drawn.select(*key, every.alias("part"), "vec"), "pivots")
        parents = big.select("pivots", F.col("cell").alias("parent"), "size", F.lit(True).alias("whole"))
        cells = stored(members.select(*key, "part", "id", "vec").groupBy(*key, "part").cogroup(pivots.groupBy(*key, "part"))
                       .applyInArrow(_divided, schema), "cells")
    return reduce(DataFrame.unionByName, finished)


def _top(owner: np.ndarray, other: np.ndarray, dist: np.ndarray, most: int):
    """The ``most`` nearest distinct others of each owner, as sorted parallel arrays."""
    order = np.lexsort((other, owner))
    o, x, d = owner[order], other[order], dist[order]
    new = np.ones(len(o), dtype=bool)
    new[1:] = (o[1:] != o[:-1]) | (x[1:] != x[:-1])
    o, x, d = o[new], x[new], d[new]
    order = np.lexsort((x, d, o))
    o, x, d = o[order], x[order], d[order]
    rank = np.arange(len(o)) - np.searchsorted(o, o)
    keep = rank < most
    return o[keep], x[keep], d[keep]


def _meet_in_cell(degree: int, blocks: int):
    def meet(key: tuple, group: pa.Table) -> pa.Table:
        ids, x = group["id"].to_numpy(), matrix(group["vec"])
        most = min(degree, len(ids) - 1)
        owner, other, dist = [], [], []
        for at in range(0, len(ids) if most else 0, 512):
            d = distances(x[at:at + 512], x)
            d[np.arange(len(d)), at + np.arange(len(d))] = np.inf
            best = np.argpartition(d, most - 1, axis=1)[:, :most]
            owner.append(np.repeat(ids[at:at + 512], most))
            other.append(ids[best].reshape(-1))
            dist.append(np.take_along_axis(d, best, axis=1).reshape(-1))
        return _messages(owner, other, dist, blocks)
    return meet


def _messages(owner: list, other: list, dist: list, blocks: int) -> pa.Table:
    """Found neighbours, packed by the owner's block."""
    owner = np.concatenate(owner) if owner else np.zeros(0, np.int64)
    other = np.concatenate(other) if other else np.zeros(0, np.int64)
    dist = np.concatenate(dist).astype(np.float32) if dist else np.zeros(0, np.float32)
    blk = block_of(owner, blocks)
    order = np.argsort(blk, kind="stable")
    cuts = np.flatnonzero(np.diff(blk[order])) + 1
    parts = np.split(order, cuts) if len(order) else []
    return pa.table({"blk": pa.array([int(blk[p[0]]) for p in parts], pa.int32()),
                     "owner": pa.array([owner[p].astype("<i8").tobytes() for p in parts], pa.binary()),
                     "other": pa.array([other[p].astype("<i8").tobytes() for p in parts], pa.binary()),
                     "dist": pa.array([dist[p].tobytes() for p in parts], pa.binary())})


_MESSAGES = "blk int, owner binary, other binary, dist binary"


def _joined(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table[name].to_pylist()), kind)


class _Block:
    """The nodes of a block, by id."""

    def __init__(self, table: pa.Table):
        table = table.sort_by("id")
        self.ids = table["id"].to_numpy()
        n = len(self.ids)
        self.vec = np.frombuffer(b"".join(table["vec"].to_pylist()), np.float32).reshape(n, -1)
        self.vec_bytes = table["vec"]
        near = table["near"].to_pylist()
        self.sizes = np.array([len(x) // 8 for x in near], dtype=np.int64)
        self.owner = np.repeat(self.ids, self.sizes)
        self.near = np.frombuffer(b"".join(near), "<i8")
        self.dist = np.frombuffer(b"".join(table["dist"].to_pylist()), np.float32)

    def rows(self, ids: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ids, ids)


def _graph_rows(blk: int, ids: np.ndarray, vec_bytes, owner, near, dist, fresh) -> pa.Table:
    start, end = np.searchsorted(owner, ids), np.searchsorted(owner, ids, side="right")
    fresh = np.concatenate(([0], np.cumsum(fresh)))
    return pa.table({"blk": pa.array(np.full(len(ids), blk), pa.int32()), "id": ids, "vec": vec_bytes,
                     "near": pa.array([near[a:b].astype("<i8").tobytes() for a, b in zip(start, end, strict=True)], pa.binary()),
                     "dist": pa.array([dist[a:b].tobytes() for a, b in zip(start, end, strict=True)], pa.binary()),
                     "fresh": pa.array(fresh[end] - fresh[start], pa.int32())})


def _learn(degree: int):
    def learn(key: tuple, graph: pa.Table, found: pa.Table) -> pa.Table:
        """Merge found neighbours into the lists of a block."""
        b = _Block(graph)
        owner, near, dist = _top(np.concatenate((b.owner, _joined(found, "owner", "<i8"))),
                                 np.concatenate((b.near, _joined(found, "other", "<i8"))),
                                 np.concatenate((b.dist, _joined(found, "dist", np.float32))), degree)
        pair = np.dtype([("owner", "<i8"), ("near", "<i8")])
        now, known = np.empty(len(owner), pair), np.empty(len(b.owner), pair)
        now["owner"], now["near"], known["owner"], known["near"] = owner, near, b.owner, b.near
        return _graph_rows(key[0].as_py(), b.ids, b.vec_bytes, owner, near, dist, ~np.isin(now, known))
    return learn


def _sampled(owner: np.ndarray, other: np.ndarray, most: int, turn: int):
    """At most ``most`` random others of each owner, other ones each turn."""
    draw = mix(mix(owner.astype(np.uint64) + np.uint64(turn)) ^ other.astype(np.uint64))
    order = np.lexsort((draw, owner))
    o = owner[order]
    keep = order[np.arange(len(o)) - np.searchsorted(o, o) < most]
    return owner[keep], other[keep]


def _tell(blocks: int, sample: int, turn: int):
    def tell(key: tuple, graph: pa.Table) -> pa.Table:
        """Each node tells a sample of its neighbours that it lists them."""
        b = _Block(graph)
        owner, near = _sampled(b.owner, b.near, sample, turn)
        near, owner = _sampled(near, owner, sample, turn)     # a node listed by very many hears of a few from each block
        return _messages([near], [owner], [np.zeros(len(near))], blocks)
    return tell


def _send_vectors(blocks: int, sample: int, turn: int, members: int):
    def send(key: tuple, graph: pa.Table, told: pa.Table) -> pa.Table:
        """Each node sends its vector to nodes that list it, and to neighbours of its own."""
        b = _Block(graph)
        member_a, centre_a = _sampled(_joined(told, "owner", "<i8"), _joined(told, "other", "<i8"), sample, turn)
        member_b, centre_b = _sampled(b.owner, b.near, sample, turn)
        member, centre = np.concatenate((member_a, member_b)), np.concatenate((centre_a, centre_b))
        pairs = np.unique(np.stack((centre, member), axis=1), axis=0)
        centre, member = _sampled(pairs[:, 0], pairs[:, 1], members, turn)    # those that ``_meet`` may keep
        rows = b.rows(member)
        last = np.full(len(b.ids), np.inf, dtype=np.float32)
        full = b.sizes > 0
        last[full] = np.maximum.reduceat(b.dist, (np.cumsum(b.sizes) - b.sizes)[full])
        blk = block_of(centre, blocks)
        order = np.argsort(blk, kind="stable")
        cuts = np.flatnonzero(np.diff(blk[order])) + 1
        parts = np.split(order, cuts) if len(order) else []
        return pa.table({"blk": pa.array([int(blk[p[0]]) for p in parts], pa.int32()),
                         "centre": pa.array([centre[p].astype("<i8").tobytes() for p in parts], pa.binary()),
                         "member": pa.array([member[p].astype("<i8").tobytes() for p in parts], pa.binary()),
                         "last": pa.array([last[rows[p]].tobytes() for p in parts], pa.binary()),
                         "vec": pa.array([b.vec[rows[p]].tobytes() for p in parts], pa.binary())})
    return send


def _meet(blocks: int, members: int, turn: int, best: int, degree: int):
    def meet(key: tuple, group: pa.Table) -> pa.Table:
        """Members of a centre compare; each learns of those closer than its farthest neighbour."""
        centre, member = _joined(group, "centre", "<i8"), _joined(group, "member", "<i8")
        last, vec = _joined(group, "last", np.float32), _joined(group, "vec", np.float32)
        vec = vec.reshape(len(centre), -1)
        # a much listed centre takes a sample of its members
        draw = mix(mix(centre.astype(np.uint64) + np.uint64(turn)) ^ member.astype(np.uint64))
        order = np.lexsort((draw, centre))
        order = order[np.arange(len(order)) - np.searchsorted(centre[order], centre[order]) < members]
        centre, member, last, vec = centre[order], member[order], last[order], vec[order]
        starts = np.flatnonzero(np.concatenate(([True], centre[1:] != centre[:-1])))
        sizes = np.diff(np.concatenate((starts, [len(centre)])))
        owner, other, dist = [], [], []
        for size in np.unique(sizes):
            if size < 2:
                continue
            these = starts[sizes == size]
            for at in range(0, len(these), max(1, 200_000 // int(size * size))):
                part = these[at:at + max(1, 200_000 // int(size * size))]
                index = part[:, None] + np.arange(size)
                x = vec[index]
                d = distances(x, x)
                d[:, np.arange(size), np.arange(size)] = np.inf
                most = min(best, size - 1)
                picked = np.argpartition(d, most - 1, axis=2)[:, :, :most]
                value = np.take_along_axis(d, picked, axis=2)
                closer = value < last[index][:, :, None]
                row = np.broadcast_to(index[:, :, None], picked.shape)
                owner.append(member[row[closer]])
                other.append(member[np.take_along_axis(np.broadcast_to(index[:, None, :], d.shape), picked, axis=2)[closer]])
                dist.append(value[closer])
        if not owner:
            return _messages([], [], [], blocks)
        return _messages(*([x] for x in _top(np.concatenate(owner), np.concatenate(other), np.concatenate(dist), degree)),
                         blocks)
    return meet


def _linked(degree: int, turn: int):
    def linked(key: tuple, graph: pa.Table, told: pa.Table) -> pa.Table:
        """Each node's neighbours, and as many of the nodes that list it: what a search follows."""
        b = _Block(graph)
        listed, by = _sampled(_joined(told, "owner", "<i8"), _joined(told, "other", "<i8"), degree, turn)
        pairs = np.unique(np.stack((np.concatenate((b.owner, listed)), np.concatenate((b.near, by))), axis=1), axis=0)
        start, end = np.searchsorted(pairs[:, 0], b.ids), np.searchsorted(pairs[:, 0], b.ids, side="right")
        return pa.table({"blk": pa.array(np.full(len(b.ids), key[0].as_py()), pa.int32()), "id": b.ids, "vec": b.vec_bytes,
                         "near": pa.array([pairs[x:y, 1].astype("<i8").tobytes() for x, y in zip(start, end, strict=True)], pa.binary())})
    return linked


class Index:
    """NN-descent graph over the distinct vectors of ``table``."""

    def __init__(self, table: DataFrame, degree: int = DEGREE, settled: float = SETTLED, copies: int = 11,
                 pivot_sets: int = PIVOT_SETS, cell_rows: int = CELL_ROWS, learn: int = LEARN, members: int = MEMBERS,
                 seed: int = 3):
        spark = table.sparkSession
        self.copies = copies
        hashed = vectors(table).select("id", "vec", F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(5), "vec").alias("h2"))
        same = Window.partitionBy("h1", "h2").orderBy("id")
        few = hashed.withColumn("nth", F.row_number().over(same)).filter(F.col("nth") <= copies)
        grouped = few.groupBy("h1", "h2").agg(F.min("id").alias("node"), F.sort_array(F.collect_list("id")).alias("copies"),
                                              F.first("vec").alias("vec"))
        self.nodes = stored(grouped, "nodes")             # one row for each distinct vector
        self.hashed = hashed
        n = self.nodes.count()
        self.blocks = max(MIN_BLOCKS, -(-n // BLOCK_ROWS))
        blocks = self.blocks
        points = self.nodes.select(F.col("node").alias("id"), "vec")

        # starting neighbours, from cells of random pivots
        cells = pivot_cells(points, n, pivot_sets, cell_rows, seed)
        found = cells.groupBy("pivots", "cell", "part").applyInArrow(_meet_in_cell(degree, blocks), _MESSAGES)

        def bare(batches):
            for batch in batches:
                if batch.num_rows:
                    ids, x = batch.column("id").to_numpy(), matrix(batch.column("vec"))
                    empty = pa.array([b""] * len(ids), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(block_of(ids, blocks)), batch.column("id"), pa.array([v.tobytes() for v in x], pa.binary()),
                         empty, empty, pa.array(np.zeros(len(ids)), pa.int32())],
                        ["blk", "id", "vec", "near", "dist", "fresh"])

        graph = points.mapInArrow(bare, _GRAPH)
        self.graph = stored(graph.groupBy("blk").cogroup(found.groupBy("blk")).applyInArrow(_learn(degree), _GRAPH), "graph")
        self.changes: list[int] = []                      # list entries that each round changed
        while not self.changes or self.changes[-1] > settled * n * degree:
            turn = len(self.changes)
            told = self.graph.groupBy("blk").applyInArrow(_tell(blocks, SAMPLE, turn), _MESSAGES)
            sent = self.graph.groupBy("blk").cogroup(told.groupBy("blk")).applyInArrow(
                _send_vectors(blocks, SAMPLE, turn, members), "blk int, centre binary, member binary, last binary, vec binary")
            found = sent.groupBy("blk").applyInArrow(_meet(blocks, members, turn, learn, degree), _MESSAGES)
            self.graph = stored(self.graph.groupBy("blk").cogroup(found.groupBy("blk")).applyInArrow(
                _learn(degree), _GRAPH), "graph")
            self.changes.append(self.graph.agg(F.coalesce(F.sum("fresh"), F.lit(0))).first()[0])
        told = self.graph.groupBy("blk").applyInArrow(_tell(blocks, degree, 0), _MESSAGES)
        self.links = stored(self.graph.groupBy("blk").cogroup(told.groupBy("blk")).applyInArrow(
            _linked(degree, 0), "blk int, id long, vec binary, near binary"), "links")

    def search(self, queries: DataFrame, k: int = 10, expand: int = EXPAND, patience: int = PATIENCE) -> DataFrame:
        """(query_id, rank, vec_id, score) for ``queries(id)``, ids of the table."""
        asked = stored(self.hashed.join(queries.select("id").distinct(), "id", "left_semi")
                       .join(self.nodes.select("h1", "h2", "node"), ["h1", "h2"]).select("id", "node"), "queries")
        blocks, graph = self.blocks, self.links
        state = stored(graph.join(asked.select(F.col("node").alias("id")).distinct(), "id", "left_semi")
                       .mapInArrow(_begin, _STATE), "search")
        closed = []
        while not state.isEmpty():
            asks = state.mapInArrow(_ask(blocks, expand), _PAIRS.format("blk"))
            lists = graph.groupBy("blk").cogroup(asks.groupBy("blk")).applyInArrow(_lists(blocks), _PAIRS.format("home"))
            wanted = state.groupBy("home").cogroup(lists.groupBy("home")).applyInArrow(_wanted(blocks), _WANTED)
            measured = graph.groupBy("blk").cogroup(wanted.groupBy("blk")).applyInArrow(
                _measured(blocks), _PAIRS.format("home") + ", dist binary")
            state = stored(state.groupBy("home").cogroup(measured.groupBy("home")).applyInArrow(
                _advanced(k + 1, expand, patience), _STATE), "search")
            closed.append(state.filter("NOT open"))
            state = state.filter("open")
        if not closed:
            closed = [state]
        best = reduce(DataFrame.unionByName, closed).mapInArrow(_best(2 * k + 2), "q long, node long")
        # the best are measured again in double precision, on the original vectors
        vecs = self.nodes.select("node", "vec", "copies")
        origin = vecs.select(F.col("node").alias("q"), F.col("vec").alias("q_vec"))
        square = F.aggregate(F.zip_with("q_vec", "vec", lambda a, b: (a.cast("double") - b.cast("double"))
                                        * (a.cast("double") - b.cast("double"))), F.lit(0.0), lambda s, x: s + x)
        nearest = Window.partitionBy("q").orderBy("d", "node")
        hits = (best.join(vecs, "node").join(origin, "q").select("q", "node", square.alias("d"), "copies")
                .withColumn("nth", F.row_number().over(nearest)).filter(F.col("nth") <= k + 1)
                .select("q", "d", F.explode("copies").alias("vec_id")))
        answered = (asked.select(F.col("id").alias("query_id"), F.col("node").alias("q")).join(hits, "q")
                    .filter(F.col("query_id") != F.col("vec_id")))
        order = Window.partitionBy("query_id").orderBy("d", "vec_id")
        return (answered.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
                .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", F.sqrt("d").alias("score")))


# ---------------------------------------------------------------- search, one packed row a query

_STATE = "home int, q long, vec binary, node binary, dist binary, done binary, hop int, better int, open boolean"
_PAIRS = "{} int, q binary, node binary"
_WANTED = "blk int, q binary, vec binary, which binary, node binary"


def _begin(batches):
    """A query knows itself."""
    for batch in batches:
        if batch.num_rows:
            ids = batch.column("id").to_numpy()
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("blk"), batch.column("id"), batch.column("vec"), pa.array([i.tobytes() for i in ids.astype("<i8")], pa.binary()),
                 pa.array([np.zeros(1).tobytes()] * n, pa.binary()), pa.array([b"\0"] * n, pa.binary()),
                 pa.array(np.zeros(n), pa.int32()), pa.array(np.zeros(n), pa.int32()), pa.array(np.ones(n, dtype=bool))],
                [c.split()[0] for c in _STATE.split(", ")])


def _open_nodes(node: np.ndarray, done: np.ndarray, expand: int) -> np.ndarray:
    """Places of the best nodes that are not expanded; a query's nodes lie by distance."""
    return np.flatnonzero(done == 0)[:expand]


def _by(target: np.ndarray) -> list[np.ndarray]:
    """Places of equal targets, one array each."""
    order = np.argsort(target, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(target[order])) + 1) if len(order) else []


def _pairs(name: str, target: np.ndarray, q: np.ndarray, node: np.ndarray, dist: np.ndarray | None = None) -> pa.Table:
    parts = _by(target)
    columns = {name: pa.array([int(target[p[0]]) for p in parts], pa.int32()),
               "q": pa.array([q[p].astype("<i8").tobytes() for p in parts], pa.binary()),
               "node": pa.array([node[p].astype("<i8").tobytes() for p in parts], pa.binary())}
    if dist is not None:
        columns["dist"] = pa.array([dist[p].tobytes() for p in parts], pa.binary())
    return pa.table(columns)


def _flat(parts: list[np.ndarray], kind="<i8") -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _ask(blocks: int, expand: int):
    """Ask the blocks of each query's best open nodes for their neighbours."""
    def ask(batches):
        for batch in batches:
            q, node = [], []
            for own, known, done in zip(batch.column("q").to_pylist(), batch.column("node").to_pylist(),
                                        batch.column("done").to_pylist(), strict=True):
                known = np.frombuffer(known, "<i8")
                found = known[_open_nodes(known, np.frombuffer(done, np.uint8), expand)]
                node.append(found)
                q.append(np.full(len(found), own))
            q, node = _flat(q), _flat(node)
            yield from _pairs("blk", block_of(node, blocks), q, node).to_batches()
    return ask


def _lists(blocks: int):
    def lists(key: tuple, graph: pa.Table, asks: pa.Table) -> pa.Table:
        """The neighbours of the nodes asked for, to the queries' homes."""
        q, node = _joined(asks, "q", "<i8"), _joined(asks, "node", "<i8")
        if not len(q):
            return _pairs("home", np.zeros(0, np.int32), q, node)
        ids = graph["id"].to_numpy()
        order = np.argsort(ids)
        near = graph["near"].to_pylist()
        sizes = np.array([len(x) // 8 for x in near], dtype=np.int64)
        flat, starts = np.frombuffer(b"".join(near), "<i8"), np.cumsum(sizes) - sizes
        rows = order[np.searchsorted(ids, node, sorter=order)]
        found = np.unique(np.stack((np.repeat(q, sizes[rows]), flat[ranges(starts[rows], sizes[rows])]), axis=1), axis=0)
        return _pairs("home", block_of(found[:, 0], blocks), found[:, 0], found[:, 1])
    return lists


def _wanted(blocks: int):
    def wanted(key: tuple, state: pa.Table, lists: pa.Table) -> pa.Table:
        """Nodes that a query has not measured, with its vector, to their blocks."""
        q, node = _joined(lists, "q", "<i8"), _joined(lists, "node", "<i8")
        order = np.argsort(q, kind="stable")
        q, node = q[order], node[order]
        owners, vecs, which, nodes = state["q"].to_numpy(), state["vec"].to_pylist(), [], []
        for i, (own, known) in enumerate(zip(owners.tolist(), state["node"].to_pylist(), strict=True)):
            lo, hi = np.searchsorted(q, own), np.searchsorted(q, own, side="right")
            new = np.setdiff1d(node[lo:hi], np.frombuffer(known, "<i8"))
            nodes.append(new)
            which.append(np.full(len(new), i))
        which, nodes = _flat(which), _flat(nodes)
        target = block_of(nodes, blocks)
        out: dict[str, list] = {c.split()[0]: [] for c in _WANTED.split(", ")}
        for p in _by(target):
            some, place = np.unique(which[p], return_inverse=True)
            out["blk"].append(int(target[p[0]]))
            out["q"].append(owners[some].astype("<i8").tobytes())
            out["vec"].append(b"".join(vecs[i] for i in some))
            out["which"].append(place.astype("<i4").tobytes())
            out["node"].append(nodes[p].astype("<i8").tobytes())
        return pa.table({c: pa.array(v, pa.int32() if c == "blk" else pa.binary()) for c, v in out.items()})
    return wanted


def _measured(blocks: int):
    def measured(key: tuple, graph: pa.Table, wanted: pa.Table) -> pa.Table:
        """Squared distances in double precision, to the queries' homes."""
        ids = graph["id"].to_numpy()
        order = np.argsort(ids)
        x = np.frombuffer(b"".join(graph["vec"].to_pylist()), np.float32).reshape(len(ids), -1) if len(ids) else None
        qs, nodes, dist = [], [], []
        for row in wanted.to_pylist():
            own, node = np.frombuffer(row["q"], "<i8"), np.frombuffer(row["node"], "<i8")
            which = np.frombuffer(row["which"], "<i4")
            mine = np.frombuffer(row["vec"], np.float32).reshape(len(own), -1)
            rows = order[np.searchsorted(ids, node, sorter=order)]
            for at in range(0, len(node), 20_000):
                d = x[rows[at:at + 20_000]].astype(np.float64) - mine[which[at:at + 20_000]]
                dist.append(np.einsum("ij,ij->i", d, d))
            qs.append(own[which])
            nodes.append(node)
        q = _flat(qs)
        return _pairs("home", block_of(q, blocks), q, _flat(nodes), _flat(dist, np.float64))
    return measured


def _advanced(best: int, expand: int, patience: int):
    def advanced(key: tuple, state: pa.Table, measured: pa.Table) -> pa.Table:
        """The queries after a hop: what they asked for is expanded, what was measured is known."""
        q, node, dist = _joined(measured, "q", "<i8"), _joined(measured, "node", "<i8"), _joined(measured, "dist", np.float64)
        order = np.argsort(q, kind="stable")
        q, node, dist = q[order], node[order], dist[order]
        rows = []
        for row in state.to_pylist():
            known, d = np.frombuffer(row["node"], "<i8"), np.frombuffer(row["dist"], np.float64)
            done = np.frombuffer(row["done"], np.uint8).copy()
            done[_open_nodes(known, done, expand)] = 1
            lo, hi = np.searchsorted(q, row["q"]), np.searchsorted(q, row["q"], side="right")
            hop = row["hop"] + 1
            nodes, d = np.concatenate((known, node[lo:hi])), np.concatenate((d, dist[lo:hi]))
            done = np.concatenate((done, np.zeros(hi - lo, np.uint8)))
            order = np.lexsort((nodes, d))
            better = hop if (order[:best] >= len(known)).any() else row["better"]
            done = done[order]
            rows.append(row | {"node": nodes[order].astype("<i8").tobytes(), "dist": d[order].tobytes(), "done": done.tobytes(),
                               "hop": hop, "better": better, "open": bool(hop - better < patience and (done == 0).any())})
        return pa.Table.from_pylist(rows, _STATE_TYPE)
    return advanced


def _best(most: int):
    """The nearest nodes of each query, as pairs."""
    def best(batches):
        for batch in batches:
            nodes = [np.frombuffer(x, "<i8")[:most] for x in batch.column("node").to_pylist()]
            sizes = [len(x) for x in nodes]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column("q").to_numpy(), sizes)), pa.array(_flat(nodes))],
                                             ["q", "node"])
    return best


_STATE_TYPE = pa.schema([("home", pa.int32()), ("q", pa.int64()), ("vec", pa.binary()), ("node", pa.binary()), ("dist", pa.binary()),
                         ("done", pa.binary()), ("hop", pa.int32()), ("better", pa.int32()), ("open", pa.bool_())])
