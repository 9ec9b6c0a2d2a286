"""Periodic runs of words, found by Lyndon roots.

Method: every run of period q holds a Lyndon word of q words that is the longest
Lyndon word at the place where it starts, in the order of words or in the reverse
order. ``lyndon_lengths`` finds the longest Lyndon word at every place by the first
phase of Baier's grouping suffix sorter: suffixes lie in groups by a common
beginning, at first by their first word. Groups are visited from the largest down;
when a group is visited, its common beginning is the longest Lyndon word of its
members, and it is appended to that of the nearest smaller suffix before each of
them. Both orders are computed so. A root that stands at least three times in a
row is extended both ways by longest common extensions into its run.

Words that stand fewer than four times in their document are in no run of four
periods, so they part the text first, and again inside the parts, until every part
holds each of its words four times. What remains of a batch of documents is grouped
in one pass; smallest symbols between the parts keep Lyndon words inside.

A run is a stretch of consecutive words with smallest period q and length at least
``max(6, 4 * q)`` that no neighbouring word extends keeping period q.

Defined results: a null or empty text has no words, no runs and an empty collapsed
text; every row is a document of its own, also when ids repeat or are null; an empty
table gives an empty result; further columns are ignored unless ``keep`` names them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .text import batches_of

MIN_LENGTH, MIN_PERIODS = 6, 4
BATCH_CHARACTERS = 1 << 20
_RUNS = ArrayType(StructType([StructField(n, LongType(), False) for n in ("start", "length", "period")]), False)


def lyndon_lengths(symbols: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word that starts at each place.

    ``symbols`` are integers from 0 on; 0 parts the sequences and must be the first. Its
    places get 0, and end every Lyndon word before them.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    cuts = np.flatnonzero(np.diff(symbols[order])) + 1
    members = [part.tolist() for part in np.split(order, cuts)]
    number = np.zeros(n, dtype=np.int64)
    number[order[cuts]] = 1
    group = np.empty(n, dtype=np.int64)
    group[order] = np.cumsum(number[order])
    group = group.tolist()
    size = [1] * len(members)                             # length of a group's common beginning
    held = [len(m) for m in members]                      # members that it still has
    below = list(range(-1, len(members) - 1))
    above = list(range(1, len(members) + 1))              # the last one's is never read
    up = list(range(n))                                   # towards the nearest place before in a group not visited
    lengths = [0] * n
    current = len(members) - 1
    while current > 0:                                    # group 0 are the separators
        length = size[current]
        live = [i for i in members[current] if group[i] == current]
        members[current] = None
        for i in live:
            up[i] = i - 1
            lengths[i] = length
        hits: dict[int, int] = {}
        for i in live:
            j = i - 1
            while up[j] != j:
                up[j] = j = up[up[j]]
            if group[j]:
                hits[j] = hits.get(j, 0) + 1
        for times in ((1,) if len(hits) == len(live) else sorted(set(hits.values()), reverse=True)):
            fresh: dict[int, int] = {}                    # group -> its part that grows now
            moved = [j for j, c in hits.items() if c == times]
            leaving: dict[int, int] = {}
            for j in moved:
                leaving[group[j]] = leaving.get(group[j], 0) + 1
            for j in moved:
                g = group[j]
                if leaving[g] == held[g]:                 # all of a group grow: it stays one
                    fresh[g] = g
                    continue
                new = fresh.get(g)
                if new is None:
                    new = fresh[g] = len(size)
                    size.append(size[g] + times * length)
                    members.append([])
                    held.append(0)
                    higher = above[g]
                    above[g] = new
                    below.append(g)
                    above.append(higher)
                    below[higher] = new
                members[new].append(j)
                held[new] += 1
                group[j] = new
            for g, new in fresh.items():
                if g == new:
                    size[g] += times * length
                else:
                    held[g] -= leaving[g]
        current = below[current]
    return np.array(lengths, dtype=np.int64)


def _common(symbols: np.ndarray, a: int, b: int, step: int) -> int:
    """Length of the longest common extension from places a < b, forwards or backwards."""
    length, block = 0, 16
    while True:
        x, y = a + step * length, b + step * length
        if min(x, y) < 0 or max(x, y) >= len(symbols):
            return length
        if step > 0:
            size = min(block, len(symbols) - y)
            differ = symbols[x:x + size] != symbols[y:y + size]
        else:
            size = min(block, x + 1)
            differ = symbols[x - size + 1:x + 1][::-1] != symbols[y - size + 1:y + 1][::-1]
        at = int(differ.argmax())
        if differ[at]:
            return length + at
        length += size
        block = min(2 * block, 1 << 16)


def runs(symbols: np.ndarray, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of at least ``min_length`` words and ``min_periods``
    (3 or more) periods, by start and period; ``symbols`` as for ``lyndon_lengths``."""
    apart = symbols == 0
    distinct = np.where(apart, -1 - np.arange(len(symbols)), symbols)     # separators equal nothing
    found = set()
    for order in (symbols, np.where(apart, 0, symbols.max(initial=0) + 1 - symbols)):
        length = lyndon_lengths(order)
        at = np.arange(len(length))
        roots = (length > 0) & (at + 2 * length < len(length))
        at, period = at[roots], length[roots]
        thrice = (length[at + period] == period) & (length[at + 2 * period] == period) & (
            distinct[at] == distinct[at + 2 * period])
        reached: dict[int, int] = {}                      # where the last run of a period ends
        for i, q in zip(at[thrice].tolist(), period[thrice].tolist(), strict=True):
            if i + 2 * q <= reached.get(q, 0):
                continue                                  # in a run that is known
            right = _common(distinct, i, i + q, 1)
            if right < q:
                continue
            left = _common(distinct, i - 1, i + q - 1, -1)
            reached[q] = i + q + right
            if left + q + right >= max(min_length, min_periods * q):
                found.add((i - left, left + q + right, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _repeating_parts(words: np.ndarray, owner: np.ndarray, times: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, part numbers): the longest parts of each owner's words in which every word stands
    ``times`` times, of ``least`` words or more."""
    at, part = np.arange(len(words)), owner.astype(np.int64)
    span = int(words.max(initial=0)) + 1
    while len(at):
        _, which, counts = np.unique(part * span + words[at], return_inverse=True, return_counts=True)
        stays = counts[which] >= times
        whole = stays.all()
        at, part = at[stays], part[stays]
        new = np.ones(len(at), dtype=bool)
        new[1:] = (np.diff(at) != 1) | (np.diff(part) != 0)
        part = np.cumsum(new) - 1
        long = np.bincount(part)[part] >= least if len(at) else new
        if whole and long.all():
            break
        at, part = at[long], part[long]
    return at, part


def runs_of_texts(words: np.ndarray, first: np.ndarray, min_length: int = MIN_LENGTH,
                  min_periods: int = MIN_PERIODS) -> list[list[tuple[int, int, int]]]:
    """The runs of each text; text t has ``words[first[t]:first[t + 1]]``, as integers from 0 on."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(first) - 1)]
    owner = np.repeat(np.arange(len(out)), np.diff(first))
    at, part = _repeating_parts(words, owner, min_periods, min_length)
    if not len(at):
        return out
    place = np.arange(len(at)) + part + 1                 # a separator before each part
    symbols, origin = np.zeros(int(place[-1]) + 1, dtype=np.int64), np.zeros(int(place[-1]) + 1, dtype=np.int64)
    symbols[place], origin[place] = words[at] + 1, at
    for start, length, period in runs(symbols, min_length, min_periods):
        text = int(owner[origin[start]])
        out[text].append((int(origin[start] - first[text]), length, period))
    return out


def strongest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest exact length / period; on ties the smallest start, then period."""
    best = None
    for run in found:                                     # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words outside every run's later periods, joined by one space."""
    if not found:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in found:
        edge[start + period] += 1
        edge[start + length] -= 1
    return b" ".join([w for w, covered in zip(words, np.cumsum(edge[:-1]).tolist(), strict=True) if not covered])


def periodic_runs(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text",
                  min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> DataFrame:
    """The ``keep`` columns of every row, ``runs`` (start, length, period; by start, then period),
    ``strongest`` (null without a run) and ``collapsed_text``."""
    names = [*keep, "runs", "strongest", "collapsed_text"]

    def find(batches):
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            for lo, hi in batches_of(texts, BATCH_CHARACTERS):
                split = [(t or "").encode().split() for t in texts[lo:hi]]
                first = np.concatenate(([0], np.cumsum([len(w) for w in split]))).astype(np.int64)
                words = pa.array([w for ws in split for w in ws], pa.binary()).dictionary_encode().indices
                found = runs_of_texts(words.to_numpy(zero_copy_only=False).astype(np.int64), first, min_length, min_periods)
                as_rows = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in rs] for rs in found]
                tops = [strongest(rs) for rs in found]
                part = batch.slice(lo, hi - lo)
                run_type = pa.struct([pa.field(n, pa.int64(), False) for n in ("start", "length", "period")])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(keep)], pa.array(as_rows, pa.list_(pa.field("element", run_type, False))),
                     pa.array([t and dict(zip(("start", "length", "period"), t, strict=True)) for t in tops], run_type),
                     pa.array([collapsed(w, rs).decode() for w, rs in zip(split, found, strict=True)], pa.string())], names)

    rows = docs.select(*keep, F.col(text_col).cast("string"))
    schema = StructType([*rows.schema.fields[:len(keep)], StructField("runs", _RUNS),
                         StructField("strongest", _RUNS.elementType), StructField("collapsed_text", StringType())])
    return rows.mapInArrow(find, schema)


def repeated_tails(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``, with runs planted: where crc32 of the decimal id is a multiple of 10 (a null id
    never is), the words from a place on become repetitions of the words at that place."""
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    n = F.size("_words")
    changed = (docs.select("doc_id", "text", h.alias("_h"), g.alias("_g"))
               .withColumn("_words", F.when(F.col("_h") % 10 == 0, words))
               .withColumn("_n", F.when(n > 0, n).cast("long"))
               .withColumn("_a", F.col("_g") % F.col("_n"))
               .withColumn("_p", F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8)) + 1)
               .withColumn("_times", F.ceil((F.col("_n") - F.col("_a")) / F.col("_p"))))
    tail = F.flatten(F.array_repeat(F.slice("_words", (F.col("_a") + 1).cast("int"), F.col("_p").cast("int")),
                                    F.col("_times").cast("int")))
    whole = F.slice(F.concat(F.slice("_words", F.lit(1), F.col("_a").cast("int")), tail), F.lit(1), F.col("_n").cast("int"))
    return changed.select("doc_id", F.when(F.col("_n").isNotNull(), F.array_join(whole, " ")).otherwise(F.col("text")).alias("text"))
