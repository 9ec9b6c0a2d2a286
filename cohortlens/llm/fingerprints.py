"""Document fingerprints from modular prefix polynomial hashes.

Method: for a chunk of texts, laid end to end, prefix arrays hold the
polynomial hash of everything before each code point, modulo two primes. Two
array reads give the hash of any span, so any two spans compare in constant
time, and the longest common extension of two places is found by binary search.

A fingerprint is the text's length, its whole-span hash under both primes and
the hashes of its eight equal parts, as hex. Likeness of two fingerprinted texts
is the length of their common pieces over the longer length: the longest common
prefix and suffix, and pieces between scattered edits, whose anchors are found by
span equality. All are extended by binary search on the prefix arrays. It is 1 for equal
texts; ``PrefixHashes.likeness`` has the rule.

The neighbour of a document is the next in descending doc_id. Documents are sorted
into ranges of the ids, and of a hash of the text, so that an id with many rows
spreads over ranges. A range is read as a stream, some megabytes of text at a time,
and each document meets the next one. Only the first and the last text of each
range are kept; the last one meets the first one of the range after it in a join.

Defined results: a null text is empty; two empty texts have likeness 1; a null
doc_id comes after all others; rows with one doc_id are ordered by the 64-bit hash of
their text; a single document is its own neighbour, and the last one's is the
first; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import stored
from .text import MIN_CHUNKS, text_bytes

RANGE_BYTES = 32 << 20          # text of a range, about
SLAB_CHARS = 2 << 20            # text that is hashed at once
PARTS = 8
SLAB = 1 << 20
ANCHOR, WINDOW = 24, 96         # code points of an anchor, and how far ahead it is looked up
SKIPS, ROUNDS = (0, 16, 48), 12  # where anchors are taken past a mismatch, and how often
PRIMES = ((2147483647, 1103515245), (2147483629, 69621069))     # (modulus, base)
_LOWEST = -(2**63)
_POWERS: dict[int, np.ndarray] = {}

RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, next_doc_id long")


def _powers(prime: int, base: int, n: int) -> np.ndarray:
    have = _POWERS.get(prime)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.ones(size, dtype=np.uint32)
        done = 1
        while done < size:
            step = np.uint64(pow(base, done, prime))
            for i in range(0, done, SLAB):
                j = min(done, i + SLAB)
                have[done + i:done + j] = have[i:j].astype(np.uint64) * step % np.uint64(prime)
            done *= 2
        _POWERS[prime] = have
    return have


def _power_at(base: int, exponents: np.ndarray, prime: int) -> np.ndarray:
    """base**e modulo prime for an array of exponents, by squaring."""
    out = np.ones(len(exponents), dtype=np.uint64)
    square, left = base, exponents.astype(np.uint64)
    while left.any():
        out = np.where(left & np.uint64(1), out * np.uint64(square) % np.uint64(prime), out)
        square = square * square % prime
        left = left >> np.uint64(1)
    return out


class PrefixHashes:
    """Prefix arrays over texts laid end to end; ``start[i]`` and ``length[i]`` place text i."""

    def __init__(self, texts: list[str]):
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        self.length = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.start = np.concatenate(([0], np.cumsum(self.length)))[:-1]
        self.sums = []
        for prime, base in PRIMES:
            powers = _powers(prime, base, len(codes) + 1)
            out = np.zeros(len(codes) + 1, dtype=np.uint32)
            for i in range(0, len(codes), SLAB):
                j = min(len(codes), i + SLAB)
                part = (codes[i:j].astype(np.uint64) + np.uint64(1)) * powers[i:j] % np.uint64(prime)
                np.cumsum(part, out=part)
                out[i + 1:j + 1] = (part + np.uint64(out[i])) % np.uint64(prime)
            self.sums.append(out)

    def _span(self, k: int, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        prime, sums = PRIMES[k][0], self.sums[k]
        return (sums[at + size].astype(np.uint64) + np.uint64(prime) - sums[at]) % np.uint64(prime)

    def equal_spans(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the spans of ``size`` code points at places a and b are equal."""
        same = np.ones(len(a), dtype=bool)
        for k, (prime, _) in enumerate(PRIMES):
            powers = _POWERS[prime]
            same &= (self._span(k, a, size) * powers[b] % np.uint64(prime)
                     == self._span(k, b, size) * powers[a] % np.uint64(prime))
        return same

    def extension(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, backwards: bool = False) -> np.ndarray:
        """Longest common extension of places a and b, at most ``most``, by binary search."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self.equal_spans(a - middle, b - middle, middle) if backwards else self.equal_spans(a, b, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def _first_equal(self, at: np.ndarray, place: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The smallest shift under ``WINDOW`` for which the ``ANCHOR`` code points from ``place`` on (before ``end``)
        equal those from ``at`` on, or -1."""
        out = np.full(len(at), -1)
        prime, powers = PRIMES[0][0], _POWERS[PRIMES[0][0]]
        for lo in range(0, len(at), 4096):
            a, e = at[lo:lo + 4096, None], end[lo:lo + 4096, None]
            spots = place[lo:lo + 4096, None] + np.arange(WINDOW)[None, :]
            inside = spots + ANCHOR <= e
            spots = np.where(inside, spots, 0)
            same = inside & (self._span(0, a, ANCHOR) * powers[spots] % np.uint64(prime)
                             == self._span(0, spots, ANCHOR) * powers[a] % np.uint64(prime))
            shift, rows = same.argmax(axis=1), np.arange(len(a))
            hit = same[rows, shift]
            hit[hit] = self.equal_spans(a[hit, 0], spots[rows, shift][hit], np.full(int(hit.sum()), ANCHOR))
            out[lo:lo + 4096] = np.where(hit, shift, -1)
        return out

    def likeness(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Of texts number x and y: code points of common pieces, in order, over the longer length.

        The pieces are the common prefix, the common suffix, and between them those that ``ROUNDS`` rounds find: past a
        mismatch, an anchor from the first text (its next code points, or those ``SKIPS`` later) is looked
        up in the second one's next code points, and the piece around it is extended both ways.
        """
        a, b, n, m = self.start[x], self.start[y], self.length[x], self.length[y]
        short, long = np.minimum(n, m), np.maximum(n, m)
        head = self.extension(a, b, short)
        tail = self.extension(a + n, b + m, short - head, backwards=True)
        covered = head + tail
        i, j, end_i, end_j = a + head, b + head, a + n - tail, b + m - tail
        live = np.flatnonzero(np.minimum(end_i - i, end_j - j) >= ANCHOR)
        for _ in range(ROUNDS):
            if not len(live):
                break
            skip, shift = np.full(len(live), -1), np.full(len(live), -1)
            for s in SKIPS:
                todo = np.flatnonzero((shift < 0) & (end_i[live] - i[live] - s >= ANCHOR))
                found = self._first_equal(i[live[todo]] + s, j[live[todo]], end_j[live[todo]])
                skip[todo], shift[todo] = np.where(found >= 0, s, -1), found
            anchored = shift >= 0
            live, skip, shift = live[anchored], skip[anchored], shift[anchored]
            p, q = i[live] + skip, j[live] + shift
            back = self.extension(p, q, np.minimum(skip, shift), backwards=True)
            ahead = self.extension(p, q, np.minimum(end_i[live] - p, end_j[live] - q))
            covered[live] += back + ahead
            i[live], j[live] = p + ahead, q + ahead
            live = live[np.minimum(end_i[live] - i[live], end_j[live] - j[live]) >= ANCHOR]
        return np.where(long == 0, 1.0, covered / np.maximum(long, 1))

    def fingerprints(self) -> list[str]:
        columns = [self.length]
        n = self.length
        cuts = [n * i // PARTS for i in range(PARTS + 1)]
        for k, (prime, base) in enumerate(PRIMES):
            inverse = pow(base, -1, prime)
            spans = [(cuts[0], cuts[-1])] + (list(zip(cuts, cuts[1:], strict=False)) if k == 0 else [])
            for lo, hi in spans:
                at = self.start + lo
                columns.append(self._span(k, at, hi - lo) * _power_at(inverse, at, prime) % np.uint64(prime))
        return ["-".join(f"{int(v):08x}" for v in row) for row in zip(*columns, strict=True)]


def _results(docs: list[tuple[int, str]], following: list[tuple[int, str]]) -> pa.RecordBatch:
    """Rows of ``RESULT`` for documents (key, text) and the document after each."""
    texts, then = [t for _, t in docs], [t for _, t in following]
    edited = []
    for text, after in zip(texts, then, strict=True):
        n, cut = len(text), len(text) // 3
        edited.append(text[:n - cut] + after[:cut])
    # the documents after are the documents themselves but for the first, and one more
    same = [b is a for a, b in zip(texts[1:], then, strict=False)]
    chained = all(same)
    hashes = PrefixHashes(texts + edited + ([then[-1]] if chained else then))
    prints = hashes.fingerprints()
    n = len(docs)
    doc, new = np.arange(n), n + np.arange(n)
    after = np.concatenate((np.arange(1, n), [2 * n])) if chained else 2 * n + np.arange(n)
    ids = [k if k != _LOWEST else None for k, _ in docs]
    return pa.table({
        "doc_id": ids, "n_chars": hashes.length[doc],
        "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited],
        "fingerprint": prints[:n], "edited_fingerprint": prints[n:2 * n],
        "near_edited": hashes.likeness(doc, new), "near_next": hashes.likeness(doc, after),
        "next_doc_id": [k if k != _LOWEST else None for k, _ in following]}).cast(_ARROW).combine_chunks().to_batches()[0]


_ARROW = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                    ("near_edited", pa.float64()), ("near_next", pa.float64()), ("next_doc_id", pa.int64())])
_EDGES = "part int, head boolean, tail boolean, key long, text string"


def _stream(slab_chars: int):
    """Results of a range's documents in order, but for its last; that one and the first are given with their texts."""
    def stream(batches):
        part = TaskContext.get().partitionId()
        none = [pa.nulls(1, f.type) for f in _ARROW]
        empty_edge = [pa.int32(), pa.bool_(), pa.bool_(), pa.int64(), pa.string()]
        names = [*_ARROW.names, *[c.split()[0] for c in _EDGES.split(", ")]]

        def edge(head: bool, tail: bool, doc: tuple[int, str]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [*none, *[pa.array([v], t) for v, t in zip((part, head, tail, *doc), empty_edge, strict=True)]], names)

        def done(docs: list, following: list) -> pa.RecordBatch:
            rows = _results(docs, following)
            return pa.RecordBatch.from_arrays(
                [*rows.columns, *[pa.nulls(rows.num_rows, t) for t in empty_edge]], names)

        held: list[tuple[int, str]] = []                  # documents whose successors are not all here
        size, first = 0, True
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                text = text or ""
                if first:
                    yield edge(True, False, (key, text))
                    first = False
                held.append((key, text))
                size += len(text)
                if size >= slab_chars and len(held) > 1:
                    yield done(held[:-1], held[1:])
                    held = held[-1:]
                    size = len(text)
        if len(held) > 1:
            yield done(held[:-1], held[1:])
        if held:
            yield edge(False, True, held[-1])
    return stream


def _last_of_ranges(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            doc = (batch.column("key")[i].as_py(), batch.column("text")[i].as_py())
            yield _results([doc], [(batch.column("next_key")[i].as_py(), batch.column("next_text")[i].as_py())])


def fingerprints(docs: DataFrame, range_bytes: int = RANGE_BYTES, slab_chars: int = SLAB_CHARS) -> DataFrame:
    """Fingerprint of every row of ``docs``, of its edited text, and their likeness (``RESULT``)."""
    n_rows, n_bytes = text_bytes(docs)
    ranges = min(max(MIN_CHUNKS, -(-n_bytes // range_bytes)), max(1, n_rows))
    keyed = docs.select(F.coalesce("doc_id", F.lit(_LOWEST)).alias("key"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "text")
    order = [F.col("key").desc(), F.col("h")]
    rows = stored(keyed.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select("key", "text")
                  .mapInArrow(_stream(slab_chars), f"{RESULT}, {_EDGES}"), "fingerprints")
    names = _ARROW.names
    # one head and one tail for each range that has rows; a range's successor is the next such one
    heads = rows.filter("head").select(F.col("part").alias("next_part"), F.col("key").alias("next_key"), F.col("text").alias("next_text"))
    numbers = rows.filter("head").select("part")
    successor = numbers.select("part", F.coalesce(F.lead("part").over(Window.orderBy("part")),
                                                  numbers.agg(F.min("part")).scalar()).alias("next_part"))
    last = (rows.filter("tail").select("part", "key", "text").join(stored(successor, "ranges"), "part").join(heads, "next_part")
            .select("key", "text", "next_key", "next_text").mapInArrow(_last_of_ranges, RESULT))
    return rows.filter("part IS NULL").select(*names).unionByName(last)
