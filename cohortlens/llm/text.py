"""Shared text helpers of the llm operators: table access, chunks, word hashes.

A *chunk* is a bounded group of documents, keyed by a hash of the document id,
so it holds the same documents however Spark lays the rows out or retries a
task. Several operators visit the chunks more than once; the shuffle by chunk
is the same sub-plan each time and Spark reuses it.

Words are the runs of characters outside ``[\\x20\\x09-\\x0D]``. They are hashed
to 64 bits with numpy over the UTF-8 bytes of a whole chunk, and a run of n
words to the polynomial of its word hashes, so no word is built as a Python
string.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
CHUNK_BYTES = 4 << 20           # text of a chunk, about
MIN_CHUNKS = 48                 # so that small inputs still use every core
SLAB_BYTES = 1 << 20            # text hashed at once inside a chunk


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """(rows, bytes of text), one aggregate."""
    row = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()
    return int(row[0]), int(row[1])


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def chunk_number(key: Column, chunks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(chunks)).cast("int")


def count_chunks(n_bytes: int, chunk_bytes: int = CHUNK_BYTES) -> int:
    return max(MIN_CHUNKS, math.ceil(n_bytes / chunk_bytes))


# --------------------------------------------------------------- word hashes

_RNG = np.random.default_rng(0x5EED)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 // 8 * 8 + 3                  # odd, and (base - 1) is not a multiple of 4
_BASE_INV = pow(_BASE, -1, 2**64)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[ord(c) for c in SPACES]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept between calls."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.ones(size, dtype=np.uint64)
        done = 1
        while done < size:                                # doubling: one product per half
            have[done:2 * done] = have[:done] * np.uint64(pow(base, done, 2**64))
            done *= 2
        _POWERS[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(texts, fold_case: bool = False, breaks: np.ndarray = _IS_SPACE):
    """(bytes of the texts end to end, start and end of each word, first word of each text + the total).

    ``breaks`` marks the bytes between words. A null text has no words.
    """
    raw = [b"" if t is None else t.encode() for t in texts]
    buf = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    lengths = np.fromiter((len(r) + 1 for r in raw), dtype=np.int64, count=len(raw))
    ends_of_text = np.cumsum(lengths)
    if fold_case:
        buf = _LOWER[buf]
    space = breaks[buf]
    inside = ~space
    starts = np.flatnonzero(inside & np.concatenate(([True], space[:-1])))
    ends = np.flatnonzero(space & np.concatenate(([False], inside[:-1])))
    return buf, starts, ends, np.concatenate(([0], np.searchsorted(starts, ends_of_text)))


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes; spans in order and apart."""
    hashes = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):                                # slabs bound the 8-byte arrays
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + SLAB_BYTES)))
        lo, hi = int(starts[i]), int(ends[j - 1])
        sums = np.zeros(hi - lo + 1, dtype=np.uint64)
        np.cumsum(_BYTE[buf[lo:hi]] * _powers(_BASE, hi - lo), out=sums[1:])
        at = starts[i:j] - lo
        hashes[i:j] = (sums[ends[i:j] - lo] - sums[at]) * _powers(_BASE_INV, hi - lo)[at]
        i = j
    return mix(hashes)


def word_hashes(texts, fold_case: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text + the total), texts in order."""
    buf, starts, ends, first = word_spans(texts, fold_case)
    return span_hashes(buf, starts, ends), first


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, .. of lengths[i] values each, one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) - np.repeat(before - starts, lengths)


def batches_of(texts, most: int = 1 << 20):
    """(first, last) of runs of texts of about ``most`` characters."""
    yield from batches_of_sizes([len(t or "") for t in texts], most)


def batches_of_sizes(sizes: list[int], most: int = 1 << 20):
    """``batches_of`` texts of these sizes."""
    at = 0
    while at < len(sizes):
        end, size = at, 0
        while end < len(sizes) and (end == at or size + sizes[end] <= most):
            size += sizes[end]
            end += 1
        yield at, end
        at = end


def window_hashes(words: np.ndarray, n: int, step: np.uint64 = _STEP) -> np.ndarray:
    """Hash of every run of n consecutive words (len(words) - n + 1 of them, or none)."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = words[:count].copy()
    for j in range(1, n):
        out *= step
        out += words[j:j + count]
    return mix(out)


def window_starts(first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions where a run of n words lies inside one text, that text's number)."""
    counts = np.maximum(np.diff(first) - n + 1, 0)
    text_no = np.repeat(np.arange(len(counts)), counts)
    before = np.concatenate(([0], np.cumsum(counts)))[:-1]
    return np.arange(len(text_no)) - before[text_no] + first[text_no], text_no
