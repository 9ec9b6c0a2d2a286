"""Substring dedup: remove word runs that also start in a document with a smaller id.

Method: fixed-block anchors. Every document is cut into non-overlapping
reference blocks of ``(window + 1) // 2`` words. Any run of ``window`` words of
a document holds one whole block of it, so a rolling probe of block length
finds each repeated run at least once. Hits are extended to the runs around
them, and those are compared exactly, which gives the maximal repeats.

Three visits to the chunks of documents (``text.py``):

1. each chunk sends the distinct hashes of its rolling probes and its reference
   blocks to hash buckets, as packed 32-bit arrays. A bucket answers every
   chunk with those that another chunk holds too and that are a block
   somewhere. Copies inside a chunk collapse before the shuffle, so one very
   common passage costs a chunk one entry;
2. around each hit, the chunk sends the hashes (96 bits) of the windows that
   cover it, with its smallest document. A bucket answers with the windows that
   start in a smaller document elsewhere;
3. the chunk marks the words of those windows, and of windows with a smaller
   document inside the chunk, and drops them.

The 32-bit hashes of the first visit are a filter: a false hit only adds
windows to compare. Nothing is capped, and no pair of documents is formed.

Defined results: a null or empty text has no words and gives an empty kept
text; a null doc_id is larger than all others; rows with one doc_id are one
document and do not remove words from each other; texts under ``window`` words
lose nothing; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import chunk_number, count_chunks, text_bytes, window_hashes, window_starts, word_hashes

BUCKET_BYTES = 16 << 20         # text whose probes meet in one bucket, about
MIN_BUCKETS = 48
_CHECK_STEP = np.uint64(0xA24BAED4963EE407)
_WINDOW = np.dtype([("h", "<u8"), ("c", "<u4")])
_LAST = np.iinfo(np.int64).max

RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def split_by_bucket(buckets: np.ndarray, *arrays: np.ndarray):
    """(bucket, parts of the arrays) for each bucket that has entries."""
    order = np.argsort(buckets, kind="stable")
    sorted_buckets = buckets[order]
    cuts = np.flatnonzero(np.diff(sorted_buckets)) + 1
    for part in np.split(order, cuts) if len(order) else []:
        yield int(buckets[part[0]]), [a[part] for a in arrays]


def _probes(group: pa.Table, block: int):
    """Rolling probes of a chunk: (hash, text number, is a reference block, position, first)."""
    words, first = word_hashes(group["text"].to_pylist())
    at, text_no = window_starts(first, block)
    return window_hashes(words, block)[at], text_no, (at - first[text_no]) % block == 0, at, words, first


def _bucket_of(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(n)).astype(np.int32)


def _send_probes(block: int, n_buckets: int):
    def send(key: tuple, group: pa.Table) -> pa.Table:
        hashes, _, aligned, _, _, _ = _probes(group, block)
        every, inverse = np.unique(hashes, return_inverse=True)
        is_block = np.zeros(len(every), dtype=bool)
        is_block[inverse[aligned]] = True
        rows = [(b, part[is_ref].tobytes(), part[~is_ref].tobytes()) for b, (part, is_ref) in split_by_bucket(
            _bucket_of(every, n_buckets), every.astype("<u4"), is_block)]
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int32()),
                         "chunk": pa.array([key[0].as_py()] * len(rows), pa.int32()),
                         "blocks": pa.array([r[1] for r in rows], pa.binary()),
                         "probes": pa.array([r[2] for r in rows], pa.binary())})
    return send


def _match_probes(key: tuple, group: pa.Table) -> pa.Table:
    blocks = [np.unique(np.frombuffer(x, "<u4")) for x in group["blocks"].to_pylist()]
    entries = [np.unique(np.concatenate((b, np.frombuffer(x, "<u4"))))
               for b, x in zip(blocks, group["probes"].to_pylist(), strict=True)]
    value, count = np.unique(np.concatenate(entries), return_counts=True)
    shared = np.intersect1d(value[count > 1], np.concatenate(blocks))
    found = [e[np.isin(e, shared, assume_unique=True)] for e in entries]
    keep = [i for i, f in enumerate(found) if len(f)]
    return pa.table({"chunk": group["chunk"].take(pa.array(keep, pa.int64())).combine_chunks(),
                     "bucket": pa.array([key[0].as_py()] * len(keep), pa.int32()),
                     "hits": pa.array([found[i].tobytes() for i in keep], pa.binary())})


def _doc_ids(group: pa.Table) -> np.ndarray:
    return group["doc_id"].fill_null(_LAST).to_numpy().astype(np.int64)


def _windows(words: np.ndarray, first: np.ndarray, window: int):
    """(key, position, text number) of every window of a chunk."""
    at, text_no = window_starts(first, window)
    keys = np.empty(len(at), dtype=_WINDOW)
    keys["h"] = window_hashes(words, window)[at]
    keys["c"] = window_hashes(words, window, _CHECK_STEP)[at].astype("<u4")
    return keys, at, text_no


def _smallest(keys: np.ndarray, docs: np.ndarray):
    """(order, group number in that order, smallest doc of each group); keys with equal h and c are a group."""
    order = np.lexsort((docs, keys["c"], keys["h"]))
    k, d = keys[order], docs[order]
    new = np.ones(len(k), dtype=bool)
    new[1:] = (k["h"][1:] != k["h"][:-1]) | (k["c"][1:] != k["c"][:-1])
    return order, np.cumsum(new) - 1, d[new]


def _send_windows(block: int, window: int, n_buckets: int):
    def send(key: tuple, group: pa.Table, answers: pa.Table) -> pa.Table:
        hashes, text_no, aligned, at, words, first = _probes(group, block)
        docs = _doc_ids(group)
        every, inverse = np.unique(hashes, return_inverse=True)
        # inside the chunk: a block somewhere, and in two documents
        is_block = np.zeros(len(every), dtype=bool)
        is_block[inverse[aligned]] = True
        low = np.full(len(every), _LAST)
        high = np.full(len(every), -_LAST)
        np.minimum.at(low, inverse, docs[text_no])
        np.maximum.at(high, inverse, docs[text_no])
        hit = is_block & (low < high)
        places = _bucket_of(every, n_buckets)
        small = every.astype("<u4")
        for b, x in zip(answers["bucket"].to_pylist(), answers["hits"].to_pylist(), strict=True):
            mine = np.flatnonzero(places == b)
            hit[mine[np.isin(small[mine], np.frombuffer(x, "<u4"))]] = True
        near = np.zeros(len(words) + 1, dtype=np.int64)
        near[1 + at[hit[inverse]]] = 1
        near = np.cumsum(near)
        keys, starts, in_text = _windows(words, first, window)
        near_hit = near[np.minimum(starts + window - block + 1, len(words))] > near[starts]
        keys, owners = keys[near_hit], docs[in_text[near_hit]]
        order, group_no, smallest = _smallest(keys, owners)
        one = order[np.flatnonzero(np.concatenate(([True], np.diff(group_no) > 0)))] if len(order) else order
        keys = keys[one]
        by_doc = np.argsort(smallest, kind="stable")      # equal ids side by side compress well
        keys, smallest = keys[by_doc], smallest[by_doc]
        rows = [(b, k["h"].tobytes(), k["c"].tobytes(), d.tobytes()) for b, (k, d) in split_by_bucket(
            _bucket_of(keys["h"], n_buckets), keys, smallest)]
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int32()),
                         "chunk": pa.array([key[0].as_py()] * len(rows), pa.int32()),
                         "h": pa.array([r[1] for r in rows], pa.binary()),
                         "c": pa.array([r[2] for r in rows], pa.binary()),
                         "d": pa.array([r[3] for r in rows], pa.binary())})
    return send


def _match_windows(key: tuple, group: pa.Table) -> pa.Table:
    parts = [np.frombuffer(x, "<u8") for x in group["h"].to_pylist()]
    keys = np.empty(sum(map(len, parts)), dtype=_WINDOW)
    keys["h"] = np.concatenate(parts)
    keys["c"] = np.frombuffer(b"".join(group["c"].to_pylist()), "<u4")
    docs = np.frombuffer(b"".join(group["d"].to_pylist()), "<i8")
    owner = np.repeat(group["chunk"].to_numpy(), [len(p) for p in parts])
    order, group_no, smallest = _smallest(keys, docs)
    later = docs[order] > smallest[group_no]
    keys, owner = keys[order][later], owner[order][later]
    rows = [(c, k["h"].tobytes(), k["c"].tobytes()) for c, (k,) in split_by_bucket(owner, keys)]
    return pa.table({"chunk": pa.array([r[0] for r in rows], pa.int32()),
                     "h": pa.array([r[1] for r in rows], pa.binary()),
                     "c": pa.array([r[2] for r in rows], pa.binary())})


def _remove(window: int):
    def remove(key: tuple, group: pa.Table, answers: pa.Table) -> pa.Table:
        texts, docs = group["text"].to_pylist(), _doc_ids(group)
        words, first = word_hashes(texts)
        keys, at, text_no = _windows(words, first, window)
        owners = docs[text_no]
        order, group_no, smallest = _smallest(keys, owners)
        repeated = np.zeros(len(keys), dtype=bool)
        repeated[order] = owners[order] > smallest[group_no]
        elsewhere = np.empty(sum(len(x) for x in answers["h"].to_pylist()) // 8, dtype=_WINDOW)
        elsewhere["h"] = np.frombuffer(b"".join(answers["h"].to_pylist()), "<u8")
        elsewhere["c"] = np.frombuffer(b"".join(answers["c"].to_pylist()), "<u4")
        maybe = np.flatnonzero(np.isin(keys["h"], elsewhere["h"]))
        both = np.isin(keys[maybe], elsewhere) if len(maybe) else np.zeros(0, dtype=bool)
        repeated[maybe[both]] = True
        edges = np.zeros(len(words) + 1, dtype=np.int32)
        np.add.at(edges, at[repeated], 1)
        np.add.at(edges, at[repeated] + window, -1)
        keep = np.cumsum(edges[:-1]) == 0
        kept_text = []
        for i, text in enumerate(texts):
            own = keep[first[i]:first[i + 1]]
            parts = [] if text is None else text.encode().split()
            kept_text.append(b" ".join(parts if own.all() else compress(parts, own)))
        n_words = np.diff(first)
        n_kept = np.diff(np.concatenate(([0], np.cumsum(keep)))[first])
        return pa.table({"doc_id": group["doc_id"].combine_chunks(), "n_words": n_words.astype(np.int64),
                         "n_removed": (n_words - n_kept).astype(np.int64),
                         "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept_text], pa.string()),
                         "kept_text": pa.array([x.decode() for x in kept_text], pa.string())})
    return remove


def substring_dedup(docs: DataFrame, window: int = 13, chunk_bytes: int | None = None) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept_text) of every row of ``docs``."""
    _, n_bytes = text_bytes(docs)
    n_chunks = count_chunks(n_bytes, *([chunk_bytes] if chunk_bytes else []))
    n_buckets = max(MIN_BUCKETS, -(-n_bytes // BUCKET_BYTES))
    block = (window + 1) // 2
    chunks = docs.select(chunk_number(F.col("doc_id"), n_chunks).alias("chunk"), "doc_id", "text").groupBy("chunk")
    hits = (chunks.applyInArrow(_send_probes(block, n_buckets), "bucket int, chunk int, blocks binary, probes binary")
            .groupBy("bucket").applyInArrow(_match_probes, "chunk int, bucket int, hits binary"))
    repeats = (chunks.cogroup(hits.groupBy("chunk"))
               .applyInArrow(_send_windows(block, window, n_buckets),
                             "bucket int, chunk int, h binary, c binary, d binary")
               .groupBy("bucket").applyInArrow(_match_windows, "chunk int, h binary, c binary"))
    return chunks.cogroup(repeats.groupBy("chunk")).applyInArrow(_remove(window), RESULT)
