"""N-gram Jaccard join: classes of documents whose word-shingle sets are alike.

Two documents link when ``100 * |A & B| >= percent * |A | B|``. Method:
multiple-global-order filtering. Every shingle has a place in several global
orders; all put rare shingles first (by the class of their document count) and
each breaks ties with its own hash. If two sets of sizes m <= n link, they share
at least ``ceil(percent * n / 100)`` shingles, so under every order the first
``n - ceil(percent * n / 100) + 1`` shingles of both have one in common.
Candidates from the first order's posting lists must share prefix shingles
under each of the other orders too, and enough of them that what follows the
prefixes can still make a link; only the pairs in that intersection get the full sets.

Steps:

1. documents with equal sets collapse to their smallest id (partial aggregate);
2. chunks send the distinct shingles of those representatives to hash buckets
   (32-bit, packed) and get back the count classes of shared ones. A document
   whose whole prefix is its own can link with nothing and leaves here;
3. posting lists of the remaining prefixes, with each shingle's place in the
   order: a pair is a candidate only where what follows the shared place still
   allows a link. First each list is tied to the document that holds its shingle
   earliest: one pair per document and distinct leader, whatever the list's
   size. Documents that are verified links merge into components;
4. lists whose documents are all in one component need nothing more. In the
   others, each document outside the list's largest component is compared with
   the list's documents of other components. So no pair that could still
   connect two components is left out, and groups of near copies, however
   large, never make all their pairs.

The count class of a shingle is only an order, so a hash clash there cannot lose
a link; sets are compared by 64-bit shingle hashes.

Defined results: a null text, or one without words, has an empty set and is
linked with nothing; fewer words than ``size`` make one shingle of them all; rows
with one doc_id are one document; a null doc_id is linked with nothing and has a
null component; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import components, stored
from .substring_dedup import split_by_bucket
from .text import chunk_number, count_chunks, mix, text_bytes, window_hashes, window_starts, word_hashes

ORDERS = 3
CARRIED = 64                    # prefixes up to this length travel with their lists; longer ones do without
BUCKET_BYTES = 16 << 20
MIN_BUCKETS = 48
_SEEDS = np.random.default_rng(11).integers(1, 2**63, 8, dtype=np.uint64)


def shingle_sets(texts, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words, first = word_hashes(texts, fold_case=True)
    at, text_no = window_starts(first, size)
    every = window_hashes(words, size)[at]
    cuts = np.searchsorted(text_no, np.arange(len(first)))
    n_words = np.diff(first)
    out = []
    for i in range(len(n_words)):
        if n_words[i] >= size:
            out.append(np.unique(every[cuts[i]:cuts[i + 1]]))
        else:                                             # none, or the whole sequence as one
            w = words[first[i]:first[i + 1]]
            out.append(window_hashes(w, len(w)) ^ np.uint64(len(w)) if len(w) else w)
    return out


def _bucket_of(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(n)).astype(np.int32)


def _digests(size: int):
    def digests(key: tuple, group: pa.Table) -> pa.Table:
        sets = shingle_sets(group["text"].to_pylist(), size)
        sums = [[int(mix(s ^ seed).sum(dtype=np.uint64).astype(np.int64)) for s in sets] for seed in _SEEDS[:2]]
        return pa.table({"doc_id": group["doc_id"].combine_chunks(),
                         "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                         "d1": pa.array(sums[0], pa.int64()), "d2": pa.array(sums[1], pa.int64())})
    return digests


def _own_sets(group: pa.Table, chosen: pa.Table, size: int):
    """(ids, sets) of the chosen documents of a chunk."""
    ids = group["doc_id"].fill_null(-1).to_numpy()
    wanted = np.isin(ids, chosen["rep"].to_numpy()) & group["doc_id"].is_valid().to_numpy()
    index = np.flatnonzero(wanted)
    _, one = np.unique(ids[index], return_index=True)     # repeated rows of an id count once
    index = index[one]
    return ids[index], shingle_sets(group["text"].take(pa.array(index)).to_pylist(), size)


def _flat(sets: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)


def _send_shingles(size: int, n_buckets: int):
    def send(key: tuple, group: pa.Table, chosen: pa.Table) -> pa.Table:
        _, sets = _own_sets(group, chosen, size)
        every, count = np.unique(_flat(sets), return_counts=True)
        count = np.minimum(count, 255).astype(np.uint8)   # only an order; see the class below
        rows = [(b, part[n == 1].tobytes(), part[n > 1].tobytes(), n[n > 1].tobytes())
                for b, (part, n) in split_by_bucket(_bucket_of(every, n_buckets), every.astype("<u4"), count)]
        return pa.table({"bucket": pa.array([r[0] for r in rows], pa.int32()),
                         "chunk": pa.array([key[0].as_py()] * len(rows), pa.int32()),
                         "once": pa.array([r[1] for r in rows], pa.binary()),
                         "more": pa.array([r[2] for r in rows], pa.binary()),
                         "counts": pa.array([r[3] for r in rows], pa.binary())})
    return send


def _count_shingles(key: tuple, group: pa.Table) -> pa.Table:
    once = [np.frombuffer(x, "<u4") for x in group["once"].to_pylist()]
    more = [np.frombuffer(x, "<u4") for x in group["more"].to_pylist()]
    counts = [np.frombuffer(x, np.uint8) for x in group["counts"].to_pylist()]
    values = np.concatenate(once + more)
    weight = np.concatenate([np.ones(sum(map(len, once)))] + counts)
    value, inverse = np.unique(values, return_inverse=True)
    total = np.bincount(inverse, weights=weight)
    shared, grade = value[total > 1], np.log2(total[total > 1]).astype(np.uint8)
    rows = []
    for chunk, a, b in zip(group["chunk"].to_pylist(), once, more, strict=True):
        mine = np.isin(shared, np.concatenate((a, b)))
        if mine.any():
            rows.append((chunk, key[0].as_py(), shared[mine].tobytes(), grade[mine].tobytes()))
    return pa.table({"chunk": pa.array([r[0] for r in rows], pa.int32()),
                     "bucket": pa.array([r[1] for r in rows], pa.int32()),
                     "shared": pa.array([r[2] for r in rows], pa.binary()),
                     "grades": pa.array([r[3] for r in rows], pa.binary())})


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _prefixes(size: int, percent: int, n_buckets: int):
    def prefixes(key: tuple, group: pa.Table, other: pa.Table) -> pa.Table:
        chosen = other.filter(other["rep"].is_valid())
        answers = other.filter(other["bucket"].is_valid())
        ids, sets = _own_sets(group, chosen, size)
        values = _flat(sets)
        every, inverse = np.unique(values, return_inverse=True)
        grade = np.zeros(len(every), dtype=np.uint8)
        order = np.argsort(_bucket_of(every, n_buckets), kind="stable")
        places = _bucket_of(every, n_buckets)[order]
        for b, shared, grades in zip(answers["bucket"].to_pylist(), answers["shared"].to_pylist(),
                                     answers["grades"].to_pylist(), strict=True):
            mine = order[np.searchsorted(places, b):np.searchsorted(places, b, side="right")]
            shared = np.frombuffer(shared, "<u4")
            at = np.minimum(np.searchsorted(shared, every[mine].astype("<u4")), len(shared) - 1)
            same = shared[at] == every[mine].astype("<u4")
            grade[mine[same]] = np.frombuffer(grades, np.uint8)[at[same]]
        grades, start, rows = grade[inverse], 0, []
        for doc, s in zip(ids, sets, strict=True):
            own = grades[start:start + len(s)]
            start += len(s)
            p = prefix_length(len(s), percent)
            if np.count_nonzero(own == 0) >= p:
                continue
            first = [np.lexsort((mix(s ^ seed), own))[:p] for seed in _SEEDS[2:2 + ORDERS]]
            places = np.flatnonzero(own[first[0]] > 0)    # shingles of one document only join nothing
            others = [np.sort(s[f[own[f] > 0]]) for f in first[1:]]
            rows.append((doc, len(s), s[first[0][places]].astype(np.int64), places.astype(np.int32),
                         b"".join(f.tobytes() for f in others), [len(f) for f in others], s.tobytes()))
        return pa.table({"id": pa.array([r[0] for r in rows], pa.int64()),
                         "n": pa.array([r[1] for r in rows], pa.int64()),
                         "prefix": pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                         "places": pa.array([r[3] for r in rows], pa.list_(pa.int32())),
                         "others": pa.array([r[4] for r in rows], pa.binary()),
                         "lengths": pa.array([r[5] for r in rows], pa.list_(pa.int32())),
                         "shingles": pa.array([r[6] for r in rows], pa.binary())})
    return prefixes


def _share(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int(np.count_nonzero(b[at] == a))


def _need(n_x: int, n_y: int, percent: int) -> int:
    """Shingles that sets of these sizes must share to link."""
    return -(-percent * (n_x + n_y) // (100 + percent))


def _orders_agree(percent: int):
    """The pairs whose prefixes share enough under each of the other orders: at least one shingle, and, with
    all that follows the prefixes, enough for a link."""
    def agree(batches):
        for batch in batches:
            a, b = [], []
            columns = [batch.column(c).to_pylist() for c in ("a", "b", "n_a", "n_b", "others_a", "others_b", "lengths_a", "lengths_b")]
            for id_x, id_y, n_x, n_y, xs, ys, p_x, p_y in zip(*columns, strict=True):
                xs, ys, i, j = np.frombuffer(xs, "<u8"), np.frombuffer(ys, "<u8"), 0, 0
                least = max(1, _need(n_x, n_y, percent) - max(n_x - prefix_length(n_x, percent), n_y - prefix_length(n_y, percent)))
                for p, q in zip(p_x, p_y, strict=True):
                    if _share(xs[i:i + p], ys[j:j + q]) < least:
                        break
                    i, j = i + p, j + q
                else:
                    a.append(id_x)
                    b.append(id_y)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return agree


def _verify(percent: int):
    def verify(batches):
        for batch in batches:
            a, b = [], []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                same = _share(np.frombuffer(x["shingles"], "<u8"), np.frombuffer(y["shingles"], "<u8"))
                if 100 * same >= percent * (x["n"] + y["n"] - same):
                    a.append(x["id"])
                    b.append(y["id"])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return verify


def _links(pairs: DataFrame, kept: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link. The other orders' prefixes travel first; full sets only to what they leave."""
    light = lambda side: kept.select(
        F.col("id").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("n", "others", "lengths")])
    left = stored(pairs.join(light("a"), "a").join(light("b"), "b").select(
        "a", "b", "n_a", "n_b", "others_a", "others_b", "lengths_a", "lengths_b")
        .mapInArrow(_orders_agree(percent), "a long, b long"), "candidates")
    body = F.struct("id", "n", "shingles")
    x = kept.select(F.col("id").alias("a"), body.alias("x"))
    y = kept.select(F.col("id").alias("b"), body.alias("y"))
    return left.join(x, "a").join(y, "b").select("x", "y").mapInArrow(_verify(percent), "a long, b long")


def _may_link(n_x, place_x, n_y, place_y, percent: int):
    """A shingle shared at these places of the first order allows a link: if it is the
    first shared one, the sets share at most what follows it in either."""
    need = F.ceil(F.lit(percent) * (n_x + n_y) / F.lit(100 + percent))
    return F.least(n_x - place_x, n_y - place_y) >= need


def _first_meeting(percent: int):
    """For prefixes that are carried: a pair meets at its first shared shingle only, and
    only if the shared ones and all that follows the shorter prefix can make a link."""
    common = F.array_intersect("prefix_a", "prefix_b")    # in the first order, as the prefixes are
    after = lambda n: F.ceil(F.lit(percent) * F.col(n) / 100) - 1
    need = F.ceil(F.lit(percent) * (F.col("n_a") + F.col("n_b")) / F.lit(100 + percent))
    return F.when(F.col("prefix_a").isNotNull() & F.col("prefix_b").isNotNull(),
                  (F.get(common, F.lit(0)) == F.col("token"))
                  & (F.size(common) + F.greatest(after("n_a"), after("n_b")) >= need)).otherwise(True)


def jaccard_join(docs: DataFrame, size: int = 5, percent: int = 80, chunk_bytes: int | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, representative) of every row of ``docs``."""
    _, n_bytes = text_bytes(docs)
    n_chunks = count_chunks(n_bytes, *([chunk_bytes] if chunk_bytes else []))
    n_buckets = max(MIN_BUCKETS, -(-n_bytes // BUCKET_BYTES))
    chunks = docs.select(chunk_number(F.col("doc_id"), n_chunks).alias("chunk"), "doc_id", "text").groupBy("chunk")

    digests = stored(chunks.applyInArrow(_digests(size), "doc_id long, n_shingles long, d1 long, d2 long"), "digests")
    filled = digests.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    reps = filled.groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("rep"))
    chosen = reps.select(chunk_number(F.col("rep"), n_chunks).alias("chunk"), "rep")

    answers = (chunks.cogroup(chosen.groupBy("chunk"))
               .applyInArrow(_send_shingles(size, n_buckets),
                             "bucket int, chunk int, once binary, more binary, counts binary")
               .groupBy("bucket")
               .applyInArrow(_count_shingles, "chunk int, bucket int, shared binary, grades binary"))
    both = chosen.unionByName(answers, allowMissingColumns=True)
    kept = stored(chunks.cogroup(both.groupBy("chunk")).applyInArrow(
        _prefixes(size, percent, n_buckets), "id long, n long, prefix array<long>, places array<int>, "
        "others binary, lengths array<int>, shingles binary"), "prefixes")

    posts = kept.select("id", "n", F.inline(F.arrays_zip("prefix", "places"))).select(
        F.col("prefix").alias("token"), F.col("places").alias("place"), "id", "n")
    # step 3: every list's documents against the one that holds the shingle earliest,
    # which has the fewest shingles of its own and so stands in the middle of its copies
    # (stored, as are the split lists below: then a join can split the rows of a long list)
    leaders = stored(posts.groupBy("token").agg(F.min(F.struct("place", "id", "n")).alias("lead"),
                                                F.count(F.lit(1)).alias("m")).filter("m > 1"), "leaders")
    tied = (posts.join(leaders, "token")
            .filter((F.col("id") != F.col("lead.id"))
                    & _may_link(F.col("n"), F.col("place"), F.col("lead.n"), F.col("lead.place"), percent))
            .select(F.col("id").alias("a"), F.col("lead.id").alias("b")).distinct())
    links = stored(_links(tied, kept, percent), "links")
    comp = stored(components(kept.select("id"), links), "components")

    # step 4: lists that still hold several components
    lists = posts.join(comp, "id")
    split = stored(lists.groupBy("token").agg(F.mode("comp", deterministic=True).alias("main"),
                                              F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                   .filter("lo < hi").select("token", "main"), "split-lists")
    carried = kept.select("id", F.when(F.size("prefix") <= CARRIED, F.col("prefix")).alias("prefix"))
    rest = stored(lists.join(split, "token").join(carried, "id"), "lists")
    asked = rest.filter(F.col("comp") != F.col("main")).select(
        "token", *[F.col(c).alias(f"{c}_a") for c in ("id", "n", "place", "comp", "prefix")])
    against = rest.select("token", "main", *[F.col(c).alias(f"{c}_b") for c in ("id", "n", "place", "comp", "prefix")])
    meets = ((F.col("comp_a") != F.col("comp_b"))
             & _may_link(F.col("n_a"), F.col("place_a"), F.col("n_b"), F.col("place_b"), percent)
             & _first_meeting(percent)
             # two documents that both ask meet once
             & ((F.col("comp_b") == F.col("main")) | (F.col("id_a") < F.col("id_b"))))
    more = (asked.join(against, "token").filter(meets)
            .select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct())
    links = links.unionByName(stored(_links(more, kept, percent), "links"))
    comp = components(kept.select("id"), links)

    classes = (reps.join(comp.withColumnRenamed("id", "rep"), "rep", "left")
               .select("n_shingles", "d1", "d2", "rep", F.coalesce("comp", "rep").alias("component_id")))
    # the join key of an empty set is null, so such documents stay alone
    keyed = digests.withColumn("k", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("d1")))
    return (keyed.join(classes.select(F.col("n_shingles").alias("_n"), F.col("d1").alias("_d1"),
                                      F.col("d2").alias("_d2"), "rep", "component_id"),
                       (F.col("k") == F.col("_d1")) & (F.col("d2") == F.col("_d2"))
                       & (F.col("n_shingles") == F.col("_n")), "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
                    F.coalesce("rep", "doc_id").alias("representative")))
