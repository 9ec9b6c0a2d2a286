"""One id, or a null id, with a third of all rows; very long texts; the draws of the mix."""
import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from cohortlens.llm import fingerprints, jaccard_join, line_dedup, mixing, packing

SF = "/root/testdata/sf0.001"


def split(text):
    return (text or "").encode().split()


def hot_rows(n=240):
    """A third of the rows under one id, some of them equal, and a sixth under null."""
    rng = random.Random(1)
    text = lambda: " ".join(f"w{rng.randrange(60)}" for _ in range(rng.randrange(1, 40)))
    rows = [(i, text(), rng.choice("ab")) for i in range(n // 2)]
    rows += [(7, "the same words again and again", "a")] * (n // 6) + [(7, text(), rng.choice("ab")) for _ in range(n // 6)]
    return rows + [(None, text() if i % 2 else "null ids too", "b") for i in range(n // 6)]


def test_the_mix_takes_what_its_slots_say(make):
    rows = hot_rows()
    mix = mixing.Mix(make(rows), block_words=8, shard_slots=16)
    times = Counter((r.source_no, r.block) for r in mix.slots.collect())
    placed = mix._placed.collect()
    assert len(placed) == len(rows)
    spans = defaultdict(list)
    for r in placed:
        spans[r.source_no].append((r.start, r.start + r.size))
    for of in spans.values():                             # documents lie end to end in their source
        of.sort()
        assert of[0][0] == 0 and all(a[1] == b[0] for a, b in zip(of, of[1:], strict=False))
    want = Counter()
    for r in placed:
        want[str(r.doc_id), r.size, sum(times[r.source_no, w // 8] for w in range(r.start, r.start + r.size))] += 1
    got = mix.documents().collect()
    assert want == Counter((str(r.doc_id), r.size, r.taken) for r in got)
    texts = Counter()
    for r in mix.texts().collect():
        texts[str(r.doc_id)] += len(split(r.text))
    taken = Counter()
    for r in got:
        taken[str(r.doc_id)] += r.taken
    assert texts == +taken


def test_mix_of_a_hot_id_does_not_depend_on_layout(make):
    rows = hot_rows()
    a, b = (mixing.Mix(make(rows, p), block_words=8, shard_slots=16).documents().collect() for p in (2, 7))
    assert sorted(map(str, a)) == sorted(map(str, b))


@pytest.mark.parametrize("good,bad,draws", [(60, 40, 30), (5, 500, 100), (300, 20, 310)])
def test_large_draws_follow_the_same_law(monkeypatch, good, bad, draws):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(mixing, "_NUMPY_URN", 0)          # the way of very large urns, on a small one
    mine = np.bincount([mixing.hypergeometric(good, bad, draws, rng) for _ in range(20_000)], minlength=draws + 1)
    lowest, highest = max(0, draws - bad), min(good, draws)
    chance = np.array([math.comb(good, k) * math.comb(bad, draws - k) / math.comb(good + bad, draws)
                       if lowest <= k <= highest else 0.0 for k in range(draws + 1)])
    assert mine[chance == 0].sum() == 0
    expected = 20_000 * chance
    often = expected > 5
    assert ((mine[often] - expected[often]) ** 2 / expected[often]).sum() < 2 * often.sum() + 20


def test_draws_of_a_very_large_mix_add_up():
    quotas = np.array([4 * 10**12, 10**12, 7, 0])
    shards = [next(iter(mixing.shard_counts(quotas, 10**10, 3, k, k + 1))) for k in (0, 1, 250, 499)]
    assert all(int(c.sum()) == 10**10 for _, _, c in shards)
    share = shards[0][2][0] / 10**10
    assert share != 0.8 and abs(share - 0.8) < 1e-4       # a draw, not its mean


def test_a_text_of_very_many_lines(make):
    rng = random.Random(2)
    common = [f"this very line stands in several documents, number {i:06d}" for i in range(9000)]
    rows = [(i, "\n".join(common + [f"own {rng.random()}"])) for i in range(5)]
    rows.append((9, "\n".join(["short"] * 200 + common[4000:4001] + ["short"] * 300)))
    got = {r.doc_id: r for r in line_dedup.line_dedup(make(rows)).collect()}
    for i, text in rows:
        keep = [x for x in text.split("\n") if not (len(x) >= 40 and (i < 4 or (i == 4 and x == common[4000])))
                or (i == 9)]
        assert got[i].kept_text == "\n".join(keep) and got[i].n_dropped == got[i].n_lines - len(keep)


def test_one_row_of_a_document_is_left(spark, make):
    text = " ".join(f"word{i}" for i in range(30))
    other = " ".join(f"else{i}" for i in range(30))
    rows = [(1, text), (1, text), (2, text), (None, text), (None, text), (3, other), (3, other + " more"), (None, other),
            (4, None), (4, ""), (5, None), (None, None), (None, "")]
    kept = corpus_pipeline.keep_one_of_near_copies(spark, make(rows), SF).collect()
    found = sorted((r.doc_id, r.text or "") for r in kept if r.doc_id is not None)
    assert found == [(1, text), (3, other), (4, ""), (5, "")]
    assert sorted(r.text or "" for r in kept if r.doc_id is None) == ["", other, text]


def test_stages_keep_odd_rows(spark, make, tmp_path):
    """Null ids, repeated rows and empty texts through all stages; further columns go."""
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(60)), "s") for i in range(30)]
    rows += [(None, "null id " * 20, None), (3, rows[3][1], "s"), (31, None), (32, ""), (33, "one")]
    docs = make(rows)
    for name, stage in corpus_pipeline.STAGES[1:]:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "best_fit_packing":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
        if name == "jaccard_join":
            assert docs.filter("doc_id = 3").count() == 1 and docs.filter("doc_id IS NULL").count() == 1
            assert docs.filter("doc_id IN (31, 32)").count() == 2
    assert docs.filter("doc_id = 0").count() >= 1


def test_packing_goes_on_while_bins_leave(make):
    rng = random.Random(4)
    rows = [(i, " ".join("word" for _ in range(rng.randrange(1, 300)))) for i in range(600)]
    few, all_ = (packing.pack(make(rows, 12), capacity=512, group_bins=4, least_gain=g).select("sequence_id").distinct().count()
                 for g in (0.5, 0.0))
    total = sum(len(split(t)) + 1 for _, t in rows)
    assert -(-total // 512) <= all_ <= few


def test_fingerprints_of_a_hot_id(make):
    rows = [(i, t) for i, t, _ in hot_rows()]
    docs = make(rows)
    got = fingerprints.fingerprints(docs, range_bytes=1000, slab_chars=300).collect()
    assert len(got) == len(rows)
    hashed = {r[0]: r[1] for r in docs.selectExpr("text", "xxhash64(text)").collect()}
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -1), hashed[r[1]]))
    want = Counter()
    for (i, text), (_, then) in zip(order, [*order[1:], order[0]], strict=True):
        cut = len(text) // 3
        want[str(i), len(text), hashlib.sha256((text[:len(text) - cut] + then[:cut]).encode()).hexdigest()] += 1
    assert want == Counter((str(r.doc_id), r.n_chars, r.edited_sha256) for r in got)


def test_documents_of_few_shared_passages(make):
    """Every list holds many small components; links are few, and all of them are found."""
    rng = random.Random(6)
    passages = [" ".join(f"p{k}w{j}" for j in range(40)) for k in range(20)]
    rows = [(i, " ".join(passages[k] for k in rng.sample(range(20), 5))) for i in range(300)]
    rows += [(1000 + i, rows[i][1] + " one more") for i in range(20)]

    def shingles(text):
        w = text.split()
        return {tuple(w[k:k + 5]) for k in range(len(w) - 4)}

    sets, parent = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            same = len(sets[i] & sets[j])
            if 100 * same >= 80 * (len(sets[i]) + len(sets[j]) - same):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_join(make(rows)).collect()}
    assert got == {i: root(i) for i in ids}
    assert len(set(got.values())) < 300
