"""Operators with an exact answer, against brute force on small hand-made tables.

Every table has null and empty texts, repeated rows, a null id, a long text and
further columns with clashing names.
"""
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from cohortlens.llm import fingerprints, jaccard_join, line_dedup, mixing, packing, substring_dedup

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}é" if rng.random() < 0.1 else f"W{rng.randrange(vocabulary)}" for _ in range(n)]


def sample_rows(seed=1):
    rng = random.Random(seed)
    passage, line = " ".join(words(rng, 30)), "A Line That Many documents hold, over forty characters"
    rows = []
    for i in range(60):
        parts = words(rng, rng.randrange(1, 120))
        if i % 3 == 0:
            parts[len(parts) // 2:len(parts) // 2] = [passage]
        text = " ".join(parts)
        if i % 4 == 0:
            text += f"\n  {line}\t\n" + " ".join(words(rng, 5))
        rows.append((i, text, f"s{i % 4}" if i % 7 else None))
    base = words(rng, 150)
    for i in range(60, 75):                               # near copies, each with a few words changed
        copy = list(base)
        for _ in range(i % 6):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(9999)}"
        rows.append((i, "\t".join(copy), "s1"))
    rows += [(75, rows[0][1], "s2"), (76, rows[0][1].upper(), "s2"), (77, None, "s0"), (78, "", None), (79, " \n\t", "s0"),
             (80, "one two three", "s3"), (81, "ONE two\tthree", "s3"), (82, "\n\n" + line + "\n" + line, "s3"),
             (83, " ".join(words(rng, 6000)), "big"), (5, rows[5][1], rows[5][2]), (None, passage + " tail", "s1"),
             (84, "a b c İstanbul ΣΣ näive <|endoftext|> '' 12345", "s2")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return sample_rows()


@pytest.fixture(scope="module")
def docs(make, rows):
    return make(rows).persist()


def split(text):
    return (text or "").encode().split()


def test_fingerprints(docs, rows):
    hashed = {r[0]: r[1] for r in docs.selectExpr("coalesce(text, '')", "xxhash64(coalesce(text, ''))").collect()}
    order = sorted(((i if i is not None else -1, t or "") for i, t, _ in rows), key=lambda r: (-r[0], hashed[r[1]]))

    def between(a, b):
        i = j = covered = 0
        for _ in range(fingerprints.ROUNDS):
            spots = [(s, t) for s in fingerprints.SKIPS for t in range(fingerprints.WINDOW)
                     if i + s + 24 <= len(a) and j + t + 24 <= len(b) and a[i + s:i + s + 24] == b[j + t:j + t + 24]]
            if min(len(a) - i, len(b) - j) < 24 or not spots:
                break
            s, t = spots[0]
            p, q = i + s, j + t
            back = next((k for k in range(min(s, t)) if a[p - 1 - k] != b[q - 1 - k]), min(s, t))
            most = min(len(a) - p, len(b) - q)
            ahead = next((k for k in range(most) if a[p + k] != b[q + k]), most)
            covered += back + ahead
            i, j = p + ahead, q + ahead
        return covered

    def alike(a, b):
        if not a and not b:
            return 1.0
        m = min(len(a), len(b))
        head = next((k for k in range(m) if a[k] != b[k]), m)
        tail = next((k for k in range(m - head) if a[-1 - k] != b[-1 - k]), m - head)
        return (head + tail + between(a[head:len(a) - tail], b[head:len(b) - tail])) / max(len(a), len(b))

    want = []
    for k, (i, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        cut = len(text) // 3
        edited = text[:len(text) - cut] + following[:cut]
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(),
                     round(alike(text, edited), 9), round(alike(text, following), 9)))
    got = fingerprints.fingerprints(docs, range_bytes=5000, slab_chars=1500).collect()
    assert sorted(want) == sorted((-1 if r.doc_id is None else r.doc_id, r.n_chars, r.edited_sha256,
                                   round(r.near_edited, 9), round(r.near_next, 9)) for r in got)
    prints, text_of = {}, {i: t or "" for i, t, _ in rows}
    for r in got:
        prints.setdefault(text_of[r.doc_id], set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    assert len({p for s in prints.values() for p in s}) == len(prints)


def test_span_equality_and_extension():
    texts = ["abcabcabd", "abcabd", "", "abc"]
    h = fingerprints.PrefixHashes(texts)
    at = lambda i, k: np.array([h.start[i] + k])
    assert h.equal_spans(at(0, 3), at(1, 0), np.array([6]))[0]
    assert not h.equal_spans(at(0, 0), at(1, 0), np.array([6]))[0]
    assert h.extension(at(0, 0), at(1, 0), np.array([6]))[0] == 5
    assert h.likeness(np.array([2, 0]), np.array([2, 3])).tolist() == [1.0, 3 / 9]


def test_likeness_holds_through_scattered_edits():
    rng = random.Random(9)
    words_ = [f"word{rng.randrange(500)}" for _ in range(200)]
    edited = list(words_)
    for k in (3, 60, 61, 120, 190):
        edited[k] = "changed"
    del edited[100]
    edited.insert(150, "one or two more")
    texts = [" ".join(words_), " ".join(edited), " ".join(f"else{rng.randrange(500)}" for _ in range(200))]
    h = fingerprints.PrefixHashes(texts)
    near, back, far = h.likeness(np.array([0, 1, 0]), np.array([1, 0, 2]))
    assert 0.9 < near < 1 and 0.9 < back < 1 and far < 0.1


def test_jaccard_join(docs, rows):
    sets = {}
    for i, text, _ in rows:
        w = (text or "").translate(ASCII_LOWER).encode().split()
        sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))) if w else frozenset()
    ids = [i for i in sets if i is not None]
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    want = sorted((i, len(sets[i]), root(i)) for i, _, _ in rows if i is not None)
    got = jaccard_join.jaccard_join(docs).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None) == want
    assert [(r.n_shingles > 0, r.component_id) for r in got if r.doc_id is None] == [(True, None)]
    assert len({root(i) for i in range(60, 75)}) < 15     # the near copies do link


def test_line_dedup(docs, rows):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(ASCII_LOWER)
    holders = defaultdict(set)
    for i, text, _ in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(key(line)) >= 40:
                holders[key(line)].add(i)
    want = []
    for i, text, _ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or len(holders.get(key(x), ())) < 5 or max(holders[key(x)]) == i]
        want.append((str(i), len(lines), len(lines) - len(kept), "\n".join(kept)))
    got = line_dedup.line_dedup(docs)
    assert {"_drop", "chunk", "lang"} <= set(got.columns)
    assert sorted(want) == sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept_text) for r in got.collect())
    assert sum(w[2] for w in want) > 5
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_substring_dedup(docs, rows):
    earliest = {}
    last = 2**62
    for i, text, _ in rows:
        w = split(text)
        for k in range(len(w) - 12):
            at = tuple(w[k:k + 13])
            earliest[at] = min(earliest.get(at, last), last if i is None else i)
    want = []
    for i, text, _ in rows:
        w = split(text)
        gone = [False] * len(w)
        for k in range(len(w) - 12):
            if earliest[tuple(w[k:k + 13])] < (last if i is None else i):
                gone[k:k + 13] = [True] * 13
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want.append((str(i), len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    got = substring_dedup.substring_dedup(docs, chunk_bytes=2000).collect()
    assert sorted(want) == sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got)
    assert sum(w[2] for w in want) > 100


def test_parts_of_plain_texts_are_what_is_kept():
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(packing.tokenizer_path())
    own = packing.WordTokenizer(packing.tokenizer_path())
    plain = ["The word's they'll WE'RE \"'so''s 12,5 _a_ x\t\x0b\r\n\x0cÉté İ".replace("İ", "Ÿ"), "a'd'S'ss ''t ...'m Ðð ıĸ ŉ".replace("ŉ", "Ŋ"), "", " \n"]
    assert [np.frombuffer(x, "<u4").tolist() for x in own(plain)] == [library.encode(t, add_special_tokens=False).ids for t in plain]
    assert own.parts and not own.words                    # plain texts need no ids of whole words
    other = [*plain, "x\x1cy a\u00a0b", "J\u030c <|endoftext|> <|ENDOFTEXT|>", "漢字 “Quoted” – Ünï", "İstanbul ſ ŉ ß×÷", None]
    assert [np.frombuffer(x, "<u4").tolist() for x in own(other)] == [library.encode(t or "", add_special_tokens=False).ids for t in other]


def test_packing(docs, rows):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    capacity = 512
    want = []
    for i, text, _ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[at:at + capacity], dtype="<u4").tobytes()
            want.append((str(i), piece, at, len(part) // 4, zlib.crc32(part)))
    got = packing.pack(docs, capacity=capacity, group_bins=4).collect()
    assert sorted(want) == sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    total = sum(w[3] for w in want)
    assert len(sequences) <= -(-total // capacity) * 1.05 + 1


def test_best_fit_prefers_the_tightest_bin():
    bins, offsets, fills = packing.best_fit([6, 5, 4, 3, 2], 10)
    assert fills == [10, 10] and bins == [0, 1, 0, 1, 1] and offsets == [0, 0, 6, 5, 8]


def test_mixing(docs, rows):
    mix = mixing.Mix(docs, block_words=8, shard_slots=16)
    got = mix.documents().collect()
    size = lambda t: len(split(t))
    assert sorted((str(i), size(t)) for i, t, _ in rows) == sorted((str(r.doc_id), r.size) for r in got)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    per_source = {}
    for r in got:
        per_source.setdefault(r.target, [0, r.source_size])[0] += r.taken
    assert sum(per_source) == pytest.approx(1.5 * sum(size(t) for _, t, _ in rows))
    for target, (taken, of) in per_source.items():
        assert target <= 2 * of + 1e-9 and abs(taken - target) <= 17
    again = mixing.Mix(docs.repartition(2), block_words=8, shard_slots=16).documents().collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    texts = mix.texts()
    assert texts.columns == docs.columns
    assert sum(size(r.text) for r in texts.collect()) == sum(r.taken for r in got)


def test_mix_targets_reshare_the_excess():
    assert mixing.targets([10, 100, 100], [5, 2, 1], 1.5, 2.0) == pytest.approx([20, 295 * 2 / 3, 295 / 3])
    assert mixing.targets([], [], 1.5, 2.0) == []
    assert mixing.targets([0, 0], [5, 2], 1.5, 2.0) == [0, 0]


def test_mix_draws_add_up_and_permute():
    quotas = np.array([100, 37, 0, 5])
    shards = list(mixing.shard_counts(quotas, 16, 3, 0, 9))
    assert [s[0] for s in shards] == list(range(9)) and sum(s[2] for s in shards).tolist() == quotas.tolist()
    assert all(s[2].sum() == 16 for s in shards[:-1])
    alone = [next(iter(mixing.shard_counts(quotas, 16, 3, k, k + 1))) for k in range(9)]
    assert all((a[1] == b[1]).all() and (a[2] == b[2]).all() for a, b in zip(shards, alone, strict=True))
    for n in (1, 2, 7, 100):
        place = mixing.permuted(np.arange(n), np.full(n, n), np.full(n, 9, dtype=np.uint64))
        assert sorted(place) == list(range(n))


@pytest.mark.parametrize("apply", [
    fingerprints.fingerprints, jaccard_join.jaccard_join, line_dedup.line_dedup, substring_dedup.substring_dedup,
    packing.pack, lambda d: mixing.Mix(d).documents(), lambda d: mixing.Mix(d).texts()])
def test_empty_table(make, apply):
    assert apply(make([])).count() == 0


def test_plain_words_are_cut_into_parts_once(monkeypatch):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(packing.tokenizer_path())
    own, cut = packing.WordTokenizer(packing.tokenizer_path()), []

    class Parts:
        def findall(self, text, splitter=packing._PARTS):
            cut.append(text)
            return splitter.findall(text)

    monkeypatch.setattr(packing, "_PARTS", Parts())
    texts = ["It's 12 o'clock, the end. THE END! It's", "the end. Élan_vital\tx1y2\x0bclock", "", None, "the end. naïve 中文 it's"] * 3
    want = [np.array(library.encode(t or "", add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    assert own(texts) == want and cut
    assert own(texts) == want                             # words of new parts are kept the second time
    cut.clear()
    assert own(texts) == want and not cut                 # words seen before are not cut again
    monkeypatch.setattr(packing, "KEPT_WORDS", 3)
    assert own(texts[::-1]) == want[::-1]


def test_packing_keeps_the_ids_of_earlier_tasks(spark, make):
    def known(batches):
        import pyarrow as pa

        from cohortlens.llm import packing as module
        list(batches)
        yield pa.RecordBatch.from_pydict({"n": [len(t.parts) for t in module._TOKENIZERS.values()]}, pa.schema([("n", pa.int64())]))

    packing.pack(make([(i, f"{'abcdefgh'[i % 8]}{'ijklm'[i // 8]}packingkeeps a b") for i in range(40)], partitions=1)).collect()
    kept = spark.range(0, 64, 1, 64).mapInArrow(known, "n long").collect()
    assert kept and max(r["n"] for r in kept) >= 40
