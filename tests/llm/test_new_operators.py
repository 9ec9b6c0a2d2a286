"""Conversation repair, byte-level BPE and periodic runs against brute force."""
import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortlens.llm import bpe, conversations, periodic_runs
from cohortlens.llm.registered import QUERIES

GRAMMAR = re.compile(r"(s?(ua)+)?")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def put(tmp_path, df, name):
    df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


# ---------------------------------------------------------------- conversations

def best_audit(kinds):
    """All edit sequences over (row, grammar phase), costs from the end; then the least letters."""
    after = {0: 2, 1: 2, 2: 3, 3: 2}                      # start, s, u, done
    ends = [0, 10**9, 10**9, 0]

    def inserting(costs):
        for _ in range(4):
            costs = [min(c, costs[after[p]] + 3) for p, c in enumerate(costs)]
        return costs

    table = [inserting(ends)]
    moves = []
    for kind in reversed(kinds):
        letter, extra = kind.lower(), 3 * (not kind.islower())
        row = []
        options = []
        for p in range(4):
            due = "a" if p == 2 else "u"
            o = [("D", p, 4)]
            if kind != "d":
                o.append(("K", after[p], extra) if letter == due else ("R", after[p], 3 + extra))
                if p == 0 and letter == "s":
                    o.append(("K", 1, extra))
            options.append(o)
            row.append(min(table[0][q] + c for _, q, c in o))
        table.insert(0, inserting(row))
        moves.insert(0, options)
    i = p = 0
    out = ""
    while i < len(kinds) or table[i][p] != ends[p]:
        here = table[i][p]
        found = [(e, i + 1, q) for e, q, c in (moves[i][p] if i < len(kinds) else []) if table[i + 1][q] + c == here]
        if table[i][after[p]] + 3 == here:
            found.append(("I", i, after[p]))
        e, i, p = min(found)
        out += e
    return table[0][0], out


def brute_conversations(rows):
    ids, kept = [], defaultdict(list)
    for conv, turn, role, text in rows:
        if conv not in ids:
            ids.append(conv)
        shown = [" " if x is None else str(x) for x in (conv, turn)]
        spin = zlib.crc32(":".join(shown).encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        if spin == 0:
            continue
        text = "" if spin == 1 else re.sub("[.!?]", "", text) if spin == 2 else text
        kept[conv] += [(turn, "user" if spin == 4 else role, text)] * (2 if spin == 3 else 1)
    out = {}
    for conv in ids:
        mine = sorted(kept[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, kinds, counts = set(), "", [0, 0, 0]
        for _, role, text in mine:
            core = text.strip(" \t\n\x0b\x0c\r")
            fault = 0 if not core else 1 if (role, text) in seen else 2 if core[-1] not in ".!?" else None
            seen.add((role, text))
            letter = role[0] if role[:1] in ("s", "u", "a") else "x"
            kinds += letter if fault is None else letter.upper() if fault == 2 else "d"
            if fault is not None:
                counts[fault] += 1
        cost, audit = best_audit(kinds)
        texts, left, roles = [], iter(mine), ""
        for e in audit:
            _, role, text = next(left) if e != "I" else (None, None, "")
            if e in "RI":
                role = "assistant" if roles[-1:] == "u" else "user"
            if e != "D":
                texts.append(f"{role}:{text}")
                roles += role[0]
        assert GRAMMAR.fullmatch(roles)
        turns = {t for t, _, _ in mine if t is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:], strict=False))
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts, illegal, cost, audit,
                     sha("\n".join(texts)))
    return out


def conversation_rows():
    rng = random.Random(7)
    texts = ["Fine.", "Why?", "cut off", " \t\x0b", "", None, "No!  ", "Fine.", "né.", "ok .\x85"]
    rows = []
    for conv in [*range(150), None]:
        for turn in range(rng.randrange(9)):
            if rng.random() < 0.1:
                continue
            turn = None if rng.random() < 0.05 else turn - 2
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None, "User", ""])
            rows.append((conv, turn, role, rng.choice(texts) if rng.random() < 0.4 else f"text {rng.random()}."))
            if rng.random() < 0.08:
                rows.append(rows[-1])
    for turn in range(900):                               # a third of all rows, some texts over and over
        rows.append((1000, turn, "user" if turn % 2 else "assistant", "again." if turn % 7 == 0 else f"t {turn}?"))
    return rows


def test_conversations_against_brute_force(spark, tmp_path):
    rows = conversation_rows()
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(5)
    for c in ("step", "at", "digest", "cost", "audit", "_conv"):
        df = df.withColumn(c, F.lit(f"odd {c}"))
    got = {r[0]: tuple(r[1:]) for r in QUERIES["op11_conversations"](spark, put(tmp_path, df, "conversations")).collect()}
    assert got == brute_conversations(rows)


def test_repaired_turns_follow_the_audit(spark):
    rows = conversation_rows()
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    found = defaultdict(dict)
    for r in conversations.repaired_turns(df).collect():
        found[r.conv_id][r.place] = r
    for r in conversations.repair(df).collect():
        turns = [found[r.conv_id][i] for i in range(len(found[r.conv_id]))]
        assert "".join(t.edit for t in turns) == r.audit.replace("D", "")
        assert sha("\n".join(f"{t.role}:{t.text}" for t in turns)) == r.repaired_sha256
        assert GRAMMAR.fullmatch("".join(t.role[0] for t in turns))


def test_no_conversations(spark, tmp_path):
    df = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert QUERIES["op11_conversations"](spark, put(tmp_path, df, "conversations")).count() == 0


@pytest.mark.parametrize("segment", [1, 3, 16, 256])
def test_segments_do_not_change_the_alignment(segment):
    rng = random.Random(segment)
    for _ in range(150):
        kinds = "".join(rng.choice("suauaxSUAXd") for _ in range(rng.randrange(40)))
        assert conversations.align(kinds, segment) == best_audit(kinds)


def test_alignment_by_enumeration():
    """Against every audit of short conversations, tables and phases aside."""
    def every(kinds, i, roles, cost, audit):
        if i == len(kinds) and GRAMMAR.fullmatch(roles):
            yield cost, audit
        if len(roles) > len(kinds) + 2 or not any(GRAMMAR.fullmatch(roles + t) for t in ("", "a", "ua")):
            return
        if i < len(kinds):
            kind = kinds[i]
            yield from every(kinds, i + 1, roles, cost + 4, audit + "D")
            if kind != "d":
                extra = 0 if kind.islower() else 3
                yield from every(kinds, i + 1, roles + kind.lower(), cost + extra, audit + "K")
                for r in "ua":
                    yield from every(kinds, i + 1, roles + r, cost + 3 + extra, audit + "R")
        for r in "ua":
            yield from every(kinds, i, roles + r, cost + 3, audit + "I")

    rng = random.Random(1)
    for _ in range(60):
        kinds = "".join(rng.choice("suaSUAxd") for _ in range(rng.randrange(4)))
        assert conversations.align(kinds) == min(every(kinds, 0, "", 0, ""))


# ---------------------------------------------------------------- byte-level BPE

def odd_texts():
    rng = random.Random(4)
    pool = [*map(chr, range(32, 127)), *"aaeeett \n\t'", *"日本éü\x85\xa0\x1c՘֋\U0001fae8"]
    return ["", None, "a" * 3000, " " * 90 + "\n\n x", "<|endoftext|>", "hi<|endoftext|> there<|endoftext|><|endoftext",
            "don't WE'LL 'S", "x" + "́" * 40, "ab" * 2000 + " " + "aab" * 900, " lead", "tail  ",
            *("".join(rng.choice(pool) for _ in range(rng.randrange(60))) for _ in range(400)),
            *("".join(rng.choice("aab") for _ in range(rng.randrange(80))) for _ in range(200))]


def test_bpe_against_the_library(spark, tmp_path, make):
    rows = [(i if i % 9 else None, t) for i, t in enumerate(odd_texts())] + [(3, "twice"), (3, "twice")]
    df = make(rows).withColumn("ids", F.lit("odd"))
    got = sorted((r for r in QUERIES["op12_bpe"](spark, put(tmp_path, df, "documents")).collect()), key=str)
    library = Tokenizer.from_file(bpe.tokenizer_path())
    want = []
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((doc, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def test_decoding_odd_ids(spark):
    rows = [(1, [0, 50256, 99999, -1, 257]), (2, None), (3, []), (4, [None, 162]), (5, [162, 98, 98])]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    library = Tokenizer.from_file(bpe.tokenizer_path())
    got = {r.doc_id: r.decoded for r in bpe.decode(df).collect()}
    for doc, ids in rows:
        kept = [i for i in ids or [] if i is not None and 0 <= i <= 50256]
        assert got[doc] == library.decode(kept, skip_special_tokens=False)


def test_pair_test_agrees_with_merging():
    b = bpe.ByteBpe(bpe.tokenizer_path())
    b.encode([""])
    raw = {i: t for t, i in b.tokens.items()}
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 50256, 3000), rng.integers(0, 50256, 3000)
    x[:1500], y[:1500] = rng.integers(0, 2000, 1500), rng.integers(0, 2000, 1500)
    apart = b.first_crossing(x, y) == np.iinfo(np.int64).max
    assert apart.any() and not apart.all()
    for u, v, free in zip(x.tolist(), y.tolist(), apart.tolist(), strict=True):
        assert (b.merged(raw[u] + raw[v]) == [u, v]) == free


def test_failing_pairs_are_put_right_without_merging_whole_words():
    b = bpe.ByteBpe(bpe.tokenizer_path())
    rng = random.Random(4)
    words = sorted({" " + "".join(rng.choice("etaonrishdluWASN01") for _ in range(rng.randrange(2, 40))) for _ in range(3000)} | {"a" * 300})
    b.encode([" ".join(w.strip() for w in words)])
    b.learn(words)
    assert b.failed < 30 and len(b.pairs) > 100
    assert [np.frombuffer(b.words[w], "<i4").tolist() for w in words] == [b.merged(w.encode()) for w in words]


def test_splitter_classes_of_settled_characters():
    splitter = Tokenizer.from_file(bpe.tokenizer_path()).pre_tokenizer
    for low in range(0, 0x10000, 128):
        text = "".join(f"a{c}1{c}! {c}  " for c in map(chr, range(low, low + 128)) if bpe._SETTLED.fullmatch(c))
        assert [text[a:b] for _, (a, b) in splitter.pre_tokenize_str(text)] == bpe._SPLIT.findall(text)


def test_bpe_of_no_documents(spark, tmp_path, make):
    assert QUERIES["op12_bpe"](spark, put(tmp_path, make([]), "documents")).count() == 0


# ---------------------------------------------------------------- periodic runs

def brute_runs(w):
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            start, length = i, j + q - i
            if j > i and length >= max(6, 4 * q) and not any(
                    q % d == 0 and all(w[k] == w[k + d] for k in range(start, start + length - d)) for d in range(1, q)):
                out.append((start, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_document(doc_id, text):
    w = re.findall("[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    found = brute_runs(w)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else None
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{length},{q}\n" for s, length, q in found)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def run_texts():
    rng = random.Random(5)
    texts = ["", None, " \t ", "a", "a a a a a a", "a a a a a", "a b " * 40, "x\x0by\x1fz é " * 9, "a\xa0b a\xa0b " * 5]
    for _ in range(250):
        size = rng.choice([1, 2, 3, 6, 30])
        w = [f"w{rng.randrange(size)}" for _ in range(rng.randrange(1, 60))]
        if rng.random() < 0.6:
            a, p = rng.randrange(len(w)), rng.randrange(1, 7)
            w += w[a:a + p] * rng.randrange(1, 9) + w[:3]
        texts.append(rng.choice([" ", "\n", "  "]).join(w))
    return texts + ["long " + "p q r " * 5000 + "end", "a a b " * 3 + "same " * 3000]


def test_periodic_runs_against_brute_force(spark, tmp_path, make):
    rows = [(i if i % 11 else None, t) for i, t in enumerate(run_texts())] + [(5, "b b b b b b b"), (5, "b b b b b b b")]
    df = make(rows)
    for c in ("_h", "_words", "runs", "period"):
        df = df.withColumn(c, F.lit(f"odd {c}"))
    got = [tuple(r) for r in QUERIES["op13_periodic_runs"](spark, put(tmp_path, df, "documents")).collect()]
    assert sorted(got, key=str) == sorted((brute_document(*r) for r in rows), key=str)


def test_lyndon_lengths():
    rng = random.Random(6)
    for _ in range(400):
        parts = [[rng.randrange(1, 4) for _ in range(rng.randrange(12))] for _ in range(3)]
        symbols, want = [0], [0]
        for s in parts:
            symbols += [*s, 0]
            want += [next((j for j in range(i + 1, len(s)) if s[j:] < s[i:]), len(s)) - i for i in range(len(s))] + [0]
        assert periodic_runs.lyndon_lengths(np.array(symbols)).tolist() == want


def test_runs_of_no_documents(spark, tmp_path, make):
    assert QUERIES["op13_periodic_runs"](spark, put(tmp_path, make([]), "documents")).count() == 0
