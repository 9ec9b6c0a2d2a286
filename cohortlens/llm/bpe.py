"""Byte-level BPE encoding and decoding by speculation and verification.

Method: a word's tokens are proposed by greedy longest match over the vocabulary.
A sequence of tokens is the exact encoding of its bytes if, and only if, every two
adjacent tokens are compatible: merging both together never joins pieces of one with
pieces of the other. All adjacent pairs of a batch of words are tested at once with
numpy. An incompatible pair is merged step by step, once in a worker, and put in its place,
until all pairs of the word are compatible; the words that do not get there in a
few rounds are merged step by step as a whole.

The pair test: merges run in the order of their rank, then from left to right. While
nothing crosses the border of tokens a and b, the piece that ends a is a node of a's
right spine and the piece that begins b one of b's left spine, and each is there from
the merge that makes it to the merge that consumes it. So a and b are incompatible
when a merge of a node u with a node v has a rank under that which consumes u, and not
over that which consumes v (at one rank, the left merge goes first).

Words are what the vocabulary's own splitter makes of a text; its special tokens are
cut out of the text first. A worker keeps the ids of the words that it has seen.

Defined results: a null text is empty and has no ids; a null list of ids is empty, and
ids that no token has (null ones too) are left out when decoding; bytes that are no
UTF-8 decode to U+FFFD; every row gives a row, also when ids repeat or are null; an
empty table gives an empty result; further columns are ignored unless ``keep`` names them.
"""

from __future__ import annotations

import heapq
import json
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .text import batches_of, ranges

KEPT_WORDS = 200_000            # words, and pairs of tokens, whose ids a worker keeps, about
ROUNDS = 8                      # how often pairs that fail are put right before a word is merged as a whole
ROWS = 500                      # rows of a batch that are Python objects at once
_NONE = np.iinfo(np.int64).max

# fixed value: the splitter of byte-level vocabularies
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# characters whose class is the same in every version of Unicode that the libraries follow
_SETTLED = regex.compile(r"[\x00-՗က-₎₠-ꀀ]*")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary's file: itself if it
    is printable, otherwise the next letter from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, spare = [], 256
    for byte in range(256):
        letters.append(chr(byte if byte in printable else spare))
        spare += byte not in printable
    return letters


class ByteBpe:
    """Encoder and decoder of one byte-level vocabulary file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, splitter = spec["model"], spec["pre_tokenizer"]
        if (model["type"], splitter["type"], spec["normalizer"]) != ("BPE", "ByteLevel", None) or any(
                model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        self.splitter = Tokenizer.from_file(path).pre_tokenizer
        byte = {letter: i for i, letter in enumerate(byte_letters())}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")

        ids = model["vocab"]
        size = 1 + max([*ids.values(), *self.special.values()])
        raw: list[bytes | None] = [None] * size
        for token, i in ids.items():
            raw[i] = bytes(byte[c] for c in token)
        for token, i in self.special.items():
            raw[i] = token.encode()
        self.known = np.array([t is not None for t in raw])
        raw = [t or b"" for t in raw]
        self.lengths = np.array([len(t) for t in raw], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.blob = np.frombuffer(b"".join(raw), dtype=np.uint8)

        self.size = size
        self.made = np.full(size, -1, dtype=np.int64)      # rank of the merge that makes a token
        self.left, self.right = np.full(size, -1, dtype=np.int64), np.full(size, -1, dtype=np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(pairs):
            a, b, t = ids[a], ids[b], ids[a + b]
            if self.made[t] >= 0 or max(self.made[a], self.made[b]) >= rank:
                raise ValueError(f"{path}: merge {rank} is not of tokens made before, or makes one again")
            self.made[t], self.left[t], self.right[t] = rank, a, b
            self.merge[a, b] = rank, t
        keys = np.array([a * size + b for a, b in self.merge], dtype=np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], np.array([r for r, _ in self.merge.values()], dtype=np.int64)[order]

        self.raw = raw
        self.words: dict[str, bytes] = {}
        self.pairs: dict[tuple[int, int], list[int]] = {}
        self.failed = 0                                    # words merged step by step so far
        self.tokens: dict[bytes, int] = {}                 # filled when something is encoded

    def _ready_to_encode(self) -> None:
        """Tokens that can be proposed: those that their own bytes encode to."""
        own = np.array([t for _, t in self.merge.values()], dtype=np.int64)
        proper = np.ones(self.size, dtype=bool)
        proper[own] = self.first_crossing(self.left[own], self.right[own]) == self.made[own]
        for t in own[np.argsort(self.made[own])]:
            proper[t] &= proper[self.left[t]] and proper[self.right[t]]
        special = set(self.special.values())
        self.tokens = {t: i for i, t in enumerate(self.raw) if t and proper[i] and i not in special}
        self.prefixes = {t[:n] for t in self.tokens for n in range(1, len(t))}
        self.bytes_ids = [self.tokens[bytes([i])] for i in range(256)]

    # ---------------------------------------------------------------- pairs

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, or the largest integer."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], _NONE)

    def first_crossing(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The least rank of a merge across the border of tokens a[i] and b[i], or the largest integer."""
        found = np.full(len(a), _NONE)
        row, u, u_until = np.arange(len(a)), a, np.full(len(a), _NONE)
        while len(row):
            at, v, v_until = np.arange(len(row)), b[row], np.full(len(row), _NONE)
            while len(at):
                rank = self.rank_of(u[at], v)
                meets = (rank < u_until[at]) & (rank <= v_until) & (rank < _NONE)
                np.minimum.at(found, row[at[meets]], rank[meets])
                deeper = self.left[v] >= 0
                at, v, v_until = at[deeper], self.left[v[deeper]], self.made[v[deeper]]
            deeper = self.right[u] >= 0
            row, u, u_until = row[deeper], self.right[u[deeper]], self.made[u[deeper]]
        return found

    # ---------------------------------------------------------------- words

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match."""
        out, at, n = [], 0, len(word)
        while at < n:
            end, last = at + 1, at + 1
            while end < n and word[at:end] in self.prefixes:
                end += 1
                if word[at:end] in self.tokens:
                    last = end
            out.append(self.tokens[word[at:last]])
            at = last
        return out

    def merged(self, word: bytes) -> list[int]:
        """The encoding of one word by its merges in order."""
        n = len(word)
        ids = [self.bytes_ids[b] for b in word]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        waiting = [(self.merge[p][0], i) for i in range(n - 1) if (p := (ids[i], ids[i + 1])) in self.merge]
        heapq.heapify(waiting)
        while waiting:
            rank, i = heapq.heappop(waiting)
            j = after[i]
            if ids[i] < 0 or j >= n:
                continue
            made = self.merge.get((ids[i], ids[j]))
            if made is None or made[0] != rank:
                continue                                   # one of the two has changed since
            ids[i], ids[j] = made[1], -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                if (p := self.merge.get((ids[i], ids[after[j]]))) is not None:
                    heapq.heappush(waiting, (p[0], i))
            if before[i] >= 0 and (p := self.merge.get((ids[before[i]], ids[i]))) is not None:
                heapq.heappush(waiting, (p[0], before[i]))
        return [t for t in ids if t >= 0]

    def joined(self, a: int, b: int) -> list[int]:
        """The encoding of the bytes of two tokens."""
        if (found := self.pairs.get((a, b))) is None:
            found = self.pairs[a, b] = self.merged(self.raw[a] + self.raw[b])
        return found

    def learn(self, words: list[str]) -> None:
        """Keep the ids of ``words``: propose, verify all adjacent pairs, and put the encoding of both in the place of each
        pair that fails; what still fails after ``ROUNDS`` of that is merged as a whole."""
        raw = [w.encode() for w in words]
        found = [[t] if (t := self.tokens.get(w)) is not None else self.propose(w) for w in raw]
        if len(self.pairs) > KEPT_WORDS:
            self.pairs = {}
        open_words = [i for i, x in enumerate(found) if len(x) > 1]
        for left in range(ROUNDS, -1, -1):
            some = [found[i] for i in open_words]
            flat = np.fromiter(chain.from_iterable(some), dtype=np.int64)
            counts = np.fromiter(map(len, some), dtype=np.int64, count=len(some))
            owner = np.repeat(np.arange(len(some)), counts)
            inner = np.flatnonzero(owner[1:] == owner[:-1])
            pairs, which = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
            bad = inner[(self.first_crossing(pairs // self.size, pairs % self.size) < _NONE)[which]]
            if not len(bad):
                break
            failed = [open_words[i] for i in np.unique(owner[bad]).tolist()]
            if not left:
                for i in failed:
                    found[i] = self.merged(raw[i])
                self.failed += len(failed)
                break
            places = (bad - (np.cumsum(counts) - counts)[owner[bad]]).tolist()
            last, taken = -1, 0
            for i, at in zip(owner[bad].tolist()[::-1], places[::-1], strict=True):      # from right to left
                if i == last and at + 1 == taken:
                    continue                               # its right token has changed
                x = some[i]
                x[at:at + 2] = self.joined(x[at], x[at + 1])
                last, taken = i, at
            open_words = [i for i in failed if len(found[i]) > 1]
        ids = np.fromiter(chain.from_iterable(found), dtype="<i4").tobytes()
        ends = list(accumulate([4 * len(x) for x in found]))
        for word, lo, hi in zip(words, [0, *ends], ends, strict=False):
            self.words[word] = ids[lo:hi]

    # ---------------------------------------------------------------- texts

    def split(self, text: str) -> list[str]:
        """Words of a text without special tokens."""
        if _SETTLED.fullmatch(text):
            return _SPLIT.findall(text)
        return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        if not self.tokens:
            self._ready_to_encode()
        if len(self.words) > KEPT_WORDS:
            self.words = {}
        parts = []                                         # words and special tokens of each text
        for text in texts:
            words: list[str] = []
            at = 0
            for m in self.cut.finditer(text or ""):
                words += [*self.split(text[at:m.start()]), m[0]]
                at = m.end()
            parts.append(words + self.split((text or "")[at:]))
        for special, i in self.special.items():
            self.words[special] = np.array([i], dtype="<i4").tobytes()
        new = set().union(*parts).difference(self.words)
        if new:
            self.learn(sorted(new))
        known = self.words.__getitem__
        return [b"".join(map(known, words)) for words in parts]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of lists of ids that lie one after the other."""
        usable = (ids >= 0) & (ids < self.size)
        usable[usable] = self.known[ids[usable]]
        kept = ids[usable].astype(np.int64)
        ends = np.concatenate(([0], np.cumsum(usable)))[np.cumsum(counts)] if len(counts) else np.zeros(0, np.int64)
        sizes = self.lengths[kept]
        raw = self.blob[ranges(self.starts[kept], sizes)].tobytes()
        cuts = np.concatenate(([0], np.cumsum(sizes)))[ends].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip([0, *cuts], cuts, strict=False)]


_LOADED: dict[str, ByteBpe] = {}


def _loaded(path: str) -> ByteBpe:
    if path not in _LOADED:
        _LOADED[path] = ByteBpe(path)
    return _LOADED[path]


def encode(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text",
           path: str | None = None) -> DataFrame:
    """The ``keep`` columns of every row and ``ids``, the tokens of its whole text."""
    path = path or tokenizer_path()

    def run(batches):
        bpe = _loaded(path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                texts = some.column(len(keep)).to_pylist()
                for lo, hi in batches_of(texts):
                    ids = bpe.encode(texts[lo:hi])
                    offsets = np.concatenate(([0], np.cumsum([len(x) // 4 for x in ids]))).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), "<i4")))
                    part = some.slice(lo, hi - lo)
                    yield pa.RecordBatch.from_arrays([*part.columns[:len(keep)], lists], [*keep, "ids"])

    rows = docs.select(*keep, F.col(text_col).cast("string"))
    schema = StructType([*rows.schema.fields[:len(keep)], StructField("ids", ArrayType(IntegerType(), False))])
    return rows.mapInArrow(run, schema)


def decode(tokens: DataFrame, keep: tuple[str, ...] = ("doc_id",), ids_col: str = "ids",
           path: str | None = None) -> DataFrame:
    """The ``keep`` columns of every row and ``decoded``, the text of its list of ids."""
    path = path or tokenizer_path()

    def run(batches):
        bpe = _loaded(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                lists = part.column(len(keep))
                counts = np.asarray(lists.value_lengths().fill_null(0), dtype=np.int64)
                ids = np.asarray(lists.flatten().cast(pa.int64()).fill_null(-1), dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(keep)], pa.array(bpe.decode(ids, counts), pa.string())], [*keep, "decoded"])

    rows = tokens.select(*keep, F.col(ids_col))
    return rows.mapInArrow(run, StructType([*rows.schema.fields[:len(keep)], StructField("decoded", StringType())]))
