"""Best-fit packing of tokenised documents into fixed-length sequences.

Method: hierarchical residual packing. Each partition tokenises its documents
and packs their pieces best-fit, longest first. Nearly full bins are final at
once. Underfull bins go on as items of their fill: groups of ``group_bins`` are
packed best-fit again, nearly full results leave, and the rest meet in fewer
groups, until one group is left or a round of several groups takes less than
``least_gain`` of the open bins away (a parameter: 0 goes on until a round takes none
away). Only bin numbers and fills move between rounds.

Tokens: a text is tokenised by the parts that the vocabulary's splitter makes of it, or
word by word (runs between ASCII white space, which the splitter never crosses); their
ids are kept, so common ones are tokenised once in a worker.

Defined results: a null text is empty and gives the end id alone; every row is a
document of its own, also when ids repeat or are null; only documents longer
than ``capacity`` are cut; an empty table gives an empty result; further columns
are ignored. Numbers of sequences depend on how the rows lie in partitions;
pieces, lengths and checksums do not.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import stored
from .text import batches_of

CAPACITY = 2048
NEARLY_FULL = 0.995
LEAST_GAIN = 0.005              # share of the open bins that a round must take away to be followed by another
GROUP_BINS = 256
KEPT_WORDS = 400_000            # words, and parts of words, whose ids a worker keeps, about
_ITEMS = ("doc_id long, piece int, start long, length long, ids_crc32 long, bin long, offset long, fill int")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


# words whose splitting is plain: printable ASCII and precomposed Latin letters
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-įı-ňŊ-ž]+")
_PLAIN_TEXT = re.compile(r"[ \t-\r!-~À-ÖØ-öø-įı-ňŊ-ž]*")
# fixed value: the vocabulary's splitter, for plain words in lower case
_PARTS = re.compile(r"[a-zß-öø-įı-ňŊ-ž]+|\d|'s|'t|'re|'ve|'m|'ll|'d|(?:[^\w\s]|_)+")


class WordTokenizer:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    Of a plain text the ids of its words in lower case are kept. New words are cut into the parts
    that the splitter makes of them ("the," and "the." share a part), whose ids are kept with
    those of the words made of known parts; new parts are tokenised many at a time. Of other texts
    the ids of words are kept: plain words by their parts, others go to the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        # the same vocabulary for parts: they are in lower case and split already
        self.of_parts = Tokenizer(self.tokenizer.model)
        self.of_parts.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        size = self.tokenizer.get_vocab_size()
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(size)])
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}                  # parts, and words in lower case

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _learn_parts(self, parts: list[str]) -> None:
        for i in range(0, len(parts), 500):
            some = parts[i:i + 500]
            ids = np.array(self.of_parts.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(cuts) == len(some) and cuts[-1] == 4 * len(ids):
                raw = ids.tobytes()
                each = [raw[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]
            else:
                each = [self._encode(x).tobytes() for x in some]
            self.parts.update(zip(some, each, strict=True))

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        texts = b" ".join(words).decode().split(" ")
        split = [_PARTS.findall(t.lower()) if _PLAIN.fullmatch(t) and "<|" not in t else None for t in texts]
        known = self.parts
        self._learn_parts(list(set().union(*[x for x in split if x]).difference(known)))
        for word, text, parts in zip(words, texts, split, strict=True):
            self.words[word] = (self._encode(text).tobytes() if parts is None else
                                known[parts[0]] if len(parts) == 1 else b"".join([known[x] for x in parts]))
        return self.words

    def _learn_plain(self, words: list[str]) -> dict[str, bytes]:
        split = [[w] if w.isalpha() else _PARTS.findall(w) for w in words]
        known = self.parts
        new = set().union(*split).difference(known)
        self._learn_parts(list(new))
        ids = {w: b"".join([known[x] for x in parts]) for w, parts in zip(words, split, strict=True)}
        # a word with a part not seen before is most often seen once: its parts are kept, the word is not yet
        known.update([(w, ids[w]) for w, parts in zip(words, split, strict=True) if len(parts) > 1 and new.isdisjoint(parts)])
        return ids

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        if len(self.words) > KEPT_WORDS:
            self.words = {}
        if len(self.parts) > KEPT_WORDS:
            self.parts = {}
        plain = [t is not None and "<|" not in t and _PLAIN_TEXT.fullmatch(t) is not None for t in texts]
        of_parts = self._looked_up([t.lower().split() for t, p in zip(texts, plain, strict=True) if p],
                                   self.parts, self._learn_plain)
        of_words = self._looked_up([(t or "").encode().split() for t, p in zip(texts, plain, strict=True) if not p],
                                   self.words, self._learn)
        return [next(of_parts if p else of_words) for p in plain]

    @staticmethod
    def _looked_up(split: list[list], known: dict, learn) -> Iterator[bytes]:
        """The ids of each list of words or parts; those not known yet are learned together."""
        found = [list(map(known.get, words)) for words in split]
        places: list[list[int]] = []
        new: set = set()
        for words, ids in zip(split, found, strict=True):
            at, some = -1, []
            for _ in range(ids.count(None)):
                at = ids.index(None, at + 1)
                some.append(at)
            new.update([words[at] for at in some])
            places.append(some)
        if new:
            learned = learn(list(new))
            for words, ids, some in zip(split, found, places, strict=True):
                for at in some:
                    ids[at] = learned[words[at]]
        return map(b"".join, found)


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _loaded(path: str) -> WordTokenizer:
    """The worker's tokenizer, with the ids that it kept in earlier tasks. (A task's function has its own
    copy of the variables that it names, so it must ask a function of the module.)"""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Best-fit decreasing: (bin, offset) of each item, and each bin's fill."""
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]   # by room left
    rooms = 0                                                         # bit r: a bin with room r is open
    bins, offsets, fills = [0] * len(lengths), [0] * len(lengths), []
    for i in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        n = lengths[i]
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, len(fills)
            fills.append(0)
        bins[i], offsets[i] = b, fills[b]
        fills[b] += n
        if room - n:
            open_bins[room - n].append(b)
            rooms |= 1 << (room - n)
    return bins, offsets, fills


def _pack_partition(path: str, capacity: int, end_id: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def pack(batches):
        tokenizer = _loaded(path)
        docs, pieces, starts, lengths, crcs = [], [], [], [], []
        for batch in batches:
            texts, ids_of_docs = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            for lo, hi in batches_of(texts):
                for doc, ids in zip(ids_of_docs[lo:hi], tokenizer(texts[lo:hi]), strict=True):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at:at + 4 * capacity]
                        docs.append(doc)
                        pieces.append(piece)
                        starts.append(at // 4)
                        lengths.append(len(part) // 4)
                        crcs.append(zlib.crc32(part))
        bins, offsets, fills = best_fit(lengths, capacity)
        first = TaskContext.get().partitionId() << 32
        columns = [pa.array(docs, pa.int64()), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()),
                   pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64()),
                   pa.array([first + b for b in bins], pa.int64()), pa.array(offsets, pa.int64()),
                   pa.array([fills[b] for b in bins], pa.int32())]
        names = [c.split()[0] for c in _ITEMS.split(", ")]
        yield from pa.table(columns, names).to_batches(max_chunksize=20_000)
    return pack


def _merge_group(capacity: int):
    def merge(key: tuple, group: pa.Table) -> pa.Table:
        group = group.sort_by("root")                     # the same result however the rows arrive
        roots = group["root"].to_pylist()
        bins, offsets, fills = best_fit(group["fill"].to_pylist(), capacity)
        lead = {b: roots[i] for i, b in enumerate(bins) if offsets[i] == 0}
        return pa.table({"root": pa.array(roots, pa.int64()),
                         "new_root": pa.array([lead[b] for b in bins], pa.int64()),
                         "shift": pa.array(offsets, pa.int64()),
                         "fill": pa.array([fills[b] for b in bins], pa.int32())})
    return merge


def merge_bins(bins: DataFrame, capacity: int = CAPACITY, nearly_full: float = NEARLY_FULL,
               group_bins: int = GROUP_BINS, least_gain: float = LEAST_GAIN) -> DataFrame:
    """(bin, root, base): where each underfull bin of ``bins(root, fill)`` ends up."""
    full = int(nearly_full * capacity)
    place = stored(bins.select(F.col("root").alias("bin"), "root", F.lit(0).cast("long").alias("base")), "bins")
    open_bins = stored(bins, "bins")
    left, round_no = open_bins.count(), 0
    while left > 1:
        groups = -(-left // group_bins)
        grouped = open_bins.withColumn("grp", F.pmod(F.xxhash64("root", F.lit(round_no)), F.lit(groups)))
        merged = stored(grouped.groupBy("grp").applyInArrow(
            _merge_group(capacity), "root long, new_root long, shift long, fill int"), "bins")
        place = stored(place.join(merged.drop("fill"), "root", "left").select(
            "bin", F.coalesce("new_root", "root").alias("root"),
            (F.col("base") + F.coalesce("shift", F.lit(0))).alias("base")), "bins")
        open_bins = merged.filter((F.col("new_root") == F.col("root")) & (F.col("fill") < full)).select("root", "fill")
        before, left = left, open_bins.count()
        round_no += 1
        if groups == 1 or left == before or before - left < least_gain * before:
            break
    return place


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 0, path: str | None = None,
         nearly_full: float = NEARLY_FULL, group_bins: int = GROUP_BINS, least_gain: float = LEAST_GAIN) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    items = stored(docs.select("doc_id", "text").mapInArrow(
        _pack_partition(path or tokenizer_path(), capacity, end_id), _ITEMS), "items")
    underfull = items.filter((F.col("offset") == 0) & (F.col("fill") < int(nearly_full * capacity)))
    place = merge_bins(underfull.select(F.col("bin").alias("root"), "fill"), capacity, nearly_full, group_bins, least_gain)
    return items.join(place, "bin", "left").select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.coalesce("root", "bin").alias("sequence_id"),
        (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset"))
