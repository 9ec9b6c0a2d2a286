"""Secret scan: fixed rules plus a character convolutional network.

Base rules (``base_spans``): ``assign``, ``access`` and ``hex`` matches, leftmost and
non-overlapping per kind; they always stay. Method: a candidate is every run of
8 or more of ``A-Za-z0-9+/_.=-``, with or without digits. A small convolutional
network in numpy reads the candidate and the characters around it and scores
it; candidates at or over the threshold that touch no base span are added as
kind ``model``.

Training (``fit``) reads every row and every candidate: positive are the candidates that meet a base span,
all of them, and random keys planted in the surroundings of candidates of every document. Of the candidates without
a base span those of the first documents train the starting network; each later pass scores
such candidates, the last two passes those of all documents, and all that the network does not place below
``-MARGIN`` join (hard negatives). The loss is flat beyond the margin, so a candidate below it has no
gradient and is not kept. Gradients are taken in tasks, each on its share of the findings; shares start from
the same parameters, which are averaged four times a pass. A part is held out: a quarter of the documents'
negatives, a quarter of the positives. Scores are calibrated on it by a logistic fit, and the
threshold is the largest that keeps ``recall`` of its positives in every kind. Labels,
language, source and id are not inputs.

A candidate longer than a window is read in overlapping windows, all of them, in training and
scoring; its score is the largest. Scoring convolves a text once for all its candidates.

Defined results: a null text is empty and has no span; every row gives a row, also
when ids repeat or are null; without any negative candidate to learn from, the model adds
nothing and ``fit`` warns; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
import warnings
import zlib
from bisect import bisect_left, bisect_right
from itertools import accumulate, pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graph import stored
from .nets import Adam, calibrate, sigmoid
from .text import batches_of, ranges

# fixed rules
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32
KINDS = ("assign", "access", "hex", "model")
_KEYWORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")

MIN_CANDIDATE = 8
CONTEXT = 20                    # characters read on each side
WINDOW = 64                     # characters of a candidate read at once
STRIDE = 32
WIDTH = CONTEXT + WINDOW + CONTEXT
EDGE = CONTEXT + 2              # places of nothing around a text
SLAB = 8192                     # places of a text whose responses are held at once, about
FILTERS, KERNEL, EMBED = 16, 5, 8
LETTERS = -2                    # kind of a finding without base span and digit, weighed on its own
MARGIN = 4.0                    # raw score beyond which a finding on its right side has no loss
HELD = 4                        # one in so many is held out
BATCH = 256                     # findings of a training step, about
AVERAGES = 4                    # of the parameters of several tasks, in a pass
BINS = 64                       # of raw scores in calibration, for each unit
MOST_SCORE = 64                 # raw scores beyond it count as it, there
_CODES = 130                    # ASCII, others, nothing

_IN_RUN = np.zeros(256, dtype=bool)
_IN_RUN[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"]] = True
_IS_DIGIT = np.zeros(256, dtype=bool)
_IS_DIGIT[ord("0"):ord("9") + 1] = True

FINDING = "codes binary, length int, kind int, turn int, held boolean"
RESULT = ("doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_model long")


def runs(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the runs of key characters of 8 or more in ``laid_out`` codes."""
    inside = _IN_RUN[codes]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1     # the codes begin and end with nothing
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= MIN_CANDIDATE
    return starts[long], ends[long]


def base_spans(text: str, raw: bytes, longest_run: int) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base rules, in code points."""
    found = []
    lower = raw.lower()
    if any(k in lower for k in _KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if longest_run >= MIN_ACCESS and b"AKIA" in raw:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    if longest_run >= MIN_HEX:                            # a hex run lies inside a run of key characters
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= MIN_HEX]
    return sorted(found)


def scan(text: str):
    """(base spans, candidates as (start, end) code points without or with a base span)."""
    found = candidates([text])
    return found.base[0], list(zip((found.starts - EDGE).tolist(), (found.ends - EDGE).tolist(), strict=True))


def coded(text: str) -> bytes:
    """A code for each character: ASCII, 128 for others, 129 for nothing."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(points == 0, 129, np.minimum(points, 128)).astype(np.uint8).tobytes()


def windows_of(text: str, start: int, end: int, codes: bytes | None = None) -> list[tuple[bytes, int]]:
    """The candidate with its surroundings as windows: (codes, length inside). The codes are
    ``CONTEXT`` characters, the inside, ``CONTEXT`` characters, and nothing up to ``WIDTH``.
    ``codes`` are the ``coded`` text, if they are at hand."""
    codes = coded(text) if codes is None else codes
    out = []
    for at, stop in pieces(start, end):
        body = codes[max(0, at - CONTEXT):stop + CONTEXT]
        out.append((body.rjust(len(body) + max(0, CONTEXT - at), b"\x81").ljust(WIDTH, b"\x81"), stop - at))
    return out


def pieces(start: int, end: int) -> list[tuple[int, int]]:
    """A candidate as overlapping stretches of at most ``WINDOW`` characters."""
    return [(at, min(end, at + WINDOW)) for at in range(start, max(start + 1, end - STRIDE), STRIDE)]


class CharConv:
    """Embedding, one convolution, largest response inside and around, mean response inside, one output.

    The convolution reads the characters and whether they are inside the candidate. ``forward`` has fixed-width
    windows and is what training differentiates. ``scan_scores`` is the same function for all
    candidates of a text at once: the convolution is linear in its inputs, so the characters' part is
    taken once for every place of the text, candidates add the part of their own inside, which
    is one constant but for two places at either end, and maxima come from maxima over 2, 4, 8, .. places.
    """

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.params = {
            "embed": (rng.standard_normal((_CODES, EMBED)) * 0.3).astype(np.float32),
            "kernel": (rng.standard_normal((KERNEL * (EMBED + 1), FILTERS)) * 0.15).astype(np.float32),
            "bias": np.zeros(FILTERS, dtype=np.float32),
            "out": (rng.standard_normal(3 * FILTERS) * 0.2).astype(np.float32),
            "shift": np.zeros(1, dtype=np.float32)}
        self.slope, self.offset, self.threshold = 1.0, 0.0, 2.0
        self.report: dict[str, float] = {}                # held-out recall of each kind at the threshold
        self.findings: dict[str, int] = {}                # different findings of each kind, of all documents, held out or not
        self._tables = None

    def _columns(self, codes: np.ndarray, inside: np.ndarray):
        x = np.concatenate((self.params["embed"][codes], inside[:, :, None]), axis=2)
        n = WIDTH - KERNEL + 1
        return np.concatenate([x[:, k:k + n] for k in range(KERNEL)], axis=2)

    @staticmethod
    def _places(lengths: np.ndarray, margin: int) -> tuple[np.ndarray, np.ndarray]:
        """Places inside, and around: of the context all but the outermost ``margin``."""
        at, end = np.arange(WIDTH)[None, :], CONTEXT + lengths[:, None]
        inside = (at >= CONTEXT) & (at < end)
        around = (at >= margin) & (at < end + CONTEXT - margin) & ~inside
        return inside.astype(np.float32), around.astype(np.float32)

    def forward(self, codes: np.ndarray, lengths: np.ndarray):
        half = KERNEL // 2
        inside, around = self._places(lengths, half)
        cols = self._columns(codes, inside)
        act = np.maximum(cols @ self.params["kernel"] + self.params["bias"], 0)
        mid, out = inside[:, half:WIDTH - half][:, :, None], around[:, half:WIDTH - half][:, :, None]
        inner, outer = act * mid, act * out
        mean = inner.sum(axis=1) / lengths[:, None]
        pooled = np.concatenate((inner.max(axis=1), outer.max(axis=1), mean), axis=1)
        return pooled @ self.params["out"] + self.params["shift"][0], (cols, act, mid, inner, outer, pooled)

    def gradients(self, codes: np.ndarray, lengths: np.ndarray, labels: np.ndarray, weights: np.ndarray, margin: float = np.inf):
        score, kept = self.forward(codes, lengths)
        d = ((sigmoid(score) - labels) * weights / weights.sum()).astype(np.float32)
        live = np.where(labels > 0, score, -score) < margin
        if not live.all():                                # beyond the margin the loss is flat
            codes, lengths, d, kept = codes[live], lengths[live], d[live], [x[live] for x in kept]
        cols, act, mid, inner, outer, pooled = kept
        grads = {"out": pooled.T @ d, "shift": np.array([d.sum()], dtype=np.float32)}
        back = d[:, None] * self.params["out"][None, :]
        d_act = np.repeat((back[:, 2 * FILTERS:] / lengths[:, None])[:, None, :], act.shape[1], axis=1) * mid
        rows, filters = np.arange(len(codes))[:, None], np.arange(FILTERS)[None, :]
        d_act[rows, inner.argmax(axis=1), filters] += back[:, :FILTERS] * (inner.max(axis=1) > 0)
        d_act[rows, outer.argmax(axis=1), filters] += back[:, FILTERS:2 * FILTERS] * (outer.max(axis=1) > 0)
        d_act *= act > 0
        flat = d_act.reshape(-1, FILTERS)
        grads["kernel"] = cols.reshape(len(flat), cols.shape[2]).T @ flat
        grads["bias"] = flat.sum(axis=0)
        d_cols = d_act @ self.params["kernel"].T
        d_input = np.zeros((*codes.shape, EMBED), dtype=np.float32)
        n = WIDTH - KERNEL + 1
        for k in range(KERNEL):
            d_input[:, k:k + n] += d_cols[:, :, k * (EMBED + 1):k * (EMBED + 1) + EMBED]
        grads["embed"] = np.stack([np.bincount(codes.reshape(-1), d_input[:, :, e].reshape(-1), _CODES)
                                   for e in range(EMBED)], axis=1).astype(np.float32)
        return grads

    def raw_scores(self, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return np.concatenate([self.forward(codes[i:i + 1024], lengths[i:i + 1024])[0]
                               for i in range(0, len(codes), 1024)] or [np.zeros(0, np.float32)])

    def probability(self, raw: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * raw + self.offset)

    # ------------------------------------------------- all candidates of a text

    def tables(self):
        """Responses to two neighbouring characters, and to one, at each tap of the kernel; the inside's part."""
        kernel = self.params["kernel"].reshape(KERNEL, EMBED + 1, FILTERS)
        one = [self.params["embed"] @ kernel[k, :EMBED] for k in range(KERNEL)]
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(-1, FILTERS)
        return pair(one[0], one[1]), pair(one[2], one[3]), one[4] + self.params["bias"], kernel[:, EMBED]

    def scan_scores(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Raw score of the stretches ``[starts[i], ends[i])`` of a coded text, in order, 8 to ``WINDOW`` long.

        ``codes`` have ``EDGE`` places or more of nothing before the first and after the last stretch.
        """
        if self._tables is None:
            self._tables = self.tables()
        out = np.empty(len(starts), dtype=np.float32)
        i = 0
        while i < len(starts):                            # slabs of the text bound the arrays
            j = max(i + 1, int(np.searchsorted(starts, starts[i] + SLAB)))
            lo, hi = int(starts[i]) - EDGE, int(ends[i:j].max()) + EDGE
            out[i:j] = self._slab(codes[lo:hi], starts[i:j] - lo, ends[i:j] - lo)
            i = j
        return out

    def _slab(self, codes: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        pair_a, pair_b, last, w = self._tables
        half = KERNEL // 2
        c = codes.astype(np.int32)
        two = c[:-1] * _CODES + c[1:]
        n = len(c) - KERNEL + 1
        a, more = _room(0, n), _room(1, n)                # a[p - half]: response at place p, nothing inside
        pair_a.take(two[:n], axis=0, out=a, mode="clip")
        a += pair_b.take(two[2:2 + n], axis=0, out=more, mode="clip")
        a += last.take(c[4:4 + n], axis=0, out=more, mode="clip")
        s, e = s - half, e - half
        size = e - s - 4
        level = np.frexp(size.astype(np.float64))[1] - 1
        maxima = [a]
        for k in range(max(4, int(level.max()))):         # maxima over 2, 4, .. 32 places from each on
            m, step = maxima[-1], 1 << k
            maxima.append(np.maximum(m[:-step], m[step:], out=_room(2 + k, len(m) - step)) if len(m) > step else m)
        whole = w.sum(axis=0)
        # around: 16 places the inside does not touch, then two that it does, on either side
        outer = np.maximum(maxima[4].take(s - 18, axis=0), maxima[4].take(e + 2, axis=0))
        for row, part in ((s - 2, w[4]), (s - 1, w[3] + w[4]), (e, w[0] + w[1]), (e + 1, w[0])):
            np.maximum(outer, a.take(row, axis=0) + part, out=outer)
        # inside: the middle by two overlapping maxima, then two places at either end
        inner = np.empty_like(outer)
        for k in np.unique(level):
            these = np.flatnonzero(level == k)
            x = maxima[k]
            inner[these] = np.maximum(x.take(s[these] + 2, axis=0), x.take(e[these] - 2 - (1 << int(k)), axis=0))
        inner += whole
        np.maximum(np.add(a, whole, out=more), 0, out=more)
        mean = np.add.reduceat(more, np.stack((s + 2, e - 2), axis=1).reshape(-1), axis=0)[::2]
        for row, part in ((s, w[2:].sum(axis=0)), (s + 1, w[1:].sum(axis=0)), (e - 2, w[:4].sum(axis=0)), (e - 1, w[:3].sum(axis=0))):
            here = a.take(row, axis=0) + part
            np.maximum(inner, here, out=inner)
            mean += np.maximum(here, 0)
        pooled = np.concatenate((np.maximum(inner, 0), np.maximum(outer, 0), (mean / (e - s)[:, None]).astype(np.float32)), axis=1)
        return pooled @ self.params["out"] + self.params["shift"][0]


_ROOMS: dict[int, np.ndarray] = {}


def _room(number: int, n: int) -> np.ndarray:
    """An array of n places to write to, the same memory for a number each time."""
    if len(_ROOMS.get(number, ())) < n:
        _ROOMS[number] = np.empty((n + SLAB // 4, FILTERS), dtype=np.float32)
    return _ROOMS[number][:n]


def laid_out(texts: list[str]) -> tuple[np.ndarray, list[int]]:
    """The coded texts one after the other with ``EDGE`` places of nothing around each, and where each begins."""
    gap, at, parts, begins = b"\x81" * EDGE, EDGE, [], []
    for text in texts:
        codes = coded(text)
        begins.append(at)
        parts += [gap, codes]
        at += len(codes) + EDGE
    return np.frombuffer(b"".join([*parts, gap]), np.uint8), begins


def _parts(batches, *columns: str):
    """(texts, values of the columns) of about a million characters."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 500):
            part = batch.slice(lo, 500)
            texts = [t or "" for t in part.column("text").to_pylist()]
            for at, end in batches_of(texts):
                yield texts[at:end], *[part.column(c).slice(at, end - at) for c in columns]


class Candidates(NamedTuple):
    laid: np.ndarray            # the ``laid_out`` texts
    begins: list[int]
    base: list[list[tuple[int, int, int]]]
    starts: np.ndarray          # of all candidates, in order, places in ``laid``
    ends: np.ndarray
    owner: np.ndarray           # text number of each
    kinds: np.ndarray           # of the base span that it meets; without one -1, or ``LETTERS``


def candidates(texts: list[str]) -> Candidates:
    """The base spans and the candidates of the texts."""
    laid, begins = laid_out(texts)
    starts, ends = runs(laid)
    owner = np.searchsorted(begins, starts, "right") - 1
    longest = np.zeros(len(texts), dtype=np.int64)
    np.maximum.at(longest, owner, ends - starts)
    base = [base_spans(text, text.encode("utf-8", "surrogatepass"), n) for text, n in zip(texts, longest.tolist(), strict=True)]
    digits = np.concatenate(([0], np.cumsum(_IS_DIGIT[laid], dtype=np.int32)))
    kinds = np.where(digits[ends] > digits[starts], -1, LETTERS)
    for i, spans in enumerate(base):
        if spans:
            base_starts = [begins[i] + s for s, _, _ in spans]
            reach = list(accumulate((begins[i] + e for _, _, e in spans), max))
            for j in range(*np.searchsorted(owner, (i, i + 1)).tolist()):
                before = bisect_left(base_starts, ends[j])
                if before and reach[before - 1] > starts[j]:
                    kinds[j] = spans[bisect_right(reach, starts[j])][1]
    return Candidates(laid, begins, base, starts, ends, owner, kinds)


def _stretches(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the candidate, start, end) of the ``pieces`` of candidates."""
    counts = np.maximum(1, -((STRIDE + starts - ends) // STRIDE))
    of = np.repeat(np.arange(len(starts)), counts)
    at = ranges(np.zeros(len(starts), dtype=np.int64), counts) * STRIDE + starts[of]
    return of, at, np.minimum(ends[of], at + WINDOW)


def _window(codes: bytes, start: int, end: int) -> tuple[bytes, int]:
    """``windows_of`` for one stretch of ``laid_out`` texts."""
    return codes[start - CONTEXT:end + CONTEXT].ljust(WIDTH, b"\x81"), end - start


def _findings(model: CharConv | None, turn: int, positives: bool, planted: int, seed: int):
    """Findings of texts: the positives and ``planted`` keys a text, if asked for, and the negatives that the
    model does not place below the margin; without a model all negatives, held out or not."""
    def find(batches):
        for texts, held in _parts(batches, "held"):
            held = np.array(held.to_pylist(), dtype=bool)
            found = candidates(texts)
            codes, rows = found.laid.tobytes(), []
            if positives:
                starts, ends, kinds = found.starts.tolist(), found.ends.tolist(), found.kinds.tolist()
                bounds = np.searchsorted(found.owner, np.arange(len(texts) + 1)).tolist()
                for i, (lo, hi) in enumerate(pairwise(bounds)):
                    if lo == hi:
                        continue
                    sure = [(*_window(codes, a, b), kinds[j]) for j in range(lo, hi) if kinds[j] >= 0 for a, b in pieces(starts[j], ends[j])]
                    around = ([j for j in range(lo, hi) if kinds[j] < 0] if sure else None) or range(lo, hi)
                    rng = np.random.default_rng([seed, zlib.crc32(texts[i].encode("utf-8", "surrogatepass"))])
                    picks = [around[j] for j in rng.integers(len(around), size=planted).tolist()]
                    contexts = [_window(codes, *pieces(starts[j], ends[j])[0]) for j in picks]
                    sure += [(w, n, 3) for w, n in _planted(contexts, rng)]
                    rows += [(w, n, kind, turn, zlib.crc32(w) % HELD == 0) for w, n, kind in sure]
            asked = np.flatnonzero((found.kinds < 0) & ~(held[found.owner] & (model is not None)))
            of, a, b = _stretches(found.starts[asked], found.ends[asked])
            if model is not None:
                kept = np.flatnonzero(model.scan_scores(found.laid, a, b) > -MARGIN)
                of, a, b = of[kept], a[kept], b[kept]
            of = asked[of]
            rows += [(*_window(codes, *x[:2]), x[2], turn, x[3]) for x in zip(
                a.tolist(), b.tolist(), found.kinds[of].tolist(), held[found.owner[of]].tolist(), strict=True)]
            rows = list(dict.fromkeys(rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[j] for r in rows], kind) for j, kind in
                 enumerate((pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.bool_()))], [c.split()[0] for c in FINDING.split(", ")])
    return find


def _arrays(windows: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray]:
    return (np.frombuffer(b"".join(w for w, _ in windows), np.uint8).reshape(len(windows), WIDTH),
            np.array([n for _, n in windows], dtype=np.float32))


def _planted(contexts: list[tuple[bytes, int]], rng: np.random.Generator) -> list[tuple[bytes, int]]:
    """A random key in place of each of the candidates, in its surroundings or after a key's name."""
    alphabets = ["0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
                 "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
                 "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-",
                 "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"]
    names = ["", "", "key = \"", "auth: ", "credential=", "private_key='"]
    out = []
    for codes, n in contexts:
        alphabet = alphabets[int(rng.integers(len(alphabets)))]
        size = int(rng.integers(16, 49))
        key = "".join(alphabet[i] for i in rng.integers(0, len(alphabet), size).tolist())
        left = (codes[:CONTEXT] + names[int(rng.integers(len(names)))].encode())[-CONTEXT:]
        out.append(((left + key.encode() + codes[CONTEXT + n:CONTEXT + n + CONTEXT]).ljust(WIDTH, b"\x81"), size))
    return out


def _steps(adam: Adam, model: CharConv, found: pa.Table, steps: int, first: int, last: int, seed: int) -> None:
    """Steps ``first`` to ``last`` of ``steps``, which together read every finding once or more. Half of a step's
    weight have the positives, in equal shares of the kinds, half the negatives, the mined ones being a kind."""
    found = found.sort_by([("codes", "ascending"), ("length", "ascending"), ("kind", "ascending")])
    codes, lengths = _arrays(list(zip(found.column("codes").to_pylist(), found.column("length").to_pylist(), strict=True)))
    kinds, turns = found.column("kind").to_numpy(), found.column("turn").to_numpy()
    groups = np.where(kinds >= 0, kinds, np.where(turns == 0, kinds, LETTERS - 1))
    rng = np.random.default_rng(seed)
    dealt = []
    for sign in (groups >= 0, groups < 0):
        for g in np.unique(groups[sign]):
            rows, share = rng.permutation(np.flatnonzero(groups == g)), 0.5 / len(np.unique(groups[sign]))
            dealt.append((rows, share, max(math.ceil(BATCH * share), math.ceil(len(rows) / steps))))
    labels = (kinds >= 0).astype(np.float32)
    weights = np.concatenate([np.full(n, share / n, dtype=np.float32) for _, share, n in dealt])
    for i in range(first, last):
        part = np.concatenate([rows.take(range(i * n, (i + 1) * n), mode="wrap") for rows, _, n in dealt])
        adam.step(model.gradients(codes[part], lengths[part], labels[part], weights, MARGIN))


def _learn(adam: Adam, model: CharConv, steps: int, first: int, last: int, seed: int):
    def learn(found):
        _steps(adam, model, found, steps, first, last, seed)
        state = b"".join(x[k].astype(np.float32).tobytes() for x in (adam.params, adam.m, adam.v) for k in sorted(adam.params))
        return pa.table({"state": pa.array([state], pa.binary()), "n": pa.array([found.num_rows], pa.int64())})
    return learn


def _train(adam: Adam, model: CharConv, rows: DataFrame, tasks: int, steps: int, seed: int) -> None:
    """``steps`` steps of each task on its own findings, the parameters averaged between them."""
    rounds = AVERAGES if tasks > 1 else 1
    parts = rows.select("codes", "length", "kind", "turn").groupBy(F.pmod(F.xxhash64("codes", "length"), F.lit(tasks)).alias("part"))
    for r in range(rounds):
        first, last = steps * r // rounds, steps * (r + 1) // rounds
        got = sorted((bytes(r["state"]), r["n"]) for r in parts.applyInArrow(
            _learn(adam, model, steps, first, last, seed), "state binary, n long").collect())
        flat = np.average([np.frombuffer(s, np.float32) for s, _ in got], axis=0, weights=[n for _, n in got]).astype(np.float32)
        for x in (adam.params, adam.m, adam.v):
            for k in sorted(adam.params):
                x[k][...], flat = flat[:x[k].size].reshape(x[k].shape), flat[x[k].size:]
        adam.t += last - first
    model._tables = None


def _bins(raw: np.ndarray) -> np.ndarray:
    return np.rint(np.clip(raw, -MOST_SCORE, MOST_SCORE) * BINS).astype(np.int32)


def _plain_scores(model: CharConv):
    """How many windows of the texts' negatives have a raw score in each bin."""
    def count(batches):
        for (texts,) in _parts(batches):
            found = candidates(texts)
            plain = found.kinds < 0
            _, a, b = _stretches(found.starts[plain], found.ends[plain])
            bins, n = np.unique(_bins(model.scan_scores(found.laid, a, b)), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(bins, pa.int32()), pa.array(n, pa.int64())], ["bin", "n"])
    return count


def _window_scores(model: CharConv):
    def score(batches):
        for batch in batches:
            if batch.num_rows:
                windows = list(zip(batch.column("codes").to_pylist(), batch.column("length").to_pylist(), strict=True))
                raw = model.raw_scores(*_arrays(windows))
                yield pa.RecordBatch.from_arrays([batch.column("kind"), pa.array(raw, pa.float32()), pa.array(_bins(raw), pa.int32())],
                                                 ["kind", "score", "bin"])
    return score


def _calibrate(model: CharConv, positives: DataFrame, docs: DataFrame, recall: float) -> None:
    """Slope, offset, threshold and report from all held-out positives and all negatives of the held-out ``docs``."""
    scored = stored(positives.select("codes", "length", "kind").mapInArrow(_window_scores(model), "kind int, score float, bin int"), "scores")
    sure = scored.groupBy("kind", "bin").count().orderBy("kind", "bin").collect()
    plain = (docs.select("text").mapInArrow(_plain_scores(model), "bin int, n long")
             .groupBy("bin").agg(F.sum("n").alias("n")).orderBy("bin").collect())
    model.slope, model.offset = calibrate(
        np.array([r["bin"] for r in sure + plain]) / BINS, np.array([1.0] * len(sure) + [0.0] * len(plain)),
        weights=np.array([r["count"] for r in sure] + [r["n"] for r in plain], dtype=np.float64))
    least = []
    for k in sorted({r["kind"] for r in sure}):
        mine = [(r["bin"], r["count"]) for r in sure if r["kind"] == k]
        sums = np.cumsum([n for _, n in mine])
        rank = int((sums[-1] - 1) * (1 - recall))         # from 0, of the least score that is kept
        at = int(np.searchsorted(sums, rank, side="right"))
        least.append(scored.filter((F.col("kind") == k) & (F.col("bin") == mine[at][0])).orderBy("score")
                     .offset(rank - int(sums[at] - mine[at][1])).limit(1).first()["score"])
    raw = np.float32(min(least))
    model.threshold = float(model.probability(np.array([raw], dtype=np.float32))[0])
    model.report = {KINDS[r["kind"]]: r["kept"] for r in scored.groupBy("kind").agg(
        F.avg((F.col("score") >= F.lit(float(raw))).cast("double")).alias("kept")).orderBy("kind").collect()}


def fit(docs: DataFrame, sample_rows: int = 4000, most_findings: int = 8000, planted: int = 600, recall: float = 0.98,
        steps: int = 300, mining: int = 3, seed: int = 5) -> CharConv:
    """Train on all findings of all rows of ``docs``.

    Every document has one or more planted keys, ``planted`` or more in all. All negatives of about ``sample_rows`` / 8
    documents train the starting network. Then ``mining`` passes add negatives that it does not place below the
    margin: the first one, if others follow, those of about ``sample_rows`` documents, the others those of all.
    Training tasks have about 8 times ``most_findings`` findings each. The threshold is the largest that keeps ``recall``
    of every kind's held-out positives; ``report`` has the recall of each kind there.
    """
    docs = docs.select("text", F.pmod(F.xxhash64("doc_id", "text", F.lit(91)), F.lit(1 << 30)).alias("slot"),
                       (F.pmod(F.xxhash64("text"), F.lit(HELD)) == 0).alias("held"))
    n = max(docs.count(), 1)
    model, found, trained, read, kept_all = CharConv(seed), None, False, 0.0, False
    adam = Adam(model.params, 0.01)
    for turn in range(mining + 1):
        if not kept_all:                                  # else every negative of every document trains already
            share = 1.0 if turn >= min(2, mining) else min(1.0, sample_rows / (1 if turn else 8) / n)
            some = docs.filter(F.col("slot") < int(share * (1 << 30))).select("text", "held").mapInArrow(
                _findings(model if trained else None, turn if trained else 0, read < 1, math.ceil(planted / n), seed), FINDING)
            some = some if found is None else found.unionByName(some)
            found = stored(some.groupBy("codes", "length", "kind").agg(F.min("turn").alias("turn"), F.min("held").alias("held")), "findings")
            kept_all, read = share == 1 and not trained, share
            counts = {(r["kind"], r["held"]): r["count"] for r in found.groupBy("kind", "held").count().collect()}
            sums = {(sign, out): sum(c for (k, h), c in counts.items() if (k >= 0) == sign and h == out)
                    for sign in (True, False) for out in (True, False)}
            # too few to hold any out: all of them train, and all count as held out
            apart = all(sums.values()) or (trained and sums[True, True] and sums[True, False] and sums[False, False])
            rows = found.filter(~F.col("held")) if apart else found
            size = sum(c for (_, h), c in counts.items() if not (apart and h))
        if sums[False, True] or sums[False, False]:
            adam.rate = 0.01 if turn < mining else 0.003
            _train(adam, model, rows, math.ceil(size / (8 * most_findings)), steps, seed + turn)
            trained = True
    model.findings = {KINDS[k]: sum(c for (kind, _), c in counts.items() if kind == k) for k in sorted({k for k, _ in counts if k >= 0})}
    if trained:
        _calibrate(model, found.filter((F.col("kind") >= 0) & (F.col("held") if apart else F.lit(True))),
                   docs.filter("held") if apart else docs, recall)
    elif counts:
        warnings.warn(f"op10_secrets: {sum(counts.values())} findings and none without a base span: "
                      "the model is not trained and adds no span", stacklevel=2)
    return model


def _mark(model: CharConv):
    def mark(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                texts = [t or "" for t in part.column("text").to_pylist()]
                for at, end in batches_of(texts):
                    yield _mark_rows(model, part.column("doc_id").slice(at, end - at), texts[at:end])
    return mark


def _mark_rows(model: CharConv, doc_ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
    found = candidates(texts)
    spans, plain = found.base, np.flatnonzero(found.kinds < 0)
    of, a, b = _stretches(found.starts[plain], found.ends[plain])
    p = model.probability(model.scan_scores(found.laid, a, b))
    added: list[set] = [set() for _ in texts]
    for j in plain[of[p >= model.threshold]].tolist():
        i = int(found.owner[j])
        added[i].add((int(found.starts[j]) - found.begins[i], 3, int(found.ends[j]) - found.begins[i]))
    name = lambda found: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(found))
    count = lambda k: pa.array([sum(x[1] == k for x in s) for s in spans], pa.int64())
    return pa.RecordBatch.from_arrays(
        [doc_ids, count(0), count(1), count(2),
         pa.array([hashlib.sha256(name(s).encode()).hexdigest() for s in spans], pa.string()),
         pa.array([name([*s, *a]) for s, a in zip(spans, added, strict=True)], pa.string()),
         pa.array([len(a) for a in added], pa.int64())], [c.split()[0] for c in RESULT.split(", ")])


def find_secrets(docs: DataFrame, model: CharConv | None = None, **fit_options) -> DataFrame:
    """The spans of every row of ``docs`` (``RESULT``)."""
    model = model or fit(docs, **fit_options)
    return docs.select("doc_id", "text").mapInArrow(_mark(model), RESULT)
