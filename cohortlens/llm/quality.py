"""Quality classifier by positive-unlabelled learning.

Method: a small network over text statistics, trained to minimise the
non-negative unbiased risk: with trusted positives P, unlabelled text U and the
class prior q, the risk is q E_P[l(+)] + max(0, E_U[l(-)] - q E_P[l(-)]); where
the part in the maximum goes negative, its gradient is followed upwards
instead. The prior is estimated first: a positive-against-unlabelled score is
fitted, and q is the least ratio of the shares of U and of held-out P over any
score, each with its confidence margin (the best bin).

P are documents labelled 1 and U are documents without a label, both outside the
held-out fold, in bounded samples (``positives``, ``unlabelled``). Labels 0 are not
used at all. Statistics cover the whole text: shares of character classes, of
repeated neighbouring words and distinct words, of words that end in marks, of
repeated lines, word and line lengths, and size. Language, source and id are not
inputs.

Defined results: a null text is empty; it gets the score of an empty text; every
row gives a row, also when ids repeat or are null; without positives or
unlabelled rows all scores are 0.5; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .nets import Adam, fold, one_row_each, sample_ids, sigmoid
from .text import batches_of, word_hashes

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
HIDDEN = 16

# classes of bytes; a character outside ASCII counts by its bytes
_CLASS = np.full(256, 6, dtype=np.int64)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[48:58] = 1
_CLASS[65:91] = 2
_CLASS[97:123] = 3
_CLASS[[ord(c) for c in ".,;:'\"()-?"]] = 4
_CLASS[[ord(c) for c in "!|%&$*#@~^_=+<>/\\[]{}`"]] = 5
_CLASSES = 7


def statistics(texts: list[str]) -> np.ndarray:
    """One row of numbers for each text."""
    n = len(texts)
    raw = [t.encode() for t in texts]
    buf = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    ends = np.cumsum([len(r) + 1 for r in raw])
    text_no = np.repeat(np.arange(n), np.diff(np.concatenate(([0], ends))))
    kind = _CLASS[buf]
    shares = np.bincount(text_no * _CLASSES + kind, minlength=n * _CLASSES).reshape(n, _CLASSES).astype(float)
    size = np.maximum(shares.sum(axis=1, keepdims=True), 1)
    words, first = word_hashes(texts)
    n_words = np.diff(first)
    of_word = np.repeat(np.arange(n), n_words)
    per_word = 1 / np.maximum(n_words, 1)
    same_text = of_word[1:] == of_word[:-1]
    again = np.bincount(of_word[1:][(words[1:] == words[:-1]) & same_text], minlength=n) * per_word
    pair = words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:]

    def distinct(values, owner):
        order = np.lexsort((values, owner))
        v, o = values[order], owner[order]
        new = np.ones(len(v), dtype=bool)
        new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
        return np.bincount(o[new], minlength=n)

    n_pairs = np.maximum(n_words - 1, 1)
    marked = np.flatnonzero((kind[:-1] == 5) & (kind[1:] == 0))
    lines = np.array([len(ls) for ls in (t.split("\n") for t in texts)], dtype=float)
    lines_new = np.array([len(set(t.split("\n"))) for t in texts], dtype=float)
    return np.column_stack([
        shares / size, again, distinct(words, of_word) / np.sqrt(np.maximum(n_words, 1)),
        distinct(words, of_word) * per_word, distinct(pair[same_text], of_word[1:][same_text]) / n_pairs,
        np.bincount(text_no[marked], minlength=n) * per_word, 1 - lines_new / lines,
        np.log1p(n_words), np.log1p(shares.sum(axis=1)) - np.log1p(n_words), np.log1p(lines)])


def all_statistics(texts: list[str]) -> np.ndarray:
    return np.concatenate([statistics(texts[a:b]) for a, b in batches_of(texts)])


class Network:
    """Standardised inputs, one hidden layer, one output."""

    def __init__(self, inputs: np.ndarray, seed: int):
        rng = np.random.default_rng(seed)
        self.mean, self.spread = inputs.mean(axis=0), inputs.std(axis=0) + 1e-3
        self.params = {"w1": rng.standard_normal((inputs.shape[1], HIDDEN)) * 0.3, "b1": np.zeros(HIDDEN),
                       "w2": rng.standard_normal(HIDDEN) * 0.3, "b2": np.zeros(1)}

    def hidden(self, x: np.ndarray):
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        return z, np.tanh(z @ self.params["w1"] + self.params["b1"])

    def output(self, x: np.ndarray) -> np.ndarray:
        return self.hidden(x)[1] @ self.params["w2"] + self.params["b2"][0]

    def gradients(self, x: np.ndarray, d_out: np.ndarray) -> dict[str, np.ndarray]:
        z, h = self.hidden(x)
        d_hidden = d_out[:, None] * self.params["w2"][None, :] * (1 - h * h)
        return {"w1": z.T @ d_hidden, "b1": d_hidden.sum(axis=0), "w2": h.T @ d_out, "b2": np.array([d_out.sum()])}


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, least: int = 30, delta: float = 0.1) -> float:
    """Share of positives in the unlabelled scores, from the best bin [c, infinity)."""
    margin = lambda n: np.sqrt(np.log(4 / delta) / (2 * n))
    cuts = np.sort(positive)[:max(1, len(positive) - least)]
    p = 1 - np.searchsorted(np.sort(positive), cuts) / len(positive)
    u = 1 - np.searchsorted(np.sort(unlabelled), cuts) / len(unlabelled)
    best = int(np.argmin((u + margin(len(unlabelled)) + margin(len(positive))) / p))
    return float(np.clip(u[best] / p[best], 0.05, 0.98))


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 200, seed: int = 9,
          rate: float = 0.01) -> Network:
    """Non-negative PU risk with the logistic loss."""
    net = Network(np.concatenate((positive, unlabelled)), seed)
    adam, rng = Adam(net.params, rate), np.random.default_rng(seed)
    for _ in range(steps):
        p = positive[rng.integers(0, len(positive), 512)]
        u = unlabelled[rng.integers(0, len(unlabelled), 512)]
        fp, fu = net.output(p), net.output(u)
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        # derivative of log(1 + exp(-f)) is s(f) - 1, of log(1 + exp(f)) is s(f)
        down_p, down_u = -prior * sigmoid(fp) / len(fp), sigmoid(fu) / len(fu)
        if negative >= 0:
            d_p, d_u = prior * (sigmoid(fp) - 1) / len(fp) + down_p, down_u
        else:
            d_p, d_u = -down_p, -down_u
        adam.step(net.gradients(np.concatenate((p, u)), np.concatenate((d_p, d_u))))
    return net


def fit(docs: DataFrame, labels: DataFrame, positives: int = 3000, unlabelled: int = 3000,
        seed: int = 9) -> Network | None:
    """The trained network; None without rows to learn from."""
    known = docs.filter(F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT)).select("doc_id")
    good = labels.filter("quality = 1").select("doc_id").distinct()
    ids_p = sample_ids(known.join(good, "doc_id", "left_semi"), positives)
    ids_u = sample_ids(known.join(labels.select("doc_id"), "doc_id", "left_anti"), unlabelled)

    def texts(ids):
        rows = (one_row_each(docs, ids)
                .mapInArrow(_statistics_rows, "doc_id long, x array<double>").collect())
        return np.array([r["x"] for r in sorted(rows)])

    if not ids_p or not ids_u:
        return None
    p, u = texts(ids_p), texts(ids_u)
    # positive against unlabelled, its held-out positives give the prior
    half = np.random.default_rng(seed).random(len(p)) < 0.5
    if 30 < half.sum() < len(p):
        scorer = train(p[half], u, 0.5, steps=60, seed=seed)   # stopped early, or it learns its rows by heart
        prior = estimate_prior(scorer.output(p[~half]), scorer.output(u))
    else:
        prior = 0.5
    net = train(p, u, prior, seed=seed)
    net.prior = prior
    return net


def _statistics_rows(batches):
    for batch in batches:
        x = all_statistics([t or "" for t in batch.column("text").to_pylist()]) if batch.num_rows else []
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([list(r) for r in x], pa.list_(pa.float64()))],
                                         ["doc_id", "x"])


def _score_rows(net: Network | None, threshold: float):
    def score(batches):
        for batch in batches:
            n = batch.num_rows
            texts = [t or "" for t in batch.column("text").to_pylist()]
            p = sigmoid(net.output(all_statistics(texts))) if net is not None and n else np.full(n, 0.5)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(p, pa.float64()), pa.array((p >= threshold).astype(np.int32))],
                [*batch.schema.names, "score", "predicted"])
    return score


def score_quality(docs: DataFrame, net: Network | None, threshold: float = THRESHOLD,
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, score, predicted and the ``keep`` columns, for every row of ``docs``."""
    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    scored = docs.select("doc_id", held.alias("held_out"), "text", *[c for c in keep if c not in ("doc_id", "text")])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in scored.schema.fields)
    out = scored.mapInArrow(_score_rows(net, threshold), f"{fields}, score double, predicted int")
    return out if "text" in keep else out.drop("text")
