"""Toxicity: a bidirectional gated recurrent network over all overlapping windows.

Method: each word enters as a hashed word embedding beside the mean of its hashed
character trigram embeddings. Two gated recurrent units read a window of words
in both directions; attention pools their states; one output gives the window's
score. Windows overlap by half and cover the whole text, the last one reaching
its end; a document's score is its largest window score, calibrated by a
logistic fit on documents held out of training. Everything is numpy.

Training (``fit``): bounded samples of labelled documents outside the held-out
fold, by class, of at most ``most_words`` words. Which window of a toxic document
is toxic is not known, so at first all its windows count, and from the second
pass on those that score highest. Labels, language, source and id are not inputs.

Words are runs between white space and marks, ASCII letters in lower case. A
batch of texts works out the input of each distinct word once.

Defined results: a null or empty text is one window without words and gets the
score of that; every row gives a row, also when ids repeat or are null; without
labelled rows of both classes all scores are 0.5; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .nets import Adam, calibrate, fold, one_row_each, sample_ids, sigmoid
from .text import SPACES, batches_of_sizes, ranges, span_hashes, word_spans

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
WINDOW, STRIDE = 32, 16
HIDDEN, WORD_DIM, CHAR_DIM = 8, 8, 8
CHAR_SLOTS = 1 << 12
BATCH_WINDOWS = 2048
EMBEDDING_RATE = 0.05
MIN_HELD = 25                   # documents of either label that calibrate apart from training
MIN_DOCUMENTS = 4               # training documents that must hold a slot for it to be learned
_BREAKS = np.zeros(256, dtype=bool)
_BREAKS[[ord(c) for c in SPACES + ".,;:!?\"'()[]{}*_-"]] = True


def slots_of(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Place of each hash in the sorted ``known`` ones, from 1; 0 for others."""
    if not len(known):
        return np.zeros(len(hashes), dtype=np.int64)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, at + 1, 0)


class Words:
    """The words of some texts: ``numbers`` of all in order (from 1), ``first`` of each
    text, and for each number (0 being no word) its input slots."""

    def __init__(self, texts: list[str | None], known: np.ndarray):
        buf, starts, ends, self.first = word_spans(texts, True, _BREAKS)
        hashes = span_hashes(buf, starts, ends)
        self.hashes, one, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        self.numbers = (inverse + 1).astype(np.int32)
        self.slots = np.concatenate(([0], slots_of(self.hashes, known)))
        # every byte of a word with its neighbours; beyond the word's ends there is nothing
        code = np.where(_BREAKS[buf], 0, buf).astype(np.uint8)
        sizes = ends[one] - starts[one]
        at = ranges(starts[one], sizes)
        near = [code[at + k].astype(np.uint32) for k in (-1, 0, 1)]       # the last byte is a break
        grams = (near[0] << np.uint32(16)) | (near[1] << np.uint32(8)) | near[2]
        self.grams = (1 + (grams * np.uint32(0x9E3779B1) >> np.uint32(8)) % np.uint32(CHAR_SLOTS - 1)).astype(np.int64)
        self.sizes = np.concatenate(([0], sizes))
        self.starts = np.cumsum(self.sizes) - self.sizes

    def part(self, used: np.ndarray) -> tuple[np.ndarray, ...]:
        """(word slot, trigram slots flat, word of each, share of each) of some numbers."""
        sizes = self.sizes[used]
        starts = self.starts[used]
        owner = np.repeat(np.arange(len(used)), sizes)
        return self.slots[used], self.grams[ranges(starts, sizes)], owner, (1 / np.maximum(sizes, 1))[owner].astype(np.float32)

    def all(self) -> tuple[np.ndarray, ...]:
        return self.part(np.arange(len(self.slots)))

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers of each window, padded with 0; windows of each text): a window every
        STRIDE words, the last one ending with the text."""
        n = np.diff(self.first)
        counts = np.where(n <= WINDOW, 1, 1 + -(-(n - WINDOW) // STRIDE))
        text_no = np.repeat(np.arange(len(n)), counts)
        place = ranges(np.zeros(len(n), dtype=np.int64), counts) * STRIDE
        place = np.maximum(np.minimum(place, n[text_no] - WINDOW), 0)[:, None] + np.arange(WINDOW)
        padded = np.append(self.numbers, 0)
        index = np.where(place < n[text_no][:, None], place + self.first[:-1][text_no][:, None], len(self.numbers))
        return padded[index], counts


class BiGru:
    def __init__(self, known: np.ndarray, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.known = known                                # sorted hashes of the words with an embedding
        normal = lambda *shape, s: (rng.standard_normal(shape) * s).astype(np.float32)
        inputs = WORD_DIM + CHAR_DIM
        self.params = {"word": normal(len(known) + 1, WORD_DIM, s=0.02), "char": normal(CHAR_SLOTS, CHAR_DIM, s=0.05),
                       "attend": normal(2 * HIDDEN, s=0.3), "out": normal(2 * HIDDEN, s=0.3),
                       "shift": np.array([-1.0], dtype=np.float32)}
        for d in ("f", "b"):
            self.params |= {f"in_{d}": normal(inputs, 3 * HIDDEN, s=0.4), f"bias_{d}": np.zeros(3 * HIDDEN, np.float32),
                            f"gate_{d}": normal(HIDDEN, 2 * HIDDEN, s=0.3), f"new_{d}": normal(HIDDEN, HIDDEN, s=0.3)}
        self.params["word"][0] = 0
        self.slope, self.offset = 1.0, 0.0

    def word_vectors(self, words: np.ndarray, grams: np.ndarray, owner: np.ndarray, share: np.ndarray) -> np.ndarray:
        chars = np.zeros((len(words), CHAR_DIM), dtype=np.float32)
        picked = self.params["char"][grams] * share[:, None]
        for e in range(CHAR_DIM):
            chars[:, e] = np.bincount(owner, picked[:, e], len(words))
        return np.concatenate((self.params["word"][words], chars), axis=1)

    def projected(self, vectors: np.ndarray) -> list[np.ndarray]:
        return [vectors @ self.params[f"in_{d}"] + self.params[f"bias_{d}"] for d in ("f", "b")]

    def run(self, inputs: np.ndarray, mask: np.ndarray | None, d: str, keep: bool = False):
        """States (steps, rows, HIDDEN) of one direction; ``inputs`` (steps, rows, 3 HIDDEN) in reading order."""
        gate, new = self.params[f"gate_{d}"], self.params[f"new_{d}"]
        h = np.zeros((inputs.shape[1], HIDDEN), dtype=np.float32)
        states, kept = np.empty((*inputs.shape[:2], HIDDEN), dtype=np.float32), []
        for t, x in enumerate(inputs):
            both = h @ gate
            both += x[:, :2 * HIDDEN]
            np.negative(both, out=both)
            np.exp(np.minimum(both, 30, out=both), out=both)
            both += 1
            np.reciprocal(both, out=both)
            z, r = both[:, :HIDDEN], both[:, HIDDEN:]
            c = np.tanh((r * h) @ new + x[:, 2 * HIDDEN:])
            after = h + z * (c - h)
            if mask is not None:
                after = np.where(mask[t][:, None], after, h)
            if keep:
                kept.append((h, z, r, c))
            h = states[t] = after
        return (states, kept) if keep else states

    def pooled(self, states: np.ndarray, mask: np.ndarray | None):
        """Attention over the steps: (context, weights)."""
        e = states @ self.params["attend"]
        if mask is not None:
            e = np.where(mask, e, -1e9)
        a = np.exp(e - e.max(axis=0))
        if mask is not None:
            a *= mask
        a /= np.maximum(a.sum(axis=0), 1e-9)
        return np.einsum("tb,tbh->bh", a, states), a

    def raw_scores(self, numbers: np.ndarray, projected: list[np.ndarray]) -> np.ndarray:
        """Output of each window; ``numbers`` (windows, WINDOW), 0 being no word."""
        out = np.empty(len(numbers), dtype=np.float32)
        for i in range(0, len(numbers), BATCH_WINDOWS):
            part = numbers[i:i + BATCH_WINDOWS].T
            mask = None if (part > 0).all() else part > 0
            f = self.run(projected[0][part], mask, "f")
            back = part[::-1]
            b = self.run(projected[1][back], None if mask is None else mask[::-1], "b")[::-1]
            context, _ = self.pooled(np.concatenate((f, b), axis=2), mask)
            out[i:i + BATCH_WINDOWS] = context @ self.params["out"] + self.params["shift"][0]
        return out

    def gradients(self, numbers: np.ndarray, labels: np.ndarray, weights: np.ndarray, inputs: tuple[np.ndarray, ...]):
        """Gradients of the weighted logistic loss of windows, rows of word numbers of ``inputs``."""
        words, flat, owner, share = inputs
        vectors = self.word_vectors(*inputs)
        part = numbers.T
        mask = part > 0
        steps = {"f": part, "b": part[::-1]}
        masks = {"f": mask, "b": mask[::-1]}
        x = {d: vectors[steps[d]] for d in steps}
        run = {d: self.run(x[d] @ self.params[f"in_{d}"] + self.params[f"bias_{d}"], masks[d], d, True) for d in steps}
        states = np.concatenate((run["f"][0], run["b"][0][::-1]), axis=2)
        context, a = self.pooled(states, mask)
        score = context @ self.params["out"] + self.params["shift"][0]
        d_score = ((sigmoid(score) - labels) * weights / weights.sum()).astype(np.float32)
        grads = {"out": context.T @ d_score, "shift": np.array([d_score.sum()], np.float32)}
        d_context = d_score[:, None] * self.params["out"]
        d_a = np.einsum("bh,tbh->tb", d_context, states)
        d_e = a * (d_a - (a * d_a).sum(axis=0))
        grads["attend"] = np.einsum("tb,tbh->h", d_e, states)
        d_states = a[:, :, None] * d_context[None] + d_e[:, :, None] * self.params["attend"]
        d_vectors = np.zeros_like(vectors)
        for d, d_h_all in (("f", d_states[:, :, :HIDDEN]), ("b", d_states[::-1, :, HIDDEN:])):
            gate, new = self.params[f"gate_{d}"], self.params[f"new_{d}"]
            d_gate, d_new, d_h = np.zeros_like(gate), np.zeros_like(new), np.zeros(d_h_all.shape[1:], np.float32)
            d_x = np.empty((*part.shape, 3 * HIDDEN), dtype=np.float32)
            for t in range(len(part) - 1, -1, -1):
                h, z, r, c = run[d][1][t]
                live = masks[d][t][:, None]
                d_after = (d_h + d_h_all[t])
                go = np.where(live, d_after, 0)
                d_z, d_c = go * (c - h) * z * (1 - z), go * z * (1 - c * c)
                d_rh = d_c @ new.T
                d_r = d_rh * h * r * (1 - r)
                both = np.concatenate((d_z, d_r), axis=1)
                d_new += (r * h).T @ d_c
                d_gate += h.T @ both
                d_h = np.where(live, go * (1 - z) + d_rh * r + both @ gate.T, d_after)
                d_x[t] = np.concatenate((both, d_c), axis=1)
            flat_x = d_x.reshape(-1, 3 * HIDDEN)
            grads |= {f"gate_{d}": d_gate, f"new_{d}": d_new, f"bias_{d}": flat_x.sum(axis=0),
                      f"in_{d}": x[d].reshape(len(flat_x), -1).T @ flat_x}
            d_in = flat_x @ self.params[f"in_{d}"].T
            at = steps[d].reshape(-1)
            for e in range(d_in.shape[1]):
                d_vectors[:, e] += np.bincount(at, d_in[:, e], len(vectors))
        d_vectors[0] = 0
        grads["word"] = np.stack([np.bincount(words, d_vectors[:, e], len(self.known) + 1) for e in range(WORD_DIM)], 1)
        d_char = d_vectors[owner, WORD_DIM:] * share[:, None]
        grads["char"] = np.stack([np.bincount(flat, d_char[:, e], CHAR_SLOTS) for e in range(CHAR_DIM)], 1)
        return {k: g.astype(np.float32) for k, g in grads.items()}


    def raw(self, texts: list[str | None]) -> np.ndarray:
        """Largest window output of each text."""
        words = Words(texts, self.known)
        numbers, counts = words.windows()
        projected = self.projected(self.word_vectors(*words.all()))
        short = numbers[:, -1] == 0                       # padded windows apart: the rest need no mask
        out = np.empty(len(numbers), dtype=np.float32)
        for group in (short, ~short):
            if group.any():
                out[group] = self.raw_scores(numbers[group], projected)
        return np.maximum.reduceat(out, np.cumsum(counts) - counts) if len(counts) else out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return sigmoid(self.slope * self.raw(texts).astype(float) + self.offset)


def _surprise(slots_by_doc, labels: np.ndarray, n_slots: int):
    """(how much oftener each slot is in documents of label 1 than its share of all, in
    deviations; whether ``MIN_DOCUMENTS`` hold it)."""
    total, ones = np.zeros(n_slots), np.zeros(n_slots)
    for slots, y in zip(slots_by_doc, labels, strict=True):
        slots = np.unique(slots)
        total[slots] += 1
        ones[slots] += y
    expected = total * labels.mean()
    common = total >= MIN_DOCUMENTS
    return np.where(common, np.clip((ones - expected) / np.sqrt(expected + 1) / 3, -2, 4), 0), common


def train(texts: list[str], labels: np.ndarray, passes: int = 8, batch: int = 256, seed: int = 1,
          rate: float = 0.01) -> BiGru:
    """Train on documents; a quarter of them, if enough, calibrates the scores.

    Words and trigrams of few documents would be learned by heart: they have no
    embedding, as unseen ones have none. The first value of the others starts from
    how surprising they are in toxic training documents.
    """
    rng = np.random.default_rng(seed)
    held = rng.random(len(texts)) < 0.25
    if min(labels[held].sum(), (1 - labels[held]).sum()) < MIN_HELD:
        held[:] = False                                   # too few: calibrate on what was learned from
    own = Words([t for t, h in zip(texts, held, strict=True) if not h], np.zeros(0, np.uint64))
    of_docs = [np.unique(x) for x in np.split(own.numbers, own.first[1:-1])]
    start, common = _surprise((x - 1 for x in of_docs), labels[~held], len(own.hashes))
    net = BiGru(own.hashes[common], seed)
    net.params["word"][1:, 0] += start[common]
    start, common = _surprise((own.part(x)[1] for x in of_docs), labels[~held], CHAR_SLOTS)
    net.params["char"][:, 0] += start
    net.params["char"] *= common[:, None]
    net.params["word"][0] = 0
    learned = {"word": (np.arange(len(net.known) + 1) > 0)[:, None], "char": common[:, None]}
    words = Words(texts, net.known)
    numbers, counts = words.windows()
    owner = np.repeat(np.arange(len(texts)), counts)
    toxic, clean = (np.flatnonzero(~held[owner] & (labels[owner] == y)) for y in (1, 0))
    # embeddings move slowly, or the windows would be learned by heart
    adam = Adam({k: v for k, v in net.params.items() if k not in learned}, rate)
    slow = Adam({k: net.params[k] for k in learned}, EMBEDDING_RATE * rate)
    for turn in range(passes):
        if turn:
            projected = net.projected(net.word_vectors(*words.all()))
            raw = net.raw_scores(numbers[toxic], projected)
            hard = clean[np.argsort(-net.raw_scores(numbers[clean], projected), kind="stable")[:max(batch, len(clean) // 20)]]
        else:
            raw, hard = net.params["word"][:, 0][words.slots[numbers[toxic]]].max(axis=1), clean
        order = np.lexsort((-raw, owner[toxic]))
        docs = owner[toxic][order]
        chosen = toxic[order[np.arange(len(docs)) == np.searchsorted(docs, docs)]]
        for _ in range(60):
            part = np.concatenate((rng.choice(chosen, batch // 2), rng.choice(clean, batch // 4), rng.choice(hard, batch // 4)))
            y = np.repeat(np.array([1, 0], dtype=np.float32), batch // 2)
            # only the words of the batch take part in this step
            used, local = np.unique(np.concatenate(([0], numbers[part].reshape(-1))), return_inverse=True)
            grads = net.gradients(local[1:].reshape(len(part), WINDOW), y, np.ones(batch, np.float32), words.part(used))
            slow.step({k: grads.pop(k) * m for k, m in learned.items()})
            adam.step(grads)
    judged = np.flatnonzero(held) if held.any() else np.arange(len(texts))
    net.slope, net.offset = calibrate(net.raw([texts[i] for i in judged]).astype(float), labels[judged])
    return net


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 2500, most_words: int = 3000, seed: int = 1) -> BiGru | None:
    """Train on about ``per_class`` documents of each label (``most_words`` words at most)."""
    known = (docs.filter(F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT)).select("doc_id"))
    ids = {}
    for y in (0, 1):
        marked = labels.filter(F.col("toxic") == y).select("doc_id").distinct()
        for i in sample_ids(known.join(marked, "doc_id", "left_semi"), per_class):
            ids[i] = y
    if len(set(ids.values())) < 2:
        return None
    rows = one_row_each(docs.filter(F.octet_length("text") <= 12 * most_words), list(ids)).collect()
    rows = sorted((r["doc_id"], r["text"] or "") for r in rows)
    rows = [(i, t) for i, t in rows if len(t.encode().split()) <= most_words]
    y = np.array([ids[i] for i, _ in rows])
    return train([t for _, t in rows], y, seed=seed) if len(set(y)) == 2 else None


def _score_rows(net: BiGru | None, threshold: float):
    def score(batches):
        for batch in batches:
            texts = batch.column("text")
            p = np.full(len(texts), 0.5)
            sizes = pc.fill_null(pc.utf8_length(texts), 0).to_pylist() if net is not None else []
            for at, end in batches_of_sizes(sizes):       # only the texts at hand are Python objects
                p[at:end] = net.scores(texts.slice(at, end - at).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])
    return score


def score_toxicity(docs: DataFrame, net: BiGru | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    held = F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return docs.select("doc_id", held.alias("held_out"), "text").mapInArrow(
        _score_rows(net, threshold), "doc_id long, held_out boolean, score double, predicted int")
