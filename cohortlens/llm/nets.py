"""Small numpy training helpers shared by the llm models."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SLOTS = 1 << 62


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class Adam:
    """Adam over a dict of arrays."""

    def __init__(self, params: dict[str, np.ndarray], rate: float = 0.01):
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.params[k] -= (self.rate * (self.m[k] / (1 - 0.9 ** self.t))
                               / (np.sqrt(self.v[k] / (1 - 0.999 ** self.t)) + 1e-8)).astype(self.params[k].dtype)


def calibrate(scores: np.ndarray, labels: np.ndarray, steps: int = 200, weights: np.ndarray | None = None) -> tuple[float, float]:
    """(slope, shift) of a logistic fit of labels on scores, by Newton steps. ``weights``: how often each score occurs.

    Targets are pulled in a little from 0 and 1, so separable scores stay finite;
    the slope is kept positive so the order of scores stays.
    """
    times = np.ones(len(scores)) if weights is None else weights
    n1, n0 = int((labels * times).sum()), int(times.sum() - (labels * times).sum())
    if not n1 or not n0:
        return 1.0, 0.0
    spread = scores.std() if weights is None else np.sqrt(np.cov(scores, aweights=times, ddof=0))
    scale = max(float(spread), 1e-6)
    x = np.stack([scores / scale, np.ones(len(scores))], axis=1)
    y = np.where(labels > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    w = np.array([1.0, 0.0])
    for _ in range(steps):
        p = sigmoid(x @ w)
        grad = x.T @ (times * (p - y)) + 1e-3 * w
        hess = (x * (times * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        w = w - np.clip(np.linalg.solve(hess, grad), -2, 2)
    return max(float(w[0]), 1e-3) / scale, float(w[1])


def sample_ids(ids: DataFrame, most: int, id_col: str = "doc_id") -> list[int]:
    """At most ``most`` distinct ids, about that many if there are more: those with the smallest hash slots.
    Repeated rows of an id count once, and the same table gives the same ids."""
    n = ids.agg(F.approx_count_distinct(id_col)).first()[0]
    slot = F.pmod(F.xxhash64(F.col(id_col), F.lit(91)), F.lit(_SLOTS))
    share = min(1.0, 1.25 * most / max(n, 1))             # a little more, as the count is approximate
    few = ids.filter(slot <= int(share * (_SLOTS - 1))).select(id_col).distinct()
    return sorted(r[0] for r in few.orderBy(slot, id_col).limit(most).collect())


def one_row_each(docs: DataFrame, ids: list[int], text_col: str = "text") -> DataFrame:
    """(doc_id, text) of the ids, the least text where an id repeats: as many rows as ids at most."""
    return docs.filter(F.col("doc_id").isin(ids)).groupBy("doc_id").agg(F.min(text_col).alias("text"))


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(folds))
