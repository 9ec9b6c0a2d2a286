"""Train/test splits and cross-validation folds that do not depend on layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rank import rank_within

SPLIT_BUCKETS = 10_000


def hash_bucket(seed: int, keys: Sequence[str | Column], buckets: int = SPLIT_BUCKETS) -> Column:
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(buckets))


def on_train_side(keys: Sequence[str | Column], train_fraction: float = 0.8, seed: int = 42,
                  bucket: Column | None = None, buckets: int = SPLIT_BUCKETS) -> Column:
    """Whether ``hash_split`` puts a row on the training side."""
    b = bucket if bucket is not None else hash_bucket(seed, keys, buckets)
    return b < F.lit(int(round(train_fraction * buckets)))


def hash_split(df: DataFrame, keys: Sequence[str | Column], train_fraction: float = 0.8,
               seed: int = 42, bucket: Column | None = None,
               buckets: int = SPLIT_BUCKETS) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a predicate on a hash of ``keys``: one pass, no join.

    The same row always lands on the same side, whatever the partitioning,
    retries or re-plans. Hashing the feature columns keeps identical answer
    rows on one side (no train/test leakage); hashing a row id reproduces a
    row-level split. ``bucket`` overrides the hash with any 0..buckets-1
    expression.
    """
    is_train = on_train_side(keys, train_fraction, seed, bucket, buckets)
    return df.filter(is_train), df.filter(~is_train)


def complement(full: DataFrame, part: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of ``full`` whose key is absent from ``part`` (left anti join).

    Bag semantics: repeated rows of ``full`` all survive, unlike ``subtract``.
    Exact as a set complement when ``part`` was chosen by a function of the
    key (then every row sharing a key is on the same side).
    """
    keys = [key] if isinstance(key, str) else list(key)
    return full.join(part.select(*keys), on=keys, how="left_anti")


def sample_split(df: DataFrame, label: str, key: str, train_fraction: float = 0.8,
                 seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test) by ``sampleBy`` within each label value; test is the complement.

    Unlike ``hash_split`` the sample depends on the layout, so store ``df`` first.
    """
    values = [r[0] for r in df.select(label).distinct().collect()]       # the classes
    train = df.sampleBy(label, {v: train_fraction for v in values}, seed)
    return train, complement(df, train, key)


def hash_folds(df: DataFrame, k: int = 3, seed: int = 42, keys: Sequence[str] | None = None,
               fold_col: str = "fold", bucket: Column | None = None) -> DataFrame:
    """Fold = hash of the row's columns mod k: no shuffle, no window.

    ``bucket`` overrides the hash with any whole-number expression.
    Stratified only in expectation (each class splits about evenly), and
    identical rows share a fold; ``stratified_folds`` is exact.
    """
    cols = [F.col(c) for c in (keys or [c for c in df.columns if c != fold_col])]
    number = bucket if bucket is not None else F.xxhash64(F.lit(seed), *cols)
    return df.withColumn(fold_col, F.pmod(number, F.lit(k)).cast("int"))


def stratified_folds(df: DataFrame, label: str, k: int = 3, seed: int = 42,
                     keys: Sequence[str] | None = None, order: Sequence[str | Column] | None = None,
                     fold_col: str = "fold", ranges: int | None = None) -> DataFrame:
    """Assign each row a fold 0..k-1; the folds of every class differ by at most one row.

    A row's fold is its position among the rows of its class modulo k. The order is a hash of
    ``keys`` (all columns), or ``order``; positions come from ``rank``, so no task
    holds a class or a group of equal rows, however large.
    """
    by = list(order) if order else [F.xxhash64(F.lit(seed), *(keys or [c for c in df.columns if c != fold_col]))]
    ranked = rank_within(df, [label], by, "_position", ranges)
    return ranked.withColumn(fold_col, F.pmod("_position", F.lit(k)).cast("int")).drop("_position")
