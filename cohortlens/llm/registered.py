"""Registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    conversations,
    fingerprints,
    jaccard_join,
    line_dedup,
    mixing,
    neighbours,
    packing,
    periodic_runs,
    quality,
    secret_scan,
    substring_dedup,
    toxicity,
)
from .text import table

QUERIES = {}


def ready(spark: SparkSession) -> None:
    """Let Python workers import this package where it lies (a cluster's own
    ``--py-files`` or installed package comes first)."""
    root = str(Path(__file__).resolve().parents[2])
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in path.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{path}:{root}".strip(":")


def register(f):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ready(spark)
        return f(spark, sf_dir)
    QUERIES[f.__name__] = query
    return query


@register
def op1_fingerprints(spark, sf_dir):
    return fingerprints.fingerprints(table(spark, sf_dir, "documents")).drop("next_doc_id")


@register
def op2_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@register
def op3_best_fit_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@register
def op4_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@register
def op5_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.fit(docs, table(spark, sf_dir, "labels"))).select(
        "doc_id", "held_out", "score", "predicted")


@register
def op6_mixing(spark, sf_dir):
    return mixing.Mix(table(spark, sf_dir, "documents")).documents()


@register
def op7_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.line_dedup(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@register
def op9_substring_dedup(spark, sf_dir):
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents")).drop("kept_text")


@register
def op10_secrets(spark, sf_dir):
    return secret_scan.find_secrets(table(spark, sf_dir, "documents"))


@register
def op8_nn_descent(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    asked = vectors.select(F.col("vec_id").alias("id")).filter(F.col("vec_id") % 100 == 0)
    return neighbours.Index(vectors).search(asked)


@register
def op11_conversations(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    return conversations.repair(conversations.damaged(rows), rows)


@register
def op12_bpe(spark, sf_dir):
    tokens = bpe.encode(table(spark, sf_dir, "documents"))
    texts = bpe.decode(tokens.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens")),
                       keep=("doc_id", "n_tokens", "ids"))
    return texts.select("doc_id", "n_tokens", F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@register
def op13_periodic_runs(spark, sf_dir):
    found = periodic_runs.periodic_runs(periodic_runs.repeated_tails(table(spark, sf_dir, "documents")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    best = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        *[best[c].alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"))
