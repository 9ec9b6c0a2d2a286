"""The corpus pipeline: documents in, packed training sequences out.

``STAGES`` lists (name, function). Each function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import graph, jaccard_join, line_dedup, mixing, packing, quality
from cohortlens.llm.registered import ready
from cohortlens.llm.text import table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 1: documents that the quality classifier rejects go.

    Every row is judged by its own text, so repeated rows and rows with a null id are each kept or not;
    a null or empty text is scored like any other; further columns are left out; no rows give none.
    """
    ready(spark)
    net = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, net, keep=COLUMNS).filter("predicted = 1").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 2: long lines of many documents stay only in the largest doc_id that
    holds them. A document may end up with an empty text; it stays.

    Rows of one id lose the same lines; a row with a null id loses none, and its lines count for no
    document; a null text stays null; further columns are left out; no rows give none.
    """
    ready(spark)
    kept = line_dedup.line_dedup(docs.select(*COLUMNS))
    changed = F.col("n_dropped") > 0
    return (kept.withColumn("text", F.when(changed, F.col("kept_text")).otherwise(F.col("text")))
            .withColumn("n_chars", F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
            .select(*COLUMNS))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 3: of the documents in one Jaccard component, the smallest doc_id stays, as one row.

    Rows of one id are one document: the least by text, language, source and length stays. Rows with a null id
    link with nothing; of those with equal texts (a null text equals an empty one) one stays. Documents without
    words link with nothing and stay. Further columns are left out; no rows give none.
    """
    ready(spark)
    classes = jaccard_join.jaccard_join(docs)
    others = classes.filter(F.col("component_id") != F.col("doc_id")).select(F.col("doc_id").alias("_id")).distinct()
    kept = docs.select(*COLUMNS).join(others, F.col("doc_id") == F.col("_id"), "left_anti")
    # rows whose id stands alone pass as they are; only the others are grouped
    again = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1 OR doc_id IS NULL").select(
        F.col("doc_id").alias("_again"))
    same = F.col("doc_id").eqNullSafe(F.col("_again"))
    alone = F.when(F.col("doc_id").isNull(), F.sha2(F.coalesce("text", F.lit("")), 256))
    first = (kept.join(again, same, "left_semi").groupBy("doc_id", alone.alias("_text"))
             .agg(F.min(F.struct("text", "lang", "source", "n_chars")).alias("_row")))
    return kept.join(again, same, "left_anti").unionByName(first.select("doc_id", "_row.*"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 4: the words that the mix takes of each document, repeats after the
    first pass; documents that it takes nothing of go.

    Every row is a document of its own, null ids and sources too; a document without words goes; further
    columns are left out; no rows give none.
    """
    ready(spark)
    taken = mixing.Mix(docs.select(*COLUMNS)).texts()
    return taken.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 5: pieces of the documents in sequences of at most 2048 tokens.

    Every row is a document of its own, null ids too; a null or empty text is the end token alone; no rows
    give none.
    """
    ready(spark)
    return packing.pack(docs)


STAGES = [
    ("quality", keep_good_documents),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", keep_one_of_near_copies),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = graph.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
