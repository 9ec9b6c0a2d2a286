"""Line dedup (native): which lines of each document to keep, as bitmaps.

Method: the hashes of long lines are range-partitioned with document and
position as secondary sort, so one very common line spreads over many ranges.
Each range streams its sorted rows to one row per (line, document), then to
one row per line; only those meet again. Documents get back a compressed
bitmap: the bits of its dropped lines, up to the last one's 64-bit word. Texts move
only when a caller asks for the kept text (``apply_bitmaps``).

Everything is a DataFrame or SQL function.

Defined results: a null text is one empty line; a line shorter than
``min_chars`` is always kept; repeated rows of one doc_id count as one document,
and each keeps or loses the same lines; a null doc_id counts as no document, so
its lines never decide and are never dropped; an empty table gives an empty
result; further columns are carried, those named like a result column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import stored
from .text import SPACES, fresh

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, UPPER.lower())


def repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """(h1, h2, keep_doc, doc_id, words): the lines held by ``min_docs`` documents or
    more, one row per line and document; ``words`` are the bitmap words of its places."""
    # stored before the ranges are sampled, so that no text is split twice
    lines = stored(docs.filter(F.col("doc_id").isNotNull())
             .select("doc_id", F.posexplode(F.transform(lines_of(F.col("text")), line_key)).alias("pos", "key"))
             .filter(F.char_length("key") >= min_chars)
             # two unrelated 64-bit hashes stand for the line
             .select("doc_id", "pos", F.xxhash64("key").alias("h1"),
                     F.xxhash64(F.lit(7), F.reverse("key")).alias("h2")), "line-hashes")
    ranged = (lines.repartitionByRange("h1", "h2", F.col("doc_id").desc())
              .sortWithinPartitions("h1", "h2", F.col("doc_id").desc(), "pos"))
    per_doc = stored(ranged.groupBy("h1", "h2", "doc_id")  # within the range, no further shuffle
                     .agg(F.collect_set("pos").alias("places")), "lines")
    # stored too, so that the join has a shuffle of its own on either side and Spark
    # can split the rows of one very common line over several tasks
    common = stored(per_doc.groupBy("h1", "h2")
                    .agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keep_doc"))
                    .filter(F.col("n_docs") >= min_docs).select("h1", "h2", "keep_doc"), "common-lines")
    return per_doc.join(common, ["h1", "h2"])


def drop_bitmaps(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """One row per document that loses a line: (doc_id, n_dropped, drop), ``drop`` the bits of the
    dropped lines, 64 to a word, up to the last dropped line's word."""
    hits = (repeated_lines(docs, min_chars, min_docs).filter(F.col("doc_id") < F.col("keep_doc"))
            .select("doc_id", F.explode("places").alias("pos")))
    bits = (hits.groupBy("doc_id", (F.col("pos") / 64).cast("int").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits")))
    words = (bits.groupBy("doc_id")
             .agg(F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"),
                  F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("_words")))
    # empty words fill the gaps, so that a line's word is found by its number
    gap = lambda x, i: x["word"] - F.coalesce(F.get("_words", i - 1)["word"], F.lit(-1)) - 1
    dense = F.flatten(F.transform("_words", lambda x, i: F.concat(F.array_repeat(F.lit(0).cast("long"), gap(x, i)), F.array(x["bits"]))))
    return words.select("doc_id", "n_dropped", dense.alias("drop"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The documents with ``kept_text``, ``n_lines`` and ``n_dropped`` added (or replaced)."""
    key, count, drop = fresh(docs, "_id", "_n", "_drop")
    marks = bitmaps.select(F.col("doc_id").alias(key), F.col("n_dropped").alias(count), F.col("drop").alias(drop))
    joined = docs.join(marks, F.col("doc_id") == F.col(key), "left")
    lines = lines_of(F.col("text"))
    kept = F.array_join(F.filter(lines, lambda x, i: F.coalesce(F.getbit(
        F.get(drop, F.floor(i / 64).cast("int")), (i % 64).cast("int")), F.lit(0)) == 0), "\n")
    return (joined
            .withColumn("kept_text", F.when(F.col(drop).isNull(), F.coalesce(F.col("text"), F.lit(""))).otherwise(kept))
            .withColumn("n_lines", F.size(lines).cast("long"))
            .withColumn("n_dropped", F.coalesce(F.col(count), F.lit(0)).cast("long"))
            .drop(key, count, drop))


def line_dedup(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """The documents with ``kept_text``, ``n_lines``, ``n_dropped``."""
    return apply_bitmaps(docs, drop_bitmaps(docs.select("doc_id", "text"), min_chars, min_docs))
