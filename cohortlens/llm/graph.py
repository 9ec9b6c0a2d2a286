"""Connected components and shared-folder tables for the iterative operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later steps neither
    recompute it nor depend on the executors that made it."""
    spark: SparkSession = df.sparkSession
    path = f"{checkpoint_root(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(id, comp): for each of ``nodes(id)`` the smallest id reachable by ``links(a, b)``.

    Smallest-label passing with a jump along the labels after each step, so the
    number of rounds grows with the logarithm of a component's diameter. Each
    round is stored; only a count reaches the driver.
    """
    both = stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                  "links")
    # only linked nodes take part in the rounds
    labels = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("low")).select(
        "id", F.least("id", "low").alias("comp"))
    labels = stored(labels, "labels")
    while True:
        seen = (both.join(labels.select(F.col("id").alias("b"), F.col("comp").alias("near")), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("near").alias("near")))
        step = labels.join(seen, "id").select(
            "id", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        jump = step.select(F.col("id").alias("comp"), F.col("comp").alias("far"))
        labels = stored(step.join(jump, "comp").select("id", "old", F.least("comp", "far").alias("comp")), "labels")
        if labels.filter(F.col("comp") < F.col("old")).isEmpty():
            break
        labels = labels.select("id", "comp")
    found = labels.select("id", F.col("comp").alias("_comp"))
    return nodes.join(found, "id", "left").select("id", F.coalesce("_comp", "id").alias("comp"))
