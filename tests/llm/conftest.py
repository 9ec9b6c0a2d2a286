import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# further columns, some named like what operators use inside or return
ODD = ("chunk", "key", "bucket", "size", "row", "_id", "_drop", "_size", "_copy", "start", "score", "kept_text", "guest")


@pytest.fixture(scope="session", autouse=True)
def package(spark):
    from cohortlens.llm.registered import ready
    ready(spark)


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) rows, in a few partitions, with odd columns."""
    from pyspark.sql import functions as F

    def build(rows, partitions=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, SCHEMA).repartition(partitions) if full else spark.createDataFrame([], SCHEMA)
        return df.select("*", *[F.lit(f"odd {c}").alias(c) for c in ODD])
    return build


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
