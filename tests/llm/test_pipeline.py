"""The pipeline's stages on a small table, and what is registered."""
import __spark_entry__ as entry

import corpus_pipeline
from cohortlens.llm import quality
from cohortlens.llm.text import table

SF = "/root/testdata/sf0.001"


def test_registered():
    names = [k for k in entry.queries() if k.startswith("op") or k == "pipeline"]
    assert sorted(int(k[2:].split("_")[0]) for k in names if k != "pipeline") == list(range(1, 14))
    assert "pipeline" in names and {"op2_jaccard_join", "op7_line_dedup", "op9_substring_dedup"} <= set(entry.oracle_sql())


def test_stages(spark, tmp_path):
    """Each stage works on what its predecessor kept, and its decisions take effect."""
    docs = table(spark, SF, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        if name != "best_fit_packing":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
            assert docs.join(before, "doc_id", "left_anti").isEmpty()
            kept[name] = {r.doc_id: r for r in docs.collect()}
    start = table(spark, SF, "documents")
    net = quality.fit(start, table(spark, SF, "labels"))
    good = {r.doc_id for r in quality.score_quality(start, net).collect() if r.predicted == 1}
    assert set(kept["quality"]) == good == set(kept["line_dedup"])
    assert set(kept["jaccard_join"]) < good
    sizes = {r.doc_id: len(r.text.split()) for r in kept["mixing"].values()}
    whole = {i: len((r.text or "").encode().split()) for i, r in kept["jaccard_join"].items()}
    assert abs(sum(sizes.values()) / sum(whole.values()) - 1.5) < 0.1
    assert all(n <= 2 * whole[i] for i, n in sizes.items())
    assert {r.doc_id for r in docs.select("doc_id").collect()} == set(kept["mixing"])


def test_stages_on_an_empty_table(spark, tmp_path):
    docs = table(spark, SF, "documents").filter("false")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert docs.isEmpty()
