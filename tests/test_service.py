"""File contracts in one job, counts without a second scan, and the streaming service."""
import json
import os

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import model as M
from cohortlens.session import counting_session
from cohortlens.sources import files as IO
from cohortlens.sources import registry as REG
from cohortlens.spec import HEART
from cohortlens.streaming import service


def put(path, name, header, lines=1):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(",".join(header) + "\n" + (",".join("1" for _ in header) + "\n") * lines)


def test_contract_reads_every_file_whatever_its_name(spark, tmp_dir):
    for i in range(5):
        put(tmp_dir, f"part-{i}.csv", HEART.columns, 50)
    open(os.path.join(tmp_dir, "empty.csv"), "w").close()
    assert IO.scan_csv(spark, tmp_dir, HEART).count() == 250
    swapped = list(HEART.columns)
    swapped[1], swapped[2] = swapped[2], swapped[1]
    put(tmp_dir, "more-without-suffix", swapped, 50)
    put(tmp_dir, "and-another", swapped, 50)
    with pytest.raises(IO.ContractError, match="2 file"):
        IO.scan_csv(spark, tmp_dir, HEART)


def test_contract_of_no_files(spark, tmp_dir):
    open(os.path.join(tmp_dir, "empty.csv"), "w").close()
    with pytest.raises(IO.ContractError):
        IO.scan_csv(spark, tmp_dir, HEART)


def test_headers_are_read_one_row_a_file(spark, tmp_dir):
    for i in range(3):
        put(tmp_dir, f"f{i}", HEART.columns, 20_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    headers = IO.csv_headers(spark, tmp_dir).collect()
    assert len(headers) == 3 and all(r.header == list(HEART.columns) for r in headers)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_counts_from_the_write_and_the_footers(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    df = counting_session(spark).range(1000).select("id", (F.col("id") % 3).alias("k"))
    assert IO.write_counted(df, path, "k") == 1000 and IO.stored_rows(spark, path) == 1000
    part = next(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))
    os.remove(part)
    assert IO.stored_rows(spark, path) < 1000
    # models still train and evaluate in the caller's session
    rows = [(float(i % 10), float(i % 4), int(i % 10 > 6), i) for i in range(200)]
    board, _, _ = M.train_leaderboard(spark.createDataFrame(rows, "a double, b double, y int, id int"), ["a", "b"], "y", ["id"],
                                      models=["LogisticRegression"])
    assert board.first().auc_pr > 0


def test_malformed_lines_are_set_aside(spark):
    lines = ['{"request_id": 1, "features": {"a": 1.5, "b": null}}', "no json", "", '{"features": {"a": 1}}',
             '{"request_id": "x"}', '{"request_id": 5}', "[1]", '{"request_id": 6, "features": {"a": "NaN"}}', None]
    requests, malformed = service.parse(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert {r.request_id: r.features.get("a") for r in requests.collect()}.keys() == {1, 5, 6}
    assert malformed.count() == len(lines) - 3


def model(spark, registry, folder, kind):
    rows = [(float(i % 10), float(i % 4), int(i % 10 > 6), i) for i in range(200)]
    M.train_and_save(spark.createDataFrame(rows, "a double, b double, y int, id int"), ["a", "b"], "y", ["id"], registry, folder,
                     models=[kind])


def test_service_answers_once_and_changes_models_between_batches(spark, tmp_dir):
    at = lambda n: os.path.join(tmp_dir, n)
    registry, source, sink, aside, journal, checkpoint = map(at, ("registry", "source", "sink", "aside", "journal", "checkpoint"))
    os.makedirs(source)

    def arrive(name, ids):
        with open(at(f"source/{name}"), "w") as f:
            f.writelines(json.dumps({"request_id": i, "features": {"a": float(i % 10), "b": 1.0}}) + "\n" for i in ids)
            f.write("broken\n")

    model(spark, registry, at("m1"), "NaiveBayes")
    arrive("one", range(0, 10))
    arrive("two", range(10, 20))
    folders = (registry, source, sink, aside, journal, checkpoint)
    service.drain(spark, *folders, files_per_batch=1)
    model(spark, registry, at("m2"), "DecisionTree")
    arrive("three", range(20, 30))
    service.drain(spark, *folders, files_per_batch=1)
    service.drain(spark, *folders)                        # nothing new
    rows = spark.read.parquet(sink).collect()
    assert sorted(r.request_id for r in rows) == list(range(30))
    assert {r.model for r in rows if r.request_id < 20} == {"NaiveBayes"}
    assert {r.model for r in rows if r.request_id >= 20} == {"DecisionTree"}
    assert spark.read.parquet(aside).count() == 3
    # a batch that runs again, as after a failure, keeps the model that its journal names
    handle = service.handler(registry, sink, aside, journal)
    again = spark.read.text(at("source/one"))
    first = int(next(r.batch for r in spark.read.parquet(sink).collect() if r.request_id == 0))
    handle(again, first)
    rows = spark.read.parquet(sink).collect()
    assert sorted(r.request_id for r in rows) == list(range(30))
    assert {r.model for r in rows if r.request_id < 10} == {"NaiveBayes"}


def test_service_needs_a_model(spark, tmp_dir):
    with pytest.raises(REG.RegistryError):
        service._pinned(spark, os.path.join(tmp_dir, "none"), os.path.join(tmp_dir, "journal"), 0)
