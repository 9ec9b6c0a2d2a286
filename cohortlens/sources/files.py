"""File sources and sinks: contract-checked CSV, partitioned Parquet, manifests."""

from __future__ import annotations

import csv
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import SurveySpec


class ContractError(ValueError):
    """The file's header does not match the table contract."""


def csv_headers(spark: SparkSession, path: str) -> DataFrame:
    """(file, header): the names in the first line of every file that a scan of ``path`` reads.

    One job, with one task per file that stops after the file's first line: no data is read before
    the contract is settled. Every file counts, whatever its name; empty files have no header.
    """
    child = spark.newSession()                            # the caller's split sizes stay as they are
    for key, value in {"spark.sql.files.maxPartitionBytes": str(1 << 50), "spark.sql.files.openCostInBytes": str(1 << 50),
                       "spark.sql.execution.arrow.maxRecordsPerBatch": "1"}.items():
        child.conf.set(key, value)

    def first_line(batches):
        for batch in batches:
            if batch.num_rows:
                names = next(csv.reader([batch.column(1)[0].as_py()]), [])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(0, 1), pa.array([names], pa.list_(pa.string()))],
                                                 ["file", "header"])
                return

    lines = child.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    return lines.mapInArrow(first_line, "file string, header array<string>")


def header_report(headers: DataFrame, spec: SurveySpec, most: int = 20) -> dict[str, str]:
    """{a file: what is wrong with its header and how many files share that} for the headers that differ from the
    contract's names and order, up to ``most`` different ones. Raises where no file has a header."""
    groups = headers.groupBy("header").agg(F.count(F.lit(1)).alias("n"), F.min("file").alias("file"))
    right = F.col("header") == F.array(*[F.lit(c) for c in spec.columns])
    rows = groups.orderBy(right, "header").limit(most + 1).collect()
    if not rows:
        raise ContractError("headers do not match the contract: no CSV file")
    wrong = {}
    for r in rows:
        if r["header"] != list(spec.columns):
            missing = [c for c in spec.columns if c not in r["header"]]
            extra = [c for c in r["header"] if c not in spec.columns]
            wrong[r["file"]] = (f"missing={missing} extra={extra} order_ok={bool(missing or extra)}; got {r['header']} "
                                f"in {r['n']} file(s)")
    return wrong


def check_contract(headers: DataFrame, spec: SurveySpec) -> None:
    """Names and order of every file's header must equal the contract exactly."""
    wrong = header_report(headers, spec)
    if wrong:
        raise ContractError(f"headers do not match the contract: {wrong}")


def scan_csv(spark: SparkSession, path: str, spec: SurveySpec, corrupt_col: str | None = None) -> DataFrame:
    """Contract-checked CSV scan with an explicit all-double schema.

    Empty fields and unparsable tokens become null (PERMISSIVE); with
    ``corrupt_col`` the raw text of such rows is kept for counting.
    ``enforceSchema=False`` makes the reader itself also verify each file's
    header against the schema when rows are read.
    """
    check_contract(csv_headers(spark, path), spec)
    schema = spec.raw_schema
    reader = spark.read.option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
    if corrupt_col:
        schema = T.StructType(schema.fields + [T.StructField(corrupt_col, T.StringType(), True)])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
    return reader.schema(schema).csv(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Result CSV with header. ``single_file`` only for small, aggregated results."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(path)


def write_partitioned(df: DataFrame, path: str, key: str) -> None:
    """Snappy Parquet partitioned by ``key``, overwrite.

    The ``rebalance`` hint shuffles on the key with AQE splitting large
    partitions, so each key value lands in a few well-sized files instead of
    one file per (task, value), and a dominant value is still split.
    """
    (df.hint("rebalance", key).write.mode("overwrite")
       .option("compression", "snappy").partitionBy(key).parquet(path))


def write_counted(df: DataFrame, path: str, key: str) -> int:
    """``write_partitioned``, and the rows that went into it, counted inside the write job.

    Give it a frame of a session of its own (``session.counting_session``): on PySpark 4.1 an observed
    frame leaves later MLlib evaluations of its session failing with "Task not serializable".
    """
    seen = Observation()
    write_partitioned(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, key)
    return int(seen.get["rows"])


def stored_rows(spark: SparkSession, path: str) -> int:
    """The rows of a Parquet folder from its footers: the count is pushed into the scan, no column is read."""
    child = spark.newSession()
    child.conf.set("spark.sql.sources.useV1SourceList", "")             # the pushed count needs the newer reader
    child.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return int(child.read.parquet(path).agg(F.count(F.lit(1))).first()[0])


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan; with a known ``schema`` the footers are not read to infer it."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


# -- selection side table: the chosen feature list travels as a small CSV ------

SELECTION_SCHEMA = "variable string, correlation double, rank bigint, selected boolean"


def write_selection(df: DataFrame, path: str) -> None:
    """The ranked selection (one row per predictor) as one CSV file."""
    write_csv(df.select("variable", "correlation", F.col("rank").cast("bigint"), "selected"), path,
              single_file=True)


def read_selection(spark: SparkSession, path: str) -> DataFrame:
    """The selection table back, in rank order; the order is part of the contract."""
    return spark.read.option("header", True).schema(SELECTION_SCHEMA).csv(path).orderBy("rank")


def selected_names(selection: DataFrame) -> list[str]:
    return [r["variable"] for r in selection.filter("selected").orderBy("rank").select("variable").collect()]


# -- manifest: the row count and schema a producer hands to a consumer --------

MANIFEST_SCHEMA = "dataset string, rows bigint, schema_json string, written_at timestamp"


def write_manifest(spark: SparkSession, path: str, dataset: str, rows: int, schema: T.StructType) -> DataFrame:
    m = spark.createDataFrame([(dataset, int(rows), schema.json())], "dataset string, rows bigint, schema_json string")
    m = m.withColumn("written_at", F.current_timestamp())
    m.coalesce(1).write.mode("append").parquet(path)
    return m


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path)

