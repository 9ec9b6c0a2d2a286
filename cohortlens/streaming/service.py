"""A scoring service as a stream of micro-batches: JSON lines in, scores and refusals out.

Each micro-batch is scored by the newest registered model. Which model that was is written to a
journal under the batch's number before anything is scored, so a batch that runs again after a
failure uses the same model and overwrites its own output: every request is answered once. A
model registered between two batches takes over at the next one. Lines that are no request (no JSON
object, or no whole-number ``request_id``) are set aside with their text, and cannot fail the job.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.score import score
from ..sources import registry as REG

BODY = "request_id bigint, features map<string,double>, _unread string"
JOURNAL = "model string, path string, features string"


def parse(lines: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """(requests, malformed lines) of a text column of JSON bodies ``{"request_id": 1, "features": {..}}``."""
    body = F.from_json(F.col(column), BODY, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_unread"})
    read = lines.select(F.col(column).alias("line"), body.alias("body"))
    fine = F.coalesce(F.col("body._unread").isNull() & F.col("body.request_id").isNotNull(), F.lit(False))
    requests = read.filter(fine).select(
        "body.request_id", F.coalesce("body.features", F.create_map().cast("map<string,double>")).alias("features"))
    return requests, read.filter(~fine).select("line")


def _pinned(spark: SparkSession, registry: str, journal: str, batch_id: int) -> dict:
    """The model of a batch: the journal's, or else the newest one, which the journal then names."""
    path = f"{journal}/batch={batch_id}"
    try:
        rows = spark.read.schema(JOURNAL).parquet(path).collect()       # one row
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = []
    if rows:
        return rows[0].asDict() | {"features": json.loads(rows[0]["features"])}
    info = REG.latest(spark, registry)
    (spark.createDataFrame([(info["model"], info["path"], json.dumps(info["features"]))], JOURNAL)
     .coalesce(1).write.mode("overwrite").parquet(path))
    return info


def handler(registry: str, sink: str, aside: str, journal: str) -> Callable[[DataFrame, int], None]:
    """What to do with a micro-batch of lines; may run again for the same number."""
    loaded: dict[str, PipelineModel] = {}

    def handle(lines: DataFrame, batch_id: int) -> None:
        spark = lines.sparkSession
        info = _pinned(spark, registry, journal, batch_id)
        if info["path"] not in loaded:
            loaded.clear()
            loaded[info["path"]] = REG.load(info["path"])
        requests, malformed = parse(lines)
        out = score(loaded[info["path"]], info["model"], requests, info["features"])
        out.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
        malformed.write.mode("overwrite").parquet(f"{aside}/batch={batch_id}")
    return handle


def start(spark: SparkSession, registry: str, source: str, sink: str, aside: str, journal: str, checkpoint: str,
          available_now: bool = True, processing_time: str = "10 seconds", files_per_batch: int | None = None):
    """The running query over text files of JSON lines under ``source``."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    writer = (reader.text(source).writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(handler(registry, sink, aside, journal)))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)).start()


def drain(spark: SparkSession, *folders: str, **options) -> None:
    """Answer everything that has arrived."""
    query = start(spark, *folders, **options)
    query.awaitTermination()
    if query.exception():
        raise RuntimeError(str(query.exception()))
