"""Scoring as a Structured Streaming job.

A file stream of requests -> the same ``score`` transform as batch ->
Parquet sink with a checkpoint. Stateless, so append mode and exactly-once
file output come from the checkpoint; ``availableNow`` drains what is there
and stops, a processing-time trigger keeps it running.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from ..operators.score import REQUEST_SCHEMA, score


def start(spark: SparkSession, model: PipelineModel, name: str, required: Sequence[str],
          source: str, sink: str, checkpoint: str, available_now: bool = True,
          processing_time: str | None = None, max_files_per_trigger: int | None = None):
    reader = spark.readStream.schema(REQUEST_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    requests = reader.parquet(source)
    out = score(model, name, requests, required)
    writer = (out.writeStream.format("parquet").outputMode("append")
                 .option("checkpointLocation", checkpoint).option("path", sink))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=processing_time or "10 seconds")
    return writer.start()


def run_available(spark: SparkSession, model: PipelineModel, name: str, required: Sequence[str],
                  source: str, sink: str, checkpoint: str, timeout_s: int | None = None) -> DataFrame:
    """Drain the source once and return the sink as a batch DataFrame.

    Without ``timeout_s`` it takes as long as the backlog needs.
    """
    q = start(spark, model, name, required, source, sink, checkpoint, available_now=True)
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"stream did not drain within {timeout_s} s")
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return spark.read.parquet(sink)
