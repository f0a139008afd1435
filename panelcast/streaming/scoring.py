"""Continuous delivery of the request-scoring operator with Structured Streaming.

Request files (CSV, declared schema) arriving in a folder are scored by the same
plan as the batch ``score_requests``: built-in feature expressions, the fitted
pipeline's ``transform`` (row-wise), and a stream-static join with the per-entity
history. The query keeps no state, so it needs no watermark; progress is kept in
the checkpoint location (shared storage on a cluster).
"""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..operators import scoring as sc
from ..session import checkpoint_dir


def request_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 100) -> DataFrame:
    return (spark.readStream.schema(sc.REQUEST_SCHEMA).option("header", True)
            .option("maxFilesPerTrigger", max_files_per_trigger).csv(path))


def start_scoring(spark: SparkSession, requests_path: str, panel: DataFrame, model,
                  output_path: str, sink: str = "parquet", query_name: str = "scored_requests",
                  checkpoint: str | None = None):
    """Start the streaming query into files below ``output_path`` (a file sink is
    exactly-once and keeps nothing in the driver); returns the StreamingQuery handle."""
    scored = sc.score_requests(request_stream(spark, requests_path), panel, model)
    ckpt = checkpoint or os.path.join(checkpoint_dir(spark), f"stream-{query_name}")
    return (scored.writeStream.outputMode("append").queryName(query_name).format(sink)
            .option("checkpointLocation", ckpt).option("path", output_path).start())
