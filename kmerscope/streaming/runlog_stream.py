"""Run logs as a stream: benchmark output files are parsed as they land (Structured Streaming).

A benchmark sweep writes one output file per run over hours; instead of
re-globbing the folder, a file-source stream picks up each new file once
(exactly-once through the checkpoint) and appends its parsed timing row.
The parsing is the same ``runlogs.run_timing_all`` used in batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import runlogs as R


def run_files_stream(spark: SparkSession, runs_dir: str, glob: str = "*_benchmark_*cores.out",
                     max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming ``path, content`` of new run files under ``runs_dir``."""
    raw = (spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", glob)
           .option("maxFilesPerTrigger", max_files_per_trigger).load(runs_dir))
    return raw.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))


def start_run_timing(spark: SparkSession, runs_dir: str, out_path: str, checkpoint: str,
                     available_now: bool = True) -> StreamingQuery:
    """Append every usable run's timing (and every rejected file, flagged) to a Parquet table.

    ``checkpoint`` belongs to ``out_path``: every run on the same table must
    name the same folder, shared by the cluster, or its files are numbered anew
    and taken for batches that the table already has.
    """
    if not checkpoint:
        raise ValueError("a checkpoint folder that stays with out_path is required")
    parsed = R.run_timing_all(run_files_stream(spark, runs_dir))
    w = (parsed.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint)
         .outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
