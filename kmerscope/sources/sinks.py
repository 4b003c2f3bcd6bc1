"""Result sinks (S7-S13): Parquet, CSV top-k, partitioned sample batches, input snapshots, no-op runs.

A run is committed by one row appended to ``<root>/commits`` after everything
else is written.  Readers take committed runs only, so what a lost driver left
behind is never seen; a run of the same label writes over it.  A committed run
is not written again.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TS_FORMAT = "%Y%m%d_%H%M%S"
COMMIT = "ts string, method string, inputs array<string>"


def run_timestamp(ts: str | None = None) -> str:
    """A ``yyyyMMdd_HHmmss`` run label (given, e.g. the sample batch's, or now in UTC)."""
    return ts or datetime.now(timezone.utc).strftime(TS_FORMAT)


def output_layout(out_root: str, ts: str, method: str) -> dict:
    """``<root>/<ts>/<method>`` for results and ``<root>/<ts>/input_data`` for the inputs."""
    base = f"{out_root.rstrip('/')}/{ts}"
    return {"results": f"{base}/{method}/results.parquet", "top": f"{base}/{method}/top.csv",
            "inputs": f"{base}/input_data"}


def write_results(results: DataFrame, path: str) -> None:
    """All scored pairs as Parquet (overwrite)."""
    results.write.mode("overwrite").parquet(path)


def write_top_csv(top: DataFrame, path: str, cols: list[str]) -> None:
    """The top-k table, selected columns, CSV with header, one file (k rows)."""
    top.select(*cols).coalesce(1).write.mode("overwrite").csv(path, header=True)


def write_samples(samples: DataFrame, root: str, batch_ts: str, single_file: bool = False) -> None:
    """A sample batch under ``root/batch_ts=<ts>/dataset=<d>/`` (append keeps older batches)."""
    df = samples.withColumn("batch_ts", F.lit(batch_ts))
    if single_file:
        df = df.coalesce(1)
    df.write.mode("append").partitionBy("batch_ts", "dataset").parquet(root)


def snapshot_inputs(inputs: dict[str, DataFrame], path: str) -> None:
    """Copy the compared inputs next to the results, through Spark (any filesystem)."""
    for name, df in inputs.items():
        df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")


def committed_runs(spark: SparkSession, out_root: str) -> DataFrame:
    """``ts, method, inputs`` (names of the snapshots) of the runs under ``out_root`` that were written to the end."""
    try:
        return spark.read.schema(COMMIT).parquet(f"{out_root.rstrip('/')}/commits").distinct()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMIT)


def _commit_of(spark: SparkSession, out_root: str, ts: str, method: str):
    return committed_runs(spark, out_root).where((F.col("ts") == ts) & (F.col("method") == method)).first()


def write_run(results: DataFrame, top: DataFrame, top_cols: list[str], inputs: dict[str, DataFrame], out_root: str, ts: str,
              method: str) -> None:
    """Results, top table and input snapshots of one run (S7, S9, S11), and then its commit."""
    spark = results.sparkSession
    if _commit_of(spark, out_root, ts, method) is not None:
        raise FileExistsError(f"run {ts}/{method} under {out_root} is committed already")
    layout = output_layout(out_root, ts, method)
    write_results(results, layout["results"])
    write_top_csv(top, layout["top"], top_cols)
    snapshot_inputs(inputs, layout["inputs"])
    row = spark.createDataFrame([(ts, method, sorted(inputs))], COMMIT)
    row.coalesce(1).write.mode("append").parquet(f"{out_root.rstrip('/')}/commits")


def read_run(spark: SparkSession, out_root: str, ts: str, method: str) -> dict[str, DataFrame]:
    """``results``, ``top`` (strings, as CSV holds them) and the inputs by name of a committed run."""
    commit = _commit_of(spark, out_root, ts, method)
    if commit is None:
        raise FileNotFoundError(f"no committed run {ts}/{method} under {out_root}")
    layout = output_layout(out_root, ts, method)
    return {"results": spark.read.parquet(layout["results"]), "top": spark.read.option("header", True).csv(layout["top"]),
            **{name: spark.read.parquet(f"{layout['inputs']}/{name}") for name in commit["inputs"]}}


def write_set_pairs(pairs: DataFrame, members: DataFrame, path: str) -> None:
    """S7 without expanding: the pairs of sets and their members (``threshold.set_pair_table``) side by side."""
    pairs.write.mode("overwrite").parquet(f"{path.rstrip('/')}/pairs")
    members.write.mode("overwrite").parquet(f"{path.rstrip('/')}/members")


def run_noop(df: DataFrame) -> None:
    """Compute everything, write nothing (timing / dry runs)."""
    df.write.format("noop").mode("overwrite").save()
