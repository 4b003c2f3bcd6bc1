"""Sampling and source/sink round-trip queries over ``documents``.

The round trips write through Spark into a fresh folder under the session's
shared checkpoint dir and read the result back, so they exercise the readers
on real layouts; the oracles compute the expected rows straight from the table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sampling import sample_exact_n, sample_per_dataset
from ..session import scratch_path
from ..sources.fasta import read_fasta, write_fasta
from ..sources.sequences import latest_batch, read_datasets
from ..sources.sinks import committed_runs, output_layout, read_run, write_results, write_run, write_samples
from .tables import documents

SAMPLE_N = 100
PER_DATASET_N = 10
TOP = 10
SEED = 42
BATCHES = ("20240101_000000", "20240102_000000")


def q_sample_exact_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_exact_n(documents(spark, sf_dir), SAMPLE_N, "doc_id", SEED)


def q_sample_per_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_per_dataset(documents(spark, sf_dir), PER_DATASET_N, "doc_id", "source", SEED)


def q_fasta_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as FASTA and back; residues cannot hold white space or '>', so texts travel as hex of their bytes."""
    d = documents(spark, sf_dir).select("doc_id", "source", F.hex(F.encode("text", "UTF-8")).alias("sequence"))
    path = scratch_path(spark, "fasta")
    write_fasta(d, path, id_col="doc_id", seq_col="sequence", desc_col="source")
    back = read_fasta(spark, path).withColumn("text", F.decode(F.unhex("sequence"), "UTF-8"))
    return back.select("name", F.col("description"), F.length("text").alias("length"), F.md5("text").alias("text_md5"))


def q_dataset_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "datasets")
    documents(spark, sf_dir).write.partitionBy("source").parquet(path)
    found = read_datasets(spark, path)
    return found.groupBy("dataset").agg(F.count(F.lit(1)).alias("n_rows"),
                                        F.sum(F.length("text")).alias("total_length"))


def q_latest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "samples")
    d = documents(spark, sf_dir).withColumnRenamed("source", "dataset")
    write_samples(sample_per_dataset(d, PER_DATASET_N // 2, "doc_id", "dataset", seed=7), root, BATCHES[0])
    write_samples(sample_per_dataset(d, PER_DATASET_N, "doc_id", "dataset", SEED), root, BATCHES[1])
    newest = latest_batch(spark.read.parquet(root))
    return newest.select("batch_ts", "dataset", "doc_id")


def q_committed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run written, committed and read back beside one that was given up half-way."""
    root, (ts, later) = scratch_path(spark, "runs"), BATCHES
    sizes = documents(spark, sf_dir).select("doc_id", "source", F.length("text").alias("length"))
    longest = sizes.orderBy(F.desc("length"), "doc_id").limit(TOP)
    write_run(sizes, longest, ["doc_id", "length"], {"documents": sizes.select("doc_id")}, root, ts, "lengths")
    write_results(sizes.limit(1), output_layout(root, later, "lengths")["results"])  # and nothing more
    parts = []
    for run in committed_runs(spark, root).orderBy("ts", "method").collect():  # the two of this query
        back = read_run(spark, root, run["ts"], run["method"])
        per = back["results"].groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("length").alias("total")).select(
            F.lit("results").alias("part"), F.col("source").alias("name"), "n_rows", "total")
        top = back["top"].select(F.lit("top").alias("part"), F.col("doc_id").alias("name"), F.lit(1).cast("long").alias("n_rows"),
                                 F.col("length").cast("long").alias("total"))
        inputs = back["documents"].agg(F.lit("inputs").alias("part"), F.lit(run["ts"]).alias("name"),
                                       F.count(F.lit(1)).alias("n_rows"), F.sum("doc_id").alias("total"))
        parts += [per, top, inputs]
    return reduce(DataFrame.unionByName, parts)


QUERIES = {
    "committed_run": q_committed_run,
    "sample_exact_n": q_sample_exact_n,
    "sample_per_dataset": q_sample_per_dataset,
    "fasta_roundtrip": q_fasta_roundtrip,
    "dataset_discovery": q_dataset_discovery,
    "latest_batch": q_latest_batch,
}

_KEY = f"md5(doc_id::VARCHAR || ':{SEED}')"
_PER = f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY {_KEY}, doc_id) AS rn FROM documents)
WHERE rn <= {PER_DATASET_N}"""

ORACLES = {
    "committed_run": f"""SELECT 'results' AS part, source AS name, count(*) AS n_rows, sum(length(text))::BIGINT AS total FROM documents GROUP BY source
UNION ALL SELECT * FROM (SELECT 'top', doc_id::VARCHAR, 1::BIGINT, length(text)::BIGINT FROM documents ORDER BY length(text) DESC, doc_id LIMIT {TOP})
UNION ALL SELECT 'inputs', '{BATCHES[0]}', count(*), sum(doc_id)::BIGINT FROM documents""",
    "sample_exact_n": f"SELECT * FROM documents ORDER BY {_KEY}, doc_id LIMIT {SAMPLE_N}",
    "sample_per_dataset": _PER,
    "fasta_roundtrip": """SELECT doc_id::VARCHAR AS name, source AS description, length(text)::INTEGER AS length, md5(text) AS text_md5
FROM documents""",
    "dataset_discovery": """SELECT 'source=' || source AS dataset, count(*) AS n_rows, sum(length(text))::BIGINT AS total_length
FROM documents GROUP BY source""",
    "latest_batch": f"SELECT '{BATCHES[1]}' AS batch_ts, source AS dataset, doc_id FROM ({_PER})",
}
