"""End-to-end jobs (C1-C6): what the reference's scripts do, as parameterised Spark jobs.

Every job returns its result DataFrames; ``save=False`` is the reference's
``--no-save`` / ``--dry-run`` mode (compute, write nothing).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import collection as C
from ..operators import runlogs as R
from ..operators.lsh import minhash_join
from ..operators.sampling import random_limit, sample_per_dataset
from ..operators.threshold import threshold_join
from ..operators.topk import ANY, top_k_pairs
from ..sources import sinks
from ..sources.fasta import read_fasta
from ..sources.runlogs import read_log_files, read_log_lines
from ..sources.sequences import read_datasets, read_sequences

DEFAULT_THRESHOLD = 0.5


def sampling_job(spark: SparkSession, input_root: str, out_root: str, n: int = 100, seed: int = 42,
                 batch_ts: str | None = None, save: bool = True) -> DataFrame:
    """N rows of every dataset folder under ``input_root``, as one new batch under ``out_root``.

    A dataset of fewer than n rows is left out, as the reference fails it
    alone; ``sampling.sample_status`` lists every dataset with its fate.
    """
    df = read_datasets(spark, input_root)
    id_col = "name" if "name" in df.columns else df.columns[0]
    sample = sample_per_dataset(df, n, id_col, "dataset", seed, skip_short=True)
    if save:
        sinks.write_samples(sample, out_root, sinks.run_timestamp(batch_ts))
    return sample


def exact_job(spark: SparkSession, left_path: str, right_path: str, out_root: str | None = None,
              run_ts: str | None = None, save: bool = True, limit_n: int | None = None,
              length_filter: bool = False, max_len_diff: float = 0.1, threshold: float | None = None,
              top_n: int = 10, seed: int = 42) -> dict[str, DataFrame]:
    """Exact k-mer Jaccard between two sequence datasets.

    ``results`` are all pairs of similarity ``threshold`` (0.5) or more, within
    the length filter if asked for; a threshold of 0 means all pairs that share
    a k-mer.  The top ``top_n`` is always exact.  ``limit_n`` is the
    reference's ``--limit-100`` (seeded).  What is saved counts once committed
    (see ``sinks``).
    """
    left, right = read_sequences(spark, left_path), read_sequences(spark, right_path)
    if limit_n:
        left, right = random_limit(left, limit_n, seed), random_limit(right, limit_n, seed)
    items = C.with_tokens(C.two_sides(left, right))
    t = DEFAULT_THRESHOLD if threshold is None else threshold or ANY
    diff = max_len_diff if length_filter else None
    out = {"results": threshold_join(items, t, strict=False, max_len_diff=diff), "top": top_k_pairs(items, top_n, max_len_diff=diff)}
    if save and out_root:
        sinks.write_run(out["results"], out["top"], ["left_id", "right_id", "jaccard"], {"left_sample": left, "right_sample": right},
                        out_root, sinks.run_timestamp(run_ts), "jaccard")
    return out


def minhash_job(spark: SparkSession, left_path: str, right_path: str, out_root: str | None = None,
                run_ts: str | None = None, save: bool = True, length_filter: bool = False,
                max_len_diff: float = 0.1, max_dist: float = 0.1, num_bands: int = 12, rows_per_band: int = 1,
                bucket_width: int = 100, neighbours: int = 1, top_n: int = 10) -> dict[str, DataFrame]:
    """MinHash LSH join per length bucket, optional length filter, top ``top_n``.

    Adjacent buckets meet too (``neighbours``); with 0 the pairs across a
    bucket's border are missed, as in the reference.
    """
    left, right = read_sequences(spark, left_path), read_sequences(spark, right_path)
    items = C.with_tokens(C.two_sides(left, right))
    res = minhash_join(items, max_dist, num_bands, rows_per_band, bucket_width, neighbours,
                       max_len_diff if length_filter else None)
    top = res.orderBy(F.desc("minhash_similarity"), "left_id", "right_id").limit(top_n)
    if save and out_root:
        sinks.write_run(res, top, ["left_id", "right_id", "minhash_similarity"], {"left_sample": left, "right_sample": right},
                        out_root, sinks.run_timestamp(run_ts), "minhash")
    return {"results": res, "top": top}


def runlog_report(spark: SparkSession, runs_dir: str, batch_log_dir: str | None = None,
                  methods: list[str] | None = None, out_dir: str | None = None,
                  batch_log_glob: str = "*") -> dict[str, DataFrame]:
    """C4: timing, summary, top-10, pivot, speed-up, configuration and failure tables from run logs."""
    files = read_log_files(spark, runs_dir, "*_benchmark_*cores.out")
    timing = R.run_timing(files)
    out = {"run_timing": R.by_method_and_cores(timing), "run_summary": R.by_method_and_cores(R.run_summary(timing)),
           "rejects": R.run_timing_rejects(files), "scraped_top10": R.scraped_top10(files)}
    if methods:
        out["run_pivot"] = R.run_pivot(timing, methods)
        if len(methods) == 2:
            out["run_speedup"] = R.run_speedup(timing, *methods)
    if batch_log_dir:
        lines = read_log_lines(spark, batch_log_dir, batch_log_glob)
        failed = R.failed_runs(lines)
        out.update({"run_config": R.by_method_and_cores(R.run_config(lines)), "run_config_mb": R.run_config_mb(lines),
                    "failed_runs": failed, "timed_flags": R.timed_flags(timing, failed)})
    if out_dir:
        for name, df in out.items():
            df.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/{name}")
    return out


def fasta_import(spark: SparkSession, fasta_path: str, out_path: str | None = None) -> DataFrame:
    """FASTA -> Parquet sequence table (``name, description, sequence``)."""
    df = read_fasta(spark, fasta_path)
    if out_path:
        df.write.mode("overwrite").parquet(out_path)
    return df


def method_comparison(exact: DataFrame, lsh: DataFrame) -> DataFrame:
    """How many exact pairs the LSH result recovers (and how many it adds)."""
    key = ["left_dataset", "left_id", "right_dataset", "right_id"]
    j = exact.select(*key, F.lit(True).alias("e")).join(lsh.select(*key, F.lit(True).alias("l")), key, "full_outer")
    return j.agg(F.count_if(F.col("e").isNotNull()).alias("n_exact"), F.count_if(F.col("l").isNotNull()).alias("n_lsh"),
                 F.count_if(F.col("e").isNotNull() & F.col("l").isNotNull()).alias("n_both"))

