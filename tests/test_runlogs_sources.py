"""Run-log parsing, chunked scans, FASTA and dataset folders."""

import os
import tempfile

from pyspark.sql import Window
from pyspark.sql import functions as F

from kmerscope.operators import runlogs as R
from kmerscope.operators.scan import carry_forward, running_sum
from kmerscope.sources.fasta import read_fasta, write_fasta
from kmerscope.sources.runlogs import read_log_files, read_log_lines, to_lines
from kmerscope.sources.sequences import latest_batch, read_datasets

BATCH_LOG = """Benchmarking: jaccard analysis
=========================================
Running jaccard benchmark with 4 cores...
=========================================
Spark configuration for 4 cores:
  Partitions: 12
  Driver memory: 24576m
  Executor memory: 24576m
  Max result size: 12288m
✗ jaccard benchmark with 4 cores failed!
"""


def _write(d, name, text):
    p = os.path.join(d, name)
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


def test_run_timing_from_files(spark):
    d = tempfile.mkdtemp()
    _write(d, "jaccard_benchmark_4cores.out", "x\nreal\t1m2.500s\nuser\t3m0.000s\nsys\t0m7.500s\n")
    _write(d, "minhash_benchmark_8cores.out", "real\t0m2.000s\nuser\t0m1.000s\n")
    _write(d, "notes.out", "real\t0m1.000s\nuser\t0m1.000s\nsys\t0m1.000s\n")
    files = read_log_files(spark, d, "*.out")
    t = R.run_timing(files).collect()
    assert [(r.method, r.cores, r.real_time, r.user_time, r.sys_time) for r in t] == [
        ("jaccard", 4, 62.5, 180.0, 7.5)]
    s = R.run_summary(R.run_timing(files)).collect()[0]
    assert abs(s.cpu_efficiency - 300.0) < 1e-9
    assert R.run_timing_rejects(files).count() == 2


def test_batch_log_config_and_failures(spark):
    d = tempfile.mkdtemp()
    _write(d, "sweep-1.out", BATCH_LOG)
    lines = read_log_lines(spark, d)
    cfg = R.run_config(lines, chunk=3).collect()
    assert [(r.method, r.cores, r.partitions, r.driver_memory, r.executor_memory, r.max_result_size)
            for r in cfg] == [("jaccard", 4, 12, "24576m", "24576m", "12288m")]
    mb = R.run_config_mb(lines, chunk=2).collect()[0]
    assert (mb.cores, mb.partitions, mb.driver_memory_mb, mb.max_result_size_mb) == (4, 12, 24576, 12288)
    assert [(r.method, r.cores) for r in R.failed_runs(lines).collect()] == [("jaccard", 4)]


def test_chunked_scans_equal_plain_windows(spark):
    df = spark.range(0, 200).select(
        (F.col("id") % 3).alias("p"), F.col("id").alias("o"),
        F.when(F.col("id") % 7 == 0, F.col("id")).alias("v"), (F.col("id") % 2).alias("x"))
    w = Window.partitionBy("p").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    plain = df.select("p", "o", F.last("v", True).over(w).alias("c"), F.sum("x").over(w).alias("s"))
    got = running_sum(carry_forward(df, ["p"], "o", "v", "c", chunk=8), ["p"], "o", "x", "s", chunk=8)
    assert sorted(got.select("p", "o", "c", "s").collect()) == sorted(plain.collect())


def test_fasta_read_and_roundtrip(spark):
    d = tempfile.mkdtemp()
    p = _write(d, "in.fa", ">NP_1.1 prot one [Mus musculus]\nMKAL\nLIL\n>NP_2.1\nAAA\n")
    got = sorted((r.name, r.description, r.sequence) for r in read_fasta(spark, p).collect())
    assert got == [("NP_1.1", "prot one [Mus musculus]", "MKALLIL"), ("NP_2.1", "", "AAA")]
    df = spark.createDataFrame([("a", "X" * 130), ("b", "")], "name string, sequence string")
    out = os.path.join(tempfile.mkdtemp(), "fa")
    write_fasta(df, out)
    back = sorted((r.name, r.sequence) for r in read_fasta(spark, out).collect())
    assert back == [("a", "X" * 130), ("b", "")]


def test_dataset_folders_and_latest_batch(spark):
    root = tempfile.mkdtemp()
    df = spark.createDataFrame([("mouse", "m1", "MKA"), ("fish", "f1", "AAA")], "ds string, name string, sequence string")
    df.where("ds = 'mouse'").drop("ds").write.parquet(os.path.join(root, "mouse.adam"))
    df.where("ds = 'fish'").drop("ds").write.parquet(os.path.join(root, "fish.adam"))
    got = sorted((r.dataset, r.name) for r in read_datasets(spark, root).collect())
    assert got == [("fish.adam", "f1"), ("mouse.adam", "m1")]
    b = spark.createDataFrame([("20240101_000000", 1), ("20240102_000000", 2)], "batch_ts string, v int")
    assert [r.v for r in latest_batch(b).collect()] == [2]


def test_run_timing_stream(spark):
    from kmerscope.streaming.runlog_stream import start_run_timing

    d = tempfile.mkdtemp()
    _write(d, "jaccard_benchmark_2cores.out", "real\t0m10.000s\nuser\t0m15.000s\nsys\t0m1.000s\n")
    _write(d, "minhash_benchmark_2cores.out", "real\t0m20.000s\nuser\t0m30.000s\n")
    out = os.path.join(tempfile.mkdtemp(), "timing")
    q = start_run_timing(spark, d, out, checkpoint=os.path.join(tempfile.mkdtemp(), "ckpt"))
    q.awaitTermination(120)
    rows = spark.read.parquet(out).collect()
    assert sorted((r.method, r.reject_reason is None) for r in rows) == [("jaccard", True), ("minhash", False)]
