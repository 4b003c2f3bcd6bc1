"""Inputs as they come: malformed logs, odd folders, differing schemas, repeated stream runs."""

import os

import pytest
from pyspark.sql import functions as F

from kmerscope.functions.kmers import with_kmers
from kmerscope.operators import collection as C
from kmerscope.operators import runlogs as R
from kmerscope.operators.lsh import minhash_join, minhash_ml_join
from kmerscope.operators.sampling import sample_per_dataset, sample_status
from kmerscope.plans import registry
from kmerscope.sources.fasta import read_fasta
from kmerscope.sources.runlogs import read_log_lines
from kmerscope.sources.sequences import latest_batch, read_datasets
from kmerscope.streaming.runlog_stream import start_run_timing


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)


def _run(real="1m2.500s"):
    return f"output\n\nreal\t{real}\nuser\t3m0.000s\nsys\t0m7.500s\n"


def test_stream_sees_every_file_once(spark, tmp_path):
    runs, out, ckpt = (str(tmp_path / d) for d in ("runs", "out", "ckpt"))

    def sweep():
        start_run_timing(spark, runs, out, ckpt).awaitTermination(60)
        return sorted(r.cores for r in spark.read.parquet(out).collect())

    _write(f"{runs}/a_benchmark_1cores.out", _run())
    assert sweep() == [1]
    _write(f"{runs}/a_benchmark_2cores.out", _run())
    _write(f"{runs}/a_benchmark_4cores.out", _run())
    assert sweep() == [1, 2, 4] and sweep() == [1, 2, 4]
    with pytest.raises(ValueError, match="checkpoint"):
        start_run_timing(spark, runs, out, "")


def test_malformed_times_are_rejected_alone(spark):
    files = spark.createDataFrame([
        ("x/a_benchmark_1cores.out", _run()), ("x/a_benchmark_2cores.out", _run("1m2.3.4s")),
        ("x/a_benchmark_99999999999cores.out", _run()), ("x/b_benchmark_1cores.out", "real\t0m1.0s\n")], "path string, content string")
    assert [r.cores for r in R.run_timing(files).collect()] == [1]
    why = {r.filename: r.reject_reason for r in R.run_timing_rejects(files).collect()}
    assert why["a_benchmark_2cores.out"].startswith("malformed") and why["b_benchmark_1cores.out"].startswith("missing")
    assert why["a_benchmark_99999999999cores.out"].startswith("file name")


def test_first_header_of_a_block_counts(spark):
    lines = ["=" * 12, "Benchmarking: one analysis", "Benchmarking: two analysis", "Spark configuration for 4 cores:", "  Partitions: 99999999999"]
    df = spark.createDataFrame([("log", i, x) for i, x in enumerate(lines)], "path string, line_no long, line string")
    got = R.run_config(df).collect()
    assert [(r.method, r.cores, r.partitions) for r in got] == [("one", 4, None)]


def test_scraped_tables_end_where_they_end(spark):
    table = R.TOP10_HEADING + "\n+--+--+---+\n|mouse_id|fish_id|jaccard|\n+--+--+---+\n|a|b|0.5|\n|c|d|x|\n+--+--+---+\n"
    bare = R.TOP10_HEADING + "\n|a|b|0.25|\n"
    files = spark.createDataFrame([
        ("one/r.out", table + "\nTotal time 12 | not a row\n" + _run()), ("two/r.out", table + "[Stage 3:>  (0 + 1) / 1]\n"),
        ("three/r.out", bare), ("four/r.out", "no table"), ("five/r.out", R.TOP10_HEADING + "\n")], "path string, content string")
    rows = R.scraped_top10(files).orderBy("path", "row_no").collect()
    assert [(r.path, r.row_no, r.left_id, r.score) for r in rows] == [
        ("one/r.out", 1, "a", 0.5), ("one/r.out", 2, "c", None), ("three/r.out", 1, "a", 0.25),
        ("two/r.out", 1, "a", 0.5), ("two/r.out", 2, "c", None)]
    assert rows[0].real_time == 62.5 and rows[3].real_time is None


def test_log_lines_by_split(spark, tmp_path):
    text = "".join(f"line {i}\r\n" for i in range(5000))
    _write(str(tmp_path / "logs" / "big.log"), text)
    _write(str(tmp_path / "logs" / "small.log"), "a\nb\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df = read_log_lines(spark, str(tmp_path / "logs"))
        assert spark.read.text(str(tmp_path / "logs")).rdd.getNumPartitions() > 2
        got = df.where(F.col("path").endswith("big.log")).orderBy("line_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r.line for r in got] == [f"line {i}" for i in range(5000)]
    assert len({r.line_no for r in got}) == 5000


def test_datasets_of_odd_folders(spark, tmp_path):
    root = str(tmp_path / "my data+100%")
    spark.createDataFrame([("p", "AAA", 1)], "name string, sequence string, extra int").write.parquet(f"{root}/mouse one")
    spark.createDataFrame([("q", "CCC", "x")], "name string, sequence string, note string").write.parquet(f"{root}/fish")
    _write(f"{root}/notes/readme.txt", "no Parquet here")
    rows = {r["name"]: r for r in read_datasets(spark, root).collect()}
    assert {n: r["dataset"] for n, r in rows.items()} == {"p": "mouse one", "q": "fish"}
    assert rows["p"]["extra"] == 1 and rows["p"]["note"] is None and rows["q"]["note"] == "x"


def test_latest_batch_prunes(spark, tmp_path):
    path = str(tmp_path / "samples")
    spark.createDataFrame([(1, "20250101_000000"), (2, "20250102_000000")], "id int, batch_ts string").write.partitionBy("batch_ts").parquet(path)
    df = latest_batch(spark.read.parquet(path))
    assert [r.id for r in df.collect()] == [2]
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = [x for x in plan.split("PartitionFilters: [")[1:] if "batch_ts" in x.split("]")[0]]
    assert any("= Subquery" in x.split("]")[0] or "= ReusedSubquery" in x.split("]")[0] or "scalar-subquery" in x.split("]")[0] for x in filters), filters


def test_short_dataset_is_skipped_alone(spark):
    df = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 9)] + [(None, i) for i in range(3)], "d string, id long")
    assert {(r.dataset, r.status) for r in sample_status(df, 3, "d").collect()} == {("a", "ok"), ("b", "short"), (None, "ok")}
    got = sample_per_dataset(df, 3, "id", "d", skip_short=True).groupBy("d").count().collect()
    assert {(r.d, r["count"]) for r in got} == {("a", 3), (None, 3)}


def test_fasta_with_carriage_returns(spark, tmp_path):
    _write(str(tmp_path / "x.fasta"), ">p1 one two\r\nACD\r\nEFG\r\n>p2\r\nKLM\r\n")
    got = {r.name: (r.description, r.sequence) for r in read_fasta(spark, str(tmp_path / "x.fasta")).collect()}
    assert got == {"p1": ("one two", "ACDEFG"), "p2": ("", "KLM")}


def test_ml_path_agrees_with_the_native_join(spark):
    rows = [(i, "".join("ACDEFGHIKL"[(i // 2 * 7 + j * j) % 10] for j in range(40)), f"d{i % 2}") for i in range(30)]
    df = spark.createDataFrame(rows, "i long, t string, d string")
    key = ["left_id", "right_id"]
    items = C.across_datasets(df, "i", "t", "d")
    ml = minhash_ml_join(with_kmers(items, "seq", "kmers", 3, distinct=False, encoding="string"))
    native = minhash_join(C.with_tokens(items))
    assert {tuple(r) for r in ml.select(*key).collect()} == {tuple(r) for r in native.select(*key).collect()}
    with pytest.raises(ValueError, match="k <= 3"):
        minhash_join(C.with_tokens(items, 4), k=4)


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())
