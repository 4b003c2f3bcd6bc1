"""End-to-end jobs (C1-C6) on small on-disk fixtures."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from kmerscope.plans import jobs
from kmerscope.sources import sinks
from kmerscope.sources.runlogs import read_log_lines
from tests.test_pairs import _fixture, _kset


def _write_sets(spark, root):
    rows = _fixture(40)
    df = spark.createDataFrame([(f"p{i}", s, d) for d, i, s in rows], "name string, sequence string, ds string")
    df.where("ds = 'd0'").drop("ds").write.parquet(os.path.join(root, "mouse.adam"))
    df.where("ds = 'd1'").drop("ds").write.parquet(os.path.join(root, "fish.adam"))
    return os.path.join(root, "mouse.adam"), os.path.join(root, "fish.adam")


def test_exact_and_minhash_jobs(spark):
    root = tempfile.mkdtemp()
    left, right = _write_sets(spark, root)
    out = os.path.join(root, "out")
    res = jobs.exact_job(spark, left, right, out, run_ts="20240101_000000", threshold=0.5)
    top = res["top"].collect()
    assert len(top) == 10 and top == sorted(top, key=lambda r: (-r.jaccard, r.left_id, r.right_id))
    assert all(r.jaccard > 0.5 for r in res["results"].collect())
    assert os.path.isdir(os.path.join(out, "20240101_000000", "jaccard", "top.csv"))
    back = sinks.read_run(spark, out, "20240101_000000", "jaccard")
    assert back["results"].count() == res["results"].count() and back["left_sample"].count() == spark.read.parquet(left).count()
    lf = jobs.exact_job(spark, left, right, save=False, length_filter=True)["results"]
    assert lf.count() > 0
    mh = jobs.minhash_job(spark, left, right, save=False, length_filter=True)
    assert all(r.minhash_similarity > 0.9 for r in mh["results"].collect())
    cmp = jobs.method_comparison(res["results"].where("jaccard > 0.9"), mh["results"]).first()
    assert cmp.n_both <= min(cmp.n_exact, cmp.n_lsh)


def test_only_committed_runs_are_read(spark, monkeypatch):
    out, ts = os.path.join(tempfile.mkdtemp(), "out"), "20240101_000000"
    results = spark.range(20).withColumn("score", F.col("id") / 20)
    run = (results, results.limit(3), ["id", "score"], {"left": spark.range(5), "right": spark.range(7)}, out, ts, "exact")
    assert sinks.committed_runs(spark, out).count() == 0

    def lost(*_):
        raise RuntimeError("the driver is gone")

    with monkeypatch.context() as m:
        m.setattr(sinks, "snapshot_inputs", lost)
        with pytest.raises(RuntimeError):
            sinks.write_run(*run)
    with pytest.raises(FileNotFoundError):
        sinks.read_run(spark, out, ts, "exact")
    sinks.write_run(*run)
    back = sinks.read_run(spark, out, ts, "exact")
    assert sorted(map(tuple, back["results"].collect())) == sorted(map(tuple, results.collect()))
    assert [back[k].count() for k in ("top", "left", "right")] == [3, 5, 7]
    with pytest.raises(FileExistsError):
        sinks.write_run(*run)
    assert [(r.ts, r.method, r.inputs) for r in sinks.committed_runs(spark, out).collect()] == [(ts, "exact", ["left", "right"])]


def test_threshold_of_zero_is_every_shared_kmer(spark):
    left, right = _write_sets(spark, tempfile.mkdtemp())
    got = jobs.exact_job(spark, left, right, save=False, threshold=0)["results"].collect()
    sides = [[_kset(r.sequence) for r in spark.read.parquet(p).collect()] for p in (left, right)]
    assert len(got) == sum(bool(a & b) for a in sides[0] for b in sides[1])


def test_log_files_of_several_splits(spark):
    """Lines read by small splits are numbered in the order of their file."""
    d = tempfile.mkdtemp()
    lines = [f"line {i} é" for i in range(500)]
    with open(os.path.join(d, "a.out"), "w") as f:
        f.write("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        assert spark.read.text(d).rdd.getNumPartitions() > 4
        assert [r.line for r in read_log_lines(spark, d, "*.out").orderBy("line_no").collect()] == lines
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_sampling_and_fasta_jobs(spark):
    root = tempfile.mkdtemp()
    _write_sets(spark, os.path.join(root, "input"))
    s = jobs.sampling_job(spark, os.path.join(root, "input"), os.path.join(root, "samples"), n=5,
                          batch_ts="20240101_000000")
    assert sorted(r["count"] for r in s.groupBy("dataset").count().collect()) == [5, 5]
    p = os.path.join(root, "x.fa")
    with open(p, "w") as f:
        f.write(">a one\nMKAL\n>b\nAAA\n")
    assert jobs.fasta_import(spark, p, os.path.join(root, "fa.parquet")).count() == 2


def test_runlog_report(spark):
    d = tempfile.mkdtemp()
    for m, c, r in [("jaccard", 2, "0m4.000s"), ("minhash", 2, "0m2.000s")]:
        with open(os.path.join(d, f"{m}_benchmark_{c}cores.out"), "w") as f:
            f.write(f"real\t{r}\nuser\t0m4.000s\nsys\t0m1.000s\n")
    with open(os.path.join(d, "sweep-1.out"), "w") as f:
        f.write("Benchmarking: minhash analysis\n==========\nSpark configuration for 2 cores:\n"
                "  Partitions: 6\n✗ minhash benchmark with 2 cores failed!\n")
    out = jobs.runlog_report(spark, d, d, methods=["jaccard", "minhash"])
    sp = out["run_speedup"].first()
    assert (sp.faster_method, sp.speedup) == ("Minhash", 2.0)
    flags = {r.method: r.failed for r in out["timed_flags"].collect()}
    assert flags == {"jaccard": False, "minhash": True}
