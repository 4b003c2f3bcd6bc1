"""Batch logs kept as text files: few files however many logs, and the same logs read back."""

import os
from datetime import datetime

from pyspark.sql import functions as F

from kmerscope.plans import runlog_queries as Q
from kmerscope.sources.runlogs import read_logs, write_logs

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def _events(spark, path, users=120):
    kinds = ["click", "view", "odd\ttab", "two\nlines", "$1\\", None]
    rows = [(i, datetime(2024, 1, 1), (i * 7) % users, kinds[i % 6], 1.5, f'{{"k": {i % 20}}}') for i in range(3 * users)]
    spark.createDataFrame(rows, EVENTS).repartition(3).write.parquet(os.path.join(path, "events.parquet"))


def test_files_follow_the_bytes_not_the_logs(spark, tmp_path, monkeypatch):
    """120 users' logs once stood in as many folders; the tables parsed from the files are those of the lines."""
    _events(spark, str(tmp_path))
    root = str(tmp_path / "logs")
    monkeypatch.setattr(Q, "scratch_path", lambda *_: root)
    got = Q.QUERIES["run_config_files"](spark, str(tmp_path))
    files = [f for _, _, names in os.walk(root) for f in names if f.endswith(".txt")]
    assert 0 < len(files) <= 8
    expected = Q.R.run_config(Q._lines(spark, str(tmp_path))).collect()
    assert len(expected) > 100 and sorted(map(str, got.collect())) == sorted(map(str, expected))


def test_logs_come_back_line_by_line(spark, tmp_path):
    logs = {"a$1\\b": ["one", "", "tab\tin it", "two\nlines", "x\r\ny\rz", "ends\r"], "": ["no name"], "c": [None, "last"]}
    rows = [(k or None, i, x) for k, v in logs.items() for i, x in enumerate(v)]
    write_logs(spark.createDataFrame(rows, "log string, line_no long, line string"), str(tmp_path / "w"))
    got = {}
    for r in read_logs(spark, str(tmp_path / "w")).orderBy("path", "line_no").collect():
        got.setdefault(r.path, []).append(r.line)
    assert got == {"a$1\\b": ["one", "", "tab\tin it", "two", "lines", "x", "y", "z", "ends"], "": ["no name"], "c": ["", "last"]}


def test_logs_cut_by_splits(spark, tmp_path):
    lines = spark.range(4000).select((F.col("id") % 3).cast("string").alias("log"), F.col("id").alias("line_no"),
                                     F.concat(F.lit("line "), F.col("id").cast("string")).alias("line"))
    write_logs(lines, str(tmp_path / "w"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        df = read_logs(spark, str(tmp_path / "w"))
        assert df.select("path").distinct().count() == 3
        got = df.where("path = '1'").orderBy("line_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r.line for r in got] == [f"line {i}" for i in range(1, 4000, 3)]
