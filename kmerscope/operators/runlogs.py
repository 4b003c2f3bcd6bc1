"""Run-log tables (L1-L9): benchmark run logs parsed into timing, config, failure tables.

Inputs are either whole files ``(path, content)`` (one run's output with its
``time`` lines) or line tables ``(path, line_no, line)`` (batch logs, where
state such as "current method" carries over from earlier lines).  Everything
is regexp / window / aggregate work on Spark; carried state uses the chunked
scans of ``scan.py`` so one huge log file never lands in one task.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scan import DEFAULT_CHUNK, carry_forward, running_sum

# The log formats the parsers must read.
RUN_FILE_NAME = r"^(\w+)_benchmark_(\d+)cores\.out$"
TIME_REAL = r"real\s+(\d+m[\d.]+)s"
TIME_USER = r"user\s+(\d+m[\d.]+)s"
TIME_SYS = r"sys\s+(\d+m[\d.]+)s"
BLOCK_SEPARATOR = r"={10,}"
BENCHMARKING = r"(?i)Benchmarking:\s*(\w+)"
SPARK_CONFIG = r"Spark configuration for (\d+) cores:"
PARTITIONS = r"Partitions:\s*(\d+)"
DRIVER_MEMORY = r"Driver memory:\s*([\w.]+)"
EXECUTOR_MEMORY = r"Executor memory:\s*([\w.]+)"
MAX_RESULT_SIZE = r"Max result size:\s*([\w.]+)"
LINE_SPARK_CONFIG = r"^Spark configuration for (\d+) cores:"
LINE_PARTITIONS = r"^\s*Partitions: (\d+)"
LINE_DRIVER_MB = r"^\s*Driver memory: (\d+)m"
LINE_EXECUTOR_MB = r"^\s*Executor memory: (\d+)m"
LINE_MAX_RESULT_MB = r"^\s*Max result size: (\d+)m"
LINE_FAILED = r"^✗ (\w+) benchmark with (\d+) cores failed!"


def _extract(col: Column, pattern: str, group: int) -> Column:
    """``regexp_extract`` that gives null instead of '' when the pattern is absent."""
    return F.when(col.rlike(pattern), F.regexp_extract(col, pattern, group))


def _seconds(printed: Column) -> Column:
    """``NmS.S`` -> ``N * 60 + S.S`` (null if malformed)."""
    return F.substring_index(printed, "m", 1).try_cast("bigint") * 60 + F.substring_index(printed, "m", -1).try_cast("double")


def duration_seconds(text: Column, pattern: str) -> Column:
    """``NmS.Ss`` captured by ``pattern`` -> ``N * 60 + S.S`` seconds (null if absent or malformed)."""
    return _seconds(F.regexp_extract(text, pattern, 1))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def run_timing_all(files: DataFrame) -> DataFrame:
    """Every file with what could be parsed and a ``reject_reason`` (null when usable)."""
    name = file_name(F.col("path"))
    c = F.col("content")
    times = {"real_time": TIME_REAL, "user_time": TIME_USER, "sys_time": TIME_SYS}
    found = files.select(
        _extract(name, RUN_FILE_NAME, 1).alias("method"),
        _extract(name, RUN_FILE_NAME, 2).try_cast("int").alias("cores"),
        *[F.regexp_extract(c, p, 1).alias("_" + t) for t, p in times.items()],
        name.alias("filename"), "path")
    out = found.select("method", "cores", *[_seconds(F.col("_" + t)).alias(t) for t in times],
                       F.concat_ws(" ", *["_" + t for t in times]).alias("_printed"), "filename", "path")
    missing = F.col("real_time").isNull() | F.col("user_time").isNull() | F.col("sys_time").isNull()
    garbled = F.lit(False)
    for k, t in enumerate(times):
        garbled = garbled | (F.col(t).isNull() & (F.split_part("_printed", F.lit(" "), F.lit(k + 1)) != ""))
    reason = (F.when(F.col("method").isNull() | F.col("cores").isNull(), "file name not <method>_benchmark_<n>cores.out")
              .when(garbled, "malformed real/user/sys time").when(missing, "missing real/user/sys time"))
    return out.withColumn("reject_reason", reason).drop("_printed")


def run_timing(files: DataFrame) -> DataFrame:
    """L1: ``method, cores, real_time, user_time, sys_time, filename`` per usable run file."""
    return run_timing_all(files).where(F.col("reject_reason").isNull()).drop("reject_reason", "path")


def run_timing_rejects(files: DataFrame) -> DataFrame:
    """Files dropped by L1, with the reason (the reference only prints a warning)."""
    return run_timing_all(files).where(F.col("reject_reason").isNotNull()).select("filename", "path",
                                                                                 "reject_reason")


def run_summary(timing: DataFrame) -> DataFrame:
    """Timings plus CPU efficiency ``(user + sys) / real * 100`` (null for a zero wall time)."""
    eff = F.try_divide(F.col("user_time") + F.col("sys_time"), F.col("real_time")) * 100
    return timing.select(F.upper("method").alias("method"), "cores", "real_time", "user_time", "sys_time",
                         eff.alias("cpu_efficiency"))


def run_pivot(timing: DataFrame, methods: list[str]) -> DataFrame:
    """Cores x method -> wall time, one column per method, named as the reference capitalises it.

    Several runs of one (cores, method) are all accounted for: ``<Method>`` is
    the fastest, ``<Method>_slowest`` the slowest and ``<Method>_runs`` their
    number.  ``other_runs`` counts runs of methods not listed.
    """
    def of(m: str):
        return F.when(F.col("method") == m, F.col("real_time"))

    each = [c for m in methods for c in (
        F.min(of(m)).alias(m.capitalize()), F.max(of(m)).alias(f"{m.capitalize()}_slowest"),
        F.count(of(m)).alias(f"{m.capitalize()}_runs"))]
    return timing.groupBy("cores").agg(*each, F.count_if(~F.col("method").isin(methods)).alias("other_runs"))


def by_method_and_cores(runs: DataFrame) -> DataFrame:
    """Any run table sorted by (method, cores), as the reference's reports are."""
    return runs.orderBy("method", "cores")


def run_speedup(timing: DataFrame, method_a: str, method_b: str) -> DataFrame:
    """Per core count with both methods: the faster one and by how much (``max(r, 1/r)``)."""
    t = timing.groupBy("cores").agg(
        F.min(F.when(F.col("method") == method_a, F.col("real_time"))).alias("_a"),
        F.min(F.when(F.col("method") == method_b, F.col("real_time"))).alias("_b"))
    ratio = F.col("_a") / F.col("_b")
    return (t.where(F.col("_a").isNotNull() & F.col("_b").isNotNull() & (F.col("_b") > 0) & (F.col("_a") > 0))
            .select("cores",
                    F.when(ratio < 1, F.lit(method_a.capitalize())).otherwise(F.lit(method_b.capitalize()))
                    .alias("faster_method"),
                    F.greatest(ratio, 1 / ratio).alias("speedup")))


def _with_blocks(lines: DataFrame, chunk: int) -> DataFrame:
    """Add ``block``: number of separator lines at or before each line of its file."""
    d = lines.withColumn("_sep", F.col("line").rlike(BLOCK_SEPARATOR).cast("int"))
    return running_sum(d, ["path"], "line_no", "_sep", "block", chunk).drop("_sep")


def run_config(lines: DataFrame, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """L2: ``method, cores, partitions, driver_memory, executor_memory, max_result_size``.

    The log is cut into blocks at separator lines.  A block's first
    ``Benchmarking: <m>`` line (anywhere in it) sets the current method, which
    carries over to later blocks; a block with ``Spark configuration for <n>
    cores:`` gives one row, values missing from it are null, and a block
    before any method is dropped.
    """
    b = _with_blocks(lines, chunk)
    line = F.col("line")

    def first(pattern: str) -> Column:
        v = _extract(line, pattern, 1)
        return F.min_by(v, F.when(v.isNotNull(), F.col("line_no")))

    blocks = b.groupBy("path", "block").agg(
        F.min_by(F.lower(_extract(line, BENCHMARKING, 1)),
                 F.when(line.rlike(BENCHMARKING), F.col("line_no"))).alias("_method_here"),
        first(SPARK_CONFIG).try_cast("int").alias("cores"),
        first(PARTITIONS).try_cast("int").alias("partitions"),
        first(DRIVER_MEMORY).alias("driver_memory"),
        first(EXECUTOR_MEMORY).alias("executor_memory"),
        first(MAX_RESULT_SIZE).alias("max_result_size"))
    blocks = carry_forward(blocks, ["path"], "block", "_method_here", "method", chunk)
    return (blocks.where(F.col("cores").isNotNull() & F.col("method").isNotNull())
            .select("method", "cores", "partitions", "driver_memory", "executor_memory", "max_result_size"))


def run_config_mb(lines: DataFrame, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """L3: per log file and core count, the settings in MB; the last configuration block wins.

    A ``Spark configuration for <n> cores:`` line starts a fresh record for n
    (earlier values for n are discarded); following setting lines fill it.
    """
    line = F.col("line")
    d = lines.withColumn("_hdr", F.when(line.rlike(LINE_SPARK_CONFIG), F.col("line_no")))
    d = carry_forward(d, ["path"], "line_no", "_hdr", "_start", chunk)
    d = d.where(F.col("_start").isNotNull())
    hdr = (d.where(F.col("line_no") == F.col("_start"))
           .select("path", "_start", _extract(line, LINE_SPARK_CONFIG, 1).try_cast("int").alias("cores")))

    def last(pattern: str) -> Column:
        v = _extract(line, pattern, 1).try_cast("int")
        return F.max_by(v, F.when(v.isNotNull(), F.col("line_no")))

    rec = d.groupBy("path", "_start").agg(
        last(LINE_PARTITIONS).alias("partitions"), last(LINE_DRIVER_MB).alias("driver_memory_mb"),
        last(LINE_EXECUTOR_MB).alias("executor_memory_mb"), last(LINE_MAX_RESULT_MB).alias("max_result_size_mb"))
    rec = rec.join(hdr, ["path", "_start"])
    latest = rec.groupBy("path", "cores").agg(F.max_by(
        F.struct("partitions", "driver_memory_mb", "executor_memory_mb", "max_result_size_mb"),
        F.col("_start")).alias("r"))
    return latest.select("path", "cores", "r.*")


def failed_runs(lines: DataFrame) -> DataFrame:
    """L4: distinct ``(method, cores)`` of ``✗ <m> benchmark with <n> cores failed!`` lines."""
    line = F.col("line")
    return (lines.where(line.rlike(LINE_FAILED))
            .select(F.lower(F.regexp_extract(line, LINE_FAILED, 1)).alias("method"),
                    F.regexp_extract(line, LINE_FAILED, 2).try_cast("int").alias("cores"))
            .where(F.col("cores").isNotNull()).distinct())


def timed_flags(timing: DataFrame, failed: DataFrame) -> DataFrame:
    """Every timed run with ``failed`` = its (method, cores) is in the failure list."""
    f = failed.select("method", "cores", F.lit(True).alias("_f"))
    return (timing.join(f, ["method", "cores"], "left")
            .withColumn("failed", F.coalesce(F.col("_f"), F.lit(False))).drop("_f"))


# Fixed value: the heading printed before the top-10 table.
TOP10_HEADING = "Top 10 most similar protein pairs:"


def scraped_top10(files: DataFrame) -> DataFrame:
    """The rows of the ASCII table printed after the top-10 heading of each run output.

    ``path, filename, row_no, left_id, right_id, score`` and the run's
    ``real_time, user_time, sys_time``: the table's three cells, ids as text
    and the score as double (null if malformed).  Only lines with ``|`` are
    rows, up to the first line after the table that is neither a row nor a
    border; the header line is skipped; ``row_no`` counts a file's rows from 1.
    """
    content = F.col("content")
    after = F.regexp_extract(content, "(?s)" + re.escape(TOP10_HEADING) + r"[ \t]*\r?\n(.*)$", 1)
    table = F.regexp_extract(after, r"^((?:[ \t]*(?:[+|][^\n]*)?\r?(?:\n|$))*)", 1)
    times = [duration_seconds(content, p).alias(n) for n, p in
             (("real_time", TIME_REAL), ("user_time", TIME_USER), ("sys_time", TIME_SYS))]
    # A table is ten lines and its borders: it stays one array per file.
    rows = files.select("path", *times, F.filter(F.split(table, "\n"), lambda x: F.trim(x).startswith("|")).alias("lines"))
    cells = F.transform("lines", lambda x: F.transform(F.split(F.btrim(x, F.lit("| \t\r")), r"\|"), lambda c: F.trim(c)))
    is_header = F.exists(F.get("cells", F.lit(0)), lambda x: ~x.rlike(r"^[-+0-9.eE]*$") & x.rlike(r"[A-Za-z_]{2,}")
                         ) & F.get(F.get("cells", F.lit(0)), F.lit(2)).try_cast("double").isNull()
    data = rows.withColumn("cells", cells).select("path", "real_time", "user_time", "sys_time", F.posexplode(
        F.when(is_header, F.slice("cells", F.lit(2), F.greatest(F.size("cells"), F.lit(1)))).otherwise(F.col("cells"))).alias("pos", "c"))
    return data.where(F.size("c") >= 3).select(
        "path", file_name(F.col("path")).alias("filename"), (F.col("pos") + 1).alias("row_no"), F.col("c")[0].alias("left_id"),
        F.col("c")[1].alias("right_id"), F.col("c")[2].try_cast("double").alias("score"), "real_time", "user_time", "sys_time")
