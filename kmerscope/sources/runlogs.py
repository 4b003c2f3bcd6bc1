"""Run-log files as DataFrames.

``read_log_files`` gives one row per file (``path, content``); run logs are
small (one run's console output), so a file is one row.  ``read_log_lines``
numbers the lines of each file (``path, line_no, line``) so that ordered
parsing works after the rows are spread over tasks.  ``write_logs`` and
``read_logs`` keep many small logs in few files, each line with its log's name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_log_files(spark: SparkSession, directory: str, glob: str = "*.out",
                   recursive: bool = False) -> DataFrame:
    """Files under ``directory`` whose name matches ``glob``: ``path, content``."""
    r = spark.read.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    df = r.text(directory, wholetext=True)  # the keyword: text() would reset an .option()
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))


def to_lines(files: DataFrame) -> DataFrame:
    """``path, content`` -> ``path, line_no, line`` (line_no from 0, ``\\r`` stripped)."""
    return files.select("path", F.posexplode(F.split("content", "\n")).alias("line_no", "line")).select(
        "path", F.col("line_no").cast("bigint").alias("line_no"), F.regexp_replace("line", "\r$", "").alias("line"))


def read_log_lines(spark: SparkSession, directory: str, glob: str = "*", recursive: bool = False) -> DataFrame:
    """``path, line_no, line`` by a splittable scan: a large log is read by many tasks.

    ``line_no`` ascends with the line's place in its file (the byte at which its
    split starts, plus its number in the split), it is not dense over splits.
    """
    r = spark.read.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    raw = r.text(directory).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("seen"), F.regexp_replace("value", "\r$", "").alias("line"))
    # A window holds one split's lines (spark.sql.files.maxPartitionBytes).
    nth = F.row_number().over(Window.partitionBy("path", "at").orderBy("seen"))
    return raw.select("path", (F.col("at") + nth - 1).cast("bigint").alias("line_no"), "line")


def write_logs(lines: DataFrame, directory: str) -> None:
    """``log, line_no, line`` as text files that hold whole logs in the order of their lines, ``log<TAB>line``.

    The number of files follows the bytes written, not the number of logs.  A
    null line is written empty, a null log has the name ``''``; names hold no
    tab and no line break.  A line with line breaks in it becomes several.
    """
    tag = F.concat(F.coalesce("log", F.lit("")), F.lit("\t"))
    named = F.regexp_replace("tag", r"([\\$])", r"\\$1")  # as it stands in a replacement
    # A carriage return that ends the line goes with the line's end.
    each = F.regexp_replace("line", F.lit(r"(\r\n|\n|\r(?!\z))"), F.concat(F.lit("$1"), named))
    tagged = lines.select("log", "line_no", tag.alias("tag"), F.coalesce("line", F.lit("")).alias("line"))
    dealt = tagged.repartition("log").sortWithinPartitions("log", "line_no")
    dealt.select(F.concat("tag", F.when(F.col("line").rlike(r"[\r\n]"), each).otherwise(F.col("line"))).alias("value")).write.text(directory)


def read_logs(spark: SparkSession, directory: str, glob: str = "*.txt") -> DataFrame:
    """``path, line_no, line`` of the logs that ``write_logs`` wrote; ``path`` is the log's name."""
    text = F.col("line")
    return read_log_lines(spark, directory, glob).select(
        F.substring_index(text, "\t", 1).alias("path"), "line_no",
        F.expr("substr(line, instr(line, '\t') + 1)").alias("line"))
