"""FASTA as a Spark source and sink (S3).

Reading splits the text on the record delimiter ``\\n>`` with Spark's own text
source (``lineSep``), which also splits large files across tasks at record
boundaries; the first record keeps its leading ``>``.  The header's first word
is the name, the rest the description; the remaining lines are joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINE_WIDTH = 60


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """``name, description, sequence`` per record."""
    raw = spark.read.option("lineSep", "\n>").text(path)
    rec = F.regexp_replace(F.col("value"), r"^>", "")
    header = F.regexp_extract(rec, r"^([^\r\n]*)", 1)
    body = F.regexp_replace(F.regexp_replace(rec, r"^[^\n]*\n?", ""), r"[\r\n]", "")
    name = F.regexp_extract(header, r"^\s*(\S*)", 1)
    desc = F.trim(F.regexp_replace(header, r"^\s*\S*", ""))
    return (raw.where(F.trim(F.col("value")) != "")
            .select(name.alias("name"), desc.alias("description"), F.regexp_replace(body, r"\s+$", "")
                    .alias("sequence")))


def to_fasta_records(df: DataFrame, id_col: str = "name", seq_col: str = "sequence",
                     desc_col: str | None = None, width: int = LINE_WIDTH) -> DataFrame:
    """One text value per record: ``>name description`` and the sequence wrapped at ``width``."""
    header = F.concat(F.lit(">"), F.col(id_col).cast("string"))
    if desc_col:
        header = F.concat_ws(" ", header, F.col(desc_col))
    wrapped = F.regexp_replace(F.col(seq_col), f"(.{{{width}}})(?=.)", "$1\n")
    return df.select(F.concat(header, F.lit("\n"), wrapped).alias("value"))


def write_fasta(df: DataFrame, path: str, id_col: str = "name", seq_col: str = "sequence",
                desc_col: str | None = None, width: int = LINE_WIDTH) -> None:
    to_fasta_records(df, id_col, seq_col, desc_col, width).write.mode("overwrite").text(path)
