"""Sequence tables: Parquet datasets, dataset folders and sample batches."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEQUENCE_COLUMNS = ("name", "sequence")


def read_sequences(spark: SparkSession, path: str, id_col: str = "name", seq_col: str = "sequence") -> DataFrame:
    """A Parquet sequence dataset projected to ``name, sequence`` (only those columns are read)."""
    df = spark.read.parquet(path)
    missing = [c for c in (id_col, seq_col) if c not in df.columns]
    if missing:
        raise ValueError(f"{path}: missing column(s) {missing}; have {df.columns}")
    return df.select(F.col(id_col).alias("name"), F.col(seq_col).alias("sequence"))


def read_datasets(spark: SparkSession, root: str) -> DataFrame:
    """Every ``*.parquet`` file below ``root`` with ``dataset`` = its first-level folder name.

    Replaces one job per folder: one scan, the dataset derived from the file
    path.  Folders without Parquet files are skipped; datasets may have columns
    of their own (null in the others).  Files directly in ``root`` get the
    dataset ''.
    """
    df = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
          .option("mergeSchema", True).parquet(root))
    base = re.sub(r"^[A-Za-z][\w+.-]*:(//[^/]*(?=/))?", "", root.rstrip("/")) + "/"
    # File paths are URIs: decoded before they are compared ('+' stands for itself there).
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    rel = F.substr(path, F.locate(base, path) + F.lit(len(base)))
    ds = F.when(rel.contains("/"), F.regexp_extract(rel, r"^([^/]+)/", 1)).otherwise(F.lit(""))
    return df.withColumn("dataset", ds)


def latest_batch(samples: DataFrame, batch_col: str = "batch_ts") -> DataFrame:
    """Rows of the newest batch (``batch_ts`` strings ``yyyyMMdd_HHmmss`` sort by time).

    On a table partitioned by ``batch_ts`` the scalar subquery becomes a
    partition filter, so older batches are not read.
    """
    return samples.where(F.col(batch_col) == samples.select(F.max(batch_col)).scalar())


def pick_sides(samples: DataFrame, left: str, right: str, dataset_col: str = "dataset") -> tuple[DataFrame, DataFrame]:
    """The two datasets to compare, named explicitly (the reference took the first two found)."""
    have = {r[0] for r in samples.select(dataset_col).distinct().where(
        F.col(dataset_col).isin(left, right)).collect()}
    for d in (left, right):
        if d not in have:
            raise ValueError(f"dataset {d!r} not found")
    return samples.where(F.col(dataset_col) == left), samples.where(F.col(dataset_col) == right)
