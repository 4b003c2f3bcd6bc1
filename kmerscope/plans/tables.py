"""Loading the driver tables and mapping them onto sequence collections.

``documents`` plays the sequence table: ``doc_id`` -> id, ``text`` -> sequence,
``source`` -> dataset.  Comparisons run across datasets over the whole table:
every document is compared with the documents of every other source, each
unordered pair once (the reference's "every protein of species A with every
protein of species B", for all species pairs at once).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import collection as C


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Session setting: spread ``documents`` over so many tasks.  For inputs stored in fewer splits than there are
#: cores (one small file); left unset, the scan's own splits are used and no text is shuffled.
SCAN_PARTITIONS = "spark.kmerscope.scanPartitions"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = spark.conf.get(SCAN_PARTITIONS, None)
    df = table(spark, sf_dir, "documents")
    return df.repartition(int(n)) if n else df


def doc_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as one collection compared across sources."""
    return C.across_datasets(documents(spark, sf_dir), "doc_id", "text", "source")


def doc_tokens(spark: SparkSession, sf_dir: str, k: int = 3) -> DataFrame:
    """Documents with their distinct 3-mers as packed codes."""
    return C.with_tokens(doc_items(spark, sf_dir), k)
