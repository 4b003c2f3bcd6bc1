"""The corpus pipeline: quality, near duplicates, repeated passages, benchmark leaks, and the mix of sources.

``STAGES`` lists (name, function); each function takes ``(spark, docs, sf_dir)``
and returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``.  All but the last return the columns of ``documents``, and the
last adds the number of the copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kmerscope.llm import anchor_dedup, decontaminate, jaccard_groups, mixing, quality_zstd
from kmerscope.llm.common import fold, materialise, quoted, table, words


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier scores 0.7 or more.

    Null and empty texts score 0 and go; repeated rows are judged alike, row by
    row; without labels of both classes all rows have the share of label 1 as
    their score; an empty table stays empty.
    """
    return quality_zstd.keep_good(docs, table(spark, sf_dir, "labels"), fold(quoted("doc_id"), 4) != 2)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 or more on five-word shingles.

    The one of least id stays, null ids counting as the largest; of repeated
    rows one stays (rows alike in id and text but not in other columns are not
    told apart: either may).  Texts without words are linked with nothing and
    all stay; an empty table stays empty.
    """
    return jaccard_groups.keep_one(docs, shingle=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the windows of 35 words that occur elsewhere too; texts that lose every word are left out.

    All places of a window are cut, so of two rows alike with 35 words or more
    neither stays; null and empty texts hold no window and stay as they are; an
    empty table stays empty.  ``n_chars`` is counted anew.
    """
    cut = anchor_dedup.cut_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item.

    Judged by row: a clean row stays even if it shares its id (or a null id)
    with one that goes; null and empty texts overlap nothing and stay; repeated
    rows stay or go together; without items or documents nothing goes.
    """
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"), by_row=True)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document once for each copy that its source's target takes, with the copy's number.

    A null source is a source of its own; null and empty texts have size 0 and
    expect copies as their source's others do; repeated rows are documents of
    their own; ties in size go by a hash of the id; an empty table stays empty.
    """
    return mixing.mixed(docs, F.size(words(quoted("text"))))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("source_mix", source_mix),
]

# Dictionary compression has no SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared scratch folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
