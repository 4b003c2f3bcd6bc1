"""Reproducible sampling that stays distributed.

The reference draws N rows per dataset with ``rdd.takeSample(seed=42)``, which
ships the rows through the driver and whose result depends on the
partitioning.  Here a row's rank is a seeded hash of its id, so the sample is a
pure function of (data, n, seed): ``orderBy(key).limit(n)`` for one table
(each task keeps its best n, one task merges them) and ``row_number() <= n``
per dataset (Spark inserts a partial group limit before the shuffle, so a
dataset holding a third of all rows still sends only n rows per task).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sample_key(id_col: str, seed: int = 42) -> Column:
    """``md5(id || ':' || seed)``: a seeded, partition-independent rank (md5 exists in SQL engines too)."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


def check_sample_size(df: DataFrame, n: int, dataset_col: str | None = None) -> None:
    """Raise if ``n`` is not a positive integer or exceeds a dataset's row count.

    The reference prints this error and exits 0; here it is raised.  Only the
    offending datasets (at most a few rows) come back to the driver.
    """
    if not isinstance(n, int) or isinstance(n, bool) or n <= 0:
        raise ValueError(f"number of samples must be a positive integer, got {n!r}")
    if dataset_col is None:
        total = df.count()
        if n > total:
            raise ValueError(f"requested {n} samples but the table has {total} rows")
        return
    short = (df.groupBy(dataset_col).agg(F.count(F.lit(1)).alias("n_rows"))
             .where(F.col("n_rows") < n).limit(5).collect())
    if short:
        detail = ", ".join(f"{r[dataset_col]}={r['n_rows']}" for r in short)
        raise ValueError(f"requested {n} samples exceeds the rows of dataset(s): {detail}")


def sample_exact_n(df: DataFrame, n: int, id_col: str, seed: int = 42, check: bool = True) -> DataFrame:
    """Exactly n rows (all columns kept), chosen by the seeded hash of ``id_col``."""
    if check:
        check_sample_size(df, n)
    return df.orderBy(sample_key(id_col, seed), F.col(id_col)).limit(n)


def sample_status(df: DataFrame, n: int, dataset_col: str) -> DataFrame:
    """``dataset, n_rows, status`` for every dataset: ``ok``, or ``short`` when it has fewer than n rows."""
    return (df.groupBy(F.col(dataset_col).alias("dataset")).agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumn("status", F.when(F.col("n_rows") < n, "short").otherwise("ok")))


def sample_per_dataset(df: DataFrame, n: int, id_col: str, dataset_col: str, seed: int = 42,
                       check: bool = True, skip_short: bool = False) -> DataFrame:
    """n rows of every dataset in one job (replaces one job per dataset folder).

    ``skip_short`` leaves out the datasets that ``sample_status`` calls short;
    ``check`` raises for them.
    """
    if skip_short:
        short = sample_status(df, n, dataset_col).where(F.col("status") == "short").select(F.col("dataset").alias("_short"))
        df = df.join(short, F.col(dataset_col).eqNullSafe(F.col("_short")), "left_anti")
    elif check:
        check_sample_size(df, n, dataset_col)
    w = Window.partitionBy(dataset_col).orderBy(sample_key(id_col, seed), F.col(id_col))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def random_limit(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """The reference's ``orderBy(rand()).limit(n)``, seeded (O2).

    Depends on the partitioning; use ``sample_exact_n`` for a stable sample.
    """
    return df.orderBy(F.rand(seed)).limit(n)
