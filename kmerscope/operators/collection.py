"""Sequence collections: the common shape every pair operator works on.

A collection is a DataFrame with

* ``_g``       ordering group; a pair (a, b) is emitted only when ``a._g < b._g``
* ``dataset``  the dataset (species, source) a row belongs to
* ``id``       row id, unique within its dataset
* ``seq``      the sequence / text
* ``length``   ``length(seq)`` in code points

Two collections compared left x right get ``_g`` = "0" / "1"; one table compared
across its own datasets (every row of one dataset with every row of each other
dataset, each unordered pair once) gets a ``_g`` that sorts as the dataset, nulls last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.kmers import MAX_CODE_K, with_kmers

KMERS_OF = "kmers_of"  # in a token column's metadata: the text that its codes are the k-mers of


def _require(df: DataFrame, cols: list[str]) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing column(s) {missing}; have {df.columns}")


def from_table(df: DataFrame, id_col: str = "name", seq_col: str = "sequence",
               dataset_col: str | None = None, dataset: str | None = None,
               group: str | None = None) -> DataFrame:
    """Project a table to a collection (column pruning reaches the Parquet scan)."""
    _require(df, [id_col, seq_col] + ([dataset_col] if dataset_col else []))
    ds = F.col(dataset_col).cast("string") if dataset_col else F.lit(dataset or "dataset")
    out = df.select(ds.alias("dataset"), F.col(id_col).alias("id"), F.col(seq_col).alias("seq"))
    # A null dataset is a dataset of its own, after all others ('-' sorts after '+').
    own = F.when(F.col("dataset").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col("dataset")))
    g = own if group is None else F.lit(group)
    return out.select(g.alias("_g"), "dataset", "id", "seq", F.length("seq").cast("int").alias("length"))


def two_sides(left: DataFrame, right: DataFrame, id_col: str = "name", seq_col: str = "sequence",
              left_name: str = "left", right_name: str = "right") -> DataFrame:
    """Left and right tables as one collection whose pairs are exactly left x right."""
    return from_table(left, id_col, seq_col, dataset=left_name, group="0").unionByName(
        from_table(right, id_col, seq_col, dataset=right_name, group="1"))


def across_datasets(df: DataFrame, id_col: str, seq_col: str, dataset_col: str) -> DataFrame:
    """One table compared across its datasets: pairs of rows from different datasets, each once."""
    return from_table(df, id_col, seq_col, dataset_col=dataset_col)


def with_tokens(items: DataFrame, k: int = 3, encoding: str = "code") -> DataFrame:
    """Add ``tokens`` (distinct k-mers; packed codes for k <= 3) and ``n_tokens``.

    Codes say in the column's metadata that they are the k-mers of ``seq``, for steps that read the text themselves.
    """
    enc = encoding if (encoding != "code" or k <= MAX_CODE_K) else "string"
    out = with_kmers(items, "seq", "tokens", k=k, distinct=True, encoding=enc)
    if enc == "code":
        out = out.withColumn("tokens", F.col("tokens").alias("tokens", metadata={KMERS_OF: "seq", "k": k}))
    return out.withColumn("n_tokens", F.size("tokens"))


def text_of(items: DataFrame, tokens: str = "tokens") -> tuple[str, int] | None:
    """The text column whose k-mer codes the tokens are, and k; None if that is not known."""
    told = items.schema[tokens].metadata or {}
    return (told[KMERS_OF], told["k"]) if told.get(KMERS_OF) in items.columns else None
