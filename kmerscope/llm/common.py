"""Shared pieces of the training-data operators: column picking, words, folds, samples, scratch tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

WHITESPACE = " \t\n\x0b\f\r"
SPLIT = r"[ \t\n\x0B\f\r]+"
WORD = r"[^\x20\x09-\x0D]+"


def quoted(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(name: str, taken: list[str]) -> str:
    """``name``, with underscores added until no column of ``taken`` has it."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; null and blank texts have none."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITESPACE))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPLIT))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where body uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % folds


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write to a fresh table in the cluster's shared scratch folder and read it back.

    Cuts the lineage: what reads the table survives the loss of executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@dataclass
class LabelledSample:
    """A bounded sample of labelled texts: ``text, label, weight, part`` (0 to 1), and the class counts."""
    rows: DataFrame
    counts: dict[int, int]

    @property
    def prior(self) -> float:
        n = sum(self.counts.values())
        return self.counts.get(1, 0) / n if n else 0.5

    @property
    def both_classes(self) -> bool:
        return min(self.counts.get(0, 0), self.counts.get(1, 0)) > 0


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, id_col: str, text_col: str,
                    per_class: int, max_bytes: int) -> LabelledSample:
    """Up to ``per_class`` labelled texts of each class, the first by a hash of their id.

    ``learn`` says by the label table's id which rows may be learned from.  A
    row labelled more than once counts once, with its largest label.  Texts
    over ``max_bytes`` are left out of the sample (never out of scoring), so
    it holds at most ``2 * per_class * max_bytes`` bytes.  ``weight`` restores
    the classes' shares among all rows that may be learned from.
    """
    y = quoted(label).cast("int")
    lab = (labels.where(learn & y.isin(0, 1) & quoted(id_col).isNotNull())
           .groupBy(quoted(id_col).alias("id")).agg(F.max(y).alias("label")))
    counts = {r["label"]: r["count"] for r in lab.groupBy("label").count().collect()}
    order = F.xxhash64(F.col("id"), F.lit(7))
    one = [lab.where(F.col("label") == k).orderBy(order, "id").limit(per_class) for k in (0, 1)]
    # At most 2 * per_class ids and labels.
    ids = F.broadcast(one[0].unionByName(one[1]))
    text = F.coalesce(quoted(text_col), F.lit(""))
    rows = (docs.where(F.octet_length(text) <= max_bytes)
            .select(quoted(id_col).alias("id"), text.alias("text")).join(ids, "id"))
    weight = F.lit(1.0)
    for k, n in counts.items():
        weight = F.when(F.col("label") == k, F.lit(n / min(n, per_class))).otherwise(weight)
    part = F.pmod(F.xxhash64(F.col("id"), F.lit(11)), F.lit(1000)) / F.lit(1000.0)
    return LabelledSample(rows.select("id", "text", "label", weight.alias("weight"), part.alias("part")), counts)
