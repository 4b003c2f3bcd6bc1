"""Connected components of an edge table by repeated hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .counted import written


def components(edges: DataFrame) -> DataFrame:
    """``a, b`` (long) -> ``node, label``: every node of an edge with the smallest node it can reach.

    Each round a node takes the smallest label among its neighbours, and the
    label of its label; rounds end when no label changes.  A hub's edges are
    aggregated before they are shuffled.  Each round's labels are written to the
    shared scratch folder, so lineage stays short.
    """
    e = edges.where(F.col("a") != F.col("b"))
    both = written(e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = (both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("n")).agg(F.min("label").alias("seen")))
        hooked = labels.join(near, F.col("node") == F.col("n")).select(
            "node", F.least("label", "seen").alias("label"), F.col("label").alias("was"))
        up = labels.select(F.col("node").alias("p"), F.col("label").alias("above"))
        after = written(hooked.join(up, F.col("label") == F.col("p")).select(
            "node", F.least("label", "above").alias("label"), "was"), "labels")
        labels = after.select("node", "label")
        if not after.where(F.col("label") != F.col("was")).limit(1).count():
            return labels
