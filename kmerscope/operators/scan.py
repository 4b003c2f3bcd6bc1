"""Ordered scans (carry-forward, running count) that never put a whole partition in one task.

``last(x, ignorenulls) OVER (PARTITION BY p ORDER BY o)`` sorts each partition
key in a single task; one log file holding a third of all lines would then be
one task.  Here the order column is cut into fixed-size chunks:

1. within ``(p, chunk)`` the ordinary window runs (at most ``chunk`` rows);
2. per ``(p, chunk)`` one summary row (last non-null value / total) is made,
   and a window over those summaries (one row per chunk) gives each chunk what
   came before it;
3. the two are combined per row.

This is the textbook two-level parallel prefix scan, written as windows and a
join on the small chunk table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_CHUNK = 1 << 20


def _chunk(order_col: str, chunk: int) -> Column:
    return F.floor(F.col(order_col) / F.lit(chunk)).cast("bigint")


def carry_forward(df: DataFrame, part: list[str], order_col: str, value_col: str, out_col: str,
                  chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """``out_col`` = the last non-null ``value_col`` at or before each row, per ``part``."""
    d = df.withColumn("_chunk", _chunk(order_col, chunk))
    inner = Window.partitionBy(*part, "_chunk").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_within", F.last(value_col, ignorenulls=True).over(inner))
    summary = (d.groupBy(*part, "_chunk")
               .agg(F.max_by(F.col(value_col), F.when(F.col(value_col).isNotNull(), F.col(order_col)))
                    .alias("_last")))
    before = Window.partitionBy(*part).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn("_prev", F.last("_last", ignorenulls=True).over(before)).drop("_last")
    return (d.join(summary, part + ["_chunk"], "left")
            .withColumn(out_col, F.coalesce(F.col("_within"), F.col("_prev")))
            .drop("_chunk", "_within", "_prev"))


def running_sum(df: DataFrame, part: list[str], order_col: str, value_col: str, out_col: str,
                chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """``out_col`` = sum of ``value_col`` over rows at or before each row, per ``part``."""
    d = df.withColumn("_chunk", _chunk(order_col, chunk))
    inner = Window.partitionBy(*part, "_chunk").orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_within", F.sum(value_col).over(inner))
    summary = d.groupBy(*part, "_chunk").agg(F.sum(value_col).alias("_tot"))
    before = Window.partitionBy(*part).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn("_prev", F.coalesce(F.sum("_tot").over(before), F.lit(0))).drop("_tot")
    return (d.join(summary, part + ["_chunk"], "left")
            .withColumn(out_col, F.col("_prev") + F.col("_within"))
            .drop("_chunk", "_within", "_prev"))
