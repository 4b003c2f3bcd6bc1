"""Skew-safe equi-join: hot keys are spread over a g x g grid of tasks.

For a key held by ``c`` rows, the pairs under that key are inherently
``O(c**2)`` work.  A plain shuffle join puts all of it in one task; when one
key holds a third of the table that task never ends.  Here each key gets a
grid size ``g = ceil(c / cell_rows)``: the "row" side of a pair picks its grid
row by a hash of its id and is copied to every grid column, the "column" side
does the converse, and the join key becomes ``(key, grid_row, grid_col)``.
Every pair meets in exactly one cell, each cell holds about ``cell_rows`` rows
per side whatever the key's size, and cold keys (g = 1) are not copied at all.
Callers collapse equal rows first, so that a key counts distinct ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_CELL_ROWS = 20000


def grid_size(count: Column, cell_rows: int = DEFAULT_CELL_ROWS) -> Column:
    """Grid side for a key held by ``count`` rows."""
    return F.greatest(F.lit(1), F.ceil(count / F.lit(cell_rows))).cast("int")


def grid_self_join(rows: DataFrame, cols: DataFrame, keys: list[str], grid_col: str,
                   row_id: list[str], col_id: list[str]) -> DataFrame:
    """Join ``rows`` to ``cols`` on ``keys``; both carry ``grid_col`` (same value for the same key).

    Column names of the two sides must already be disjoint apart from ``keys``
    and ``grid_col``.
    """
    g = F.col(grid_col)
    r = (rows.withColumn("_cell_r", F.pmod(F.xxhash64(*row_id), g).cast("int"))
         .withColumn("_cell_c", F.explode(F.sequence(F.lit(0), g - 1))))
    c = (cols.withColumn("_cell_c", F.pmod(F.xxhash64(*col_id), g).cast("int"))
         .withColumn("_cell_r", F.explode(F.sequence(F.lit(0), g - 1))).drop(grid_col))
    return r.join(c, keys + ["_cell_r", "_cell_c"]).drop("_cell_r", "_cell_c")


def prefixed(df: DataFrame, prefix: str, keep: list[str]) -> DataFrame:
    """Rename every column except ``keep`` to ``prefix + name``."""
    return df.select([F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns])
