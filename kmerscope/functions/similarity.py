"""Scalar similarity, length and band expressions (all JVM-side)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def jaccard_from_counts(inter, size_a, size_b) -> Column:
    """|A n B| / |A u B| from integer sizes, one division; 0.0 when nothing is shared.

    Computing from integers in a single division keeps the double bit-exact with
    any SQL engine (no ``1 - (1 - j)`` round trip).
    """
    i, a, b = _col(inter), _col(size_a), _col(size_b)
    return F.when(i == 0, F.lit(0.0)).otherwise(i / (a + b - i))


def jaccard(set_a, set_b) -> Column:
    """Jaccard similarity of two distinct-element arrays; 0.0 if either is empty or null."""
    a, b = _col(set_a), _col(set_b)
    inter = F.coalesce(F.size(F.array_intersect(a, b)), F.lit(0))
    return jaccard_from_counts(inter, F.coalesce(F.size(a), F.lit(0)), F.coalesce(F.size(b), F.lit(0)))


def length_diff_ratio(len_a, len_b) -> Column:
    """``|a - b| / greatest(a, b)``; null for two zero lengths instead of a divide error."""
    a, b = _col(len_a), _col(len_b)
    return F.try_divide(F.abs(a - b), F.greatest(a, b))


def length_ratio_ok(len_a, len_b, max_len_diff: float = 0.1) -> Column:
    """The reference's length filter: keep iff the difference is <= max_len_diff of the longer.

    Null (both lengths zero) does not pass.
    """
    return F.coalesce(length_diff_ratio(len_a, len_b) <= F.lit(max_len_diff), F.lit(False))


def length_bucket(length, width: int = 100) -> Column:
    """``floor(length / width)`` as bigint (the MinHash blocking key)."""
    return F.floor(_col(length) / F.lit(width)).cast("bigint")


def log_length_band(length, max_len_diff: float = 0.1) -> Column:
    """Band id such that any two lengths passing the length filter are in equal or adjacent bands.

    Band width in log space is ``-ln(1 - r)`` (widened by 1e-9 relative so that
    floating error on an exact boundary cannot push a passing pair two bands
    apart); the exact predicate is re-checked after the join.  Length 0 gets
    null: it never passes the filter.
    """
    if not 0 < max_len_diff < 1:
        raise ValueError("max_len_diff must be in (0, 1)")
    width = -math.log1p(-max_len_diff) * (1 + 1e-9)
    length = _col(length)
    return F.when(length > 0, F.floor(F.log(length.cast("double")) / F.lit(width))).cast("bigint")


def similarity_band(sim) -> Column:
    """Label: identical (=1), high (>=0.5), moderate (>=0.1), low (>0), none (=0)."""
    s = _col(sim)
    return (F.when(s >= 1.0, "identical").when(s >= 0.5, "high").when(s >= 0.1, "moderate")
            .when(s > 0.0, "low").otherwise("none"))
