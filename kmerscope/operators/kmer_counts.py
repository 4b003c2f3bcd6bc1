"""Counts of k-mers and of hashed features, row by row in Arrow batches.

Each text is read once: its code points are packed into k-mer codes, sorted and
counted as numbers.  Built-in lambdas over arrays evaluate one element at a time
and cost some twenty times as much.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import MERSENNE_31, POLY_BASE
from ..functions.kmers import CODE_BITS, MAX_CODE_K

# Python workers get these functions with the task, so executors need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


SLICE_CODES = 1 << 20  # k-mers that are counted at once


def kmer_codes(text: str | None, k: int) -> np.ndarray:
    """The k-mers of a text, in order, as packed codes."""
    points = np.frombuffer((text or "").encode("utf-32-le"), np.uint32).astype(np.int64)
    if len(points) < k:
        return points[:0]
    out = points[:len(points) - k + 1].copy()
    for j in range(1, k):
        out = (out << CODE_BITS) + points[j:len(points) - k + 1 + j]
    return out


def feature_ids(codes: np.ndarray, k: int, num_features: int) -> np.ndarray:
    """``hashing.feature_id`` of packed k-mers."""
    mask = (1 << CODE_BITS) - 1
    h = (codes >> (CODE_BITS * (k - 1))) & mask
    for j in range(1, k):
        h = (h * POLY_BASE + ((codes >> (CODE_BITS * (k - 1 - j))) & mask)) % MERSENNE_31
    return h % MERSENNE_31 % num_features


def _spelled(codes: np.ndarray, k: int) -> list[str]:
    points = np.stack([(codes >> (CODE_BITS * (k - 1 - j))) & ((1 << CODE_BITS) - 1) for j in range(k)], axis=1)
    whole = points.astype("<u4").tobytes().decode("utf-32-le")
    return [whole[i:i + k] for i in range(0, len(whole), k)]


def vocabulary(items: DataFrame, k: int = 3, seq_col: str = "seq") -> DataFrame:
    """``kmer, doc_freq, occurrences`` over whole texts: rows that hold a k-mer, and how often it stands in all.

    Each batch sends its distinct k-mers once; the aggregate over the vocabulary adds them up.
    """
    if not 1 <= k <= MAX_CODE_K:
        raise ValueError(f"packed k-mers need 1 <= k <= {MAX_CODE_K}, got {k}")

    def count(batches):
        for batch in batches:
            per = [np.unique(kmer_codes(s, k), return_counts=True) for s in batch.column(0).to_pylist()]
            if not per:
                continue
            codes, back = np.unique(np.concatenate([c for c, _ in per]), return_inverse=True)
            held = np.bincount(back, minlength=len(codes)).astype(np.int64)
            n = np.bincount(back, weights=np.concatenate([n for _, n in per]), minlength=len(codes)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(_spelled(codes, k), pa.string()), pa.array(held), pa.array(n)], names=["kmer", "d", "n"])

    rows = items.select(seq_col).mapInArrow(count, "kmer string, d bigint, n bigint")
    return rows.groupBy("kmer").agg(F.sum("d").alias("doc_freq"), F.sum("n").alias("occurrences"))


def feature_counts(items: DataFrame, keep: list[str], k: int, num_features: int) -> DataFrame:
    """``keep, feature, tf`` for each hashed feature (see ``hashing.feature_id``) of a row's k-mers.

    These are its ``kmers``, a bag of packed codes, or without such a column those of its text ``seq``.
    """
    if not 1 <= k <= MAX_CODE_K:
        raise ValueError(f"packed k-mers need 1 <= k <= {MAX_CODE_K}, got {k}")
    told = "kmers" in items.columns
    schema = ", ".join(f"`{c}` {items.schema[c].dataType.simpleString()}" for c in keep) + ", feature bigint, tf bigint"

    def slices(batch):
        """The batch's rows from ``a`` to ``b`` with their codes, as many at once as are worth ``SLICE_CODES``."""
        column = batch.column("of")
        own, a, held = [], 0, 0
        for b, x in enumerate(column, 1):
            codes = np.zeros(0, np.int64) if not x.is_valid else x.values.to_numpy(zero_copy_only=False) if told else kmer_codes(x.as_py(), k)
            own.append(codes)
            held += len(codes)
            if held >= SLICE_CODES or b == len(column):
                yield a, own
                own, a, held = [], b, 0

    def count(batches):
        for batch in batches:
            for a, own in slices(batch):
                feature = feature_ids(np.concatenate(own), k, num_features)
                # Row and feature as one number: sorted and counted at once.
                row = np.repeat(np.arange(len(own)), [len(c) for c in own])
                both, n = np.unique(row * num_features + feature, return_counts=True)
                rows = pa.array(both // num_features)
                part = batch.slice(a, len(own))
                out = [part.column(c).take(rows) for c in keep]
                yield pa.RecordBatch.from_arrays([*out, pa.array(both % num_features), pa.array(n.astype(np.int64))], names=[*keep, "feature", "tf"])

    return items.select(*keep, F.col("kmers" if told else "seq").alias("of")).mapInArrow(count, schema)
