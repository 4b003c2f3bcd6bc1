"""Which of the corpus's many 64-bit keys occur more than once: chunks of texts ask, buckets of keys answer.

Texts are dealt into chunks of bounded size.  A chunk sends each of its distinct
keys once, packed by ranges of the key (buckets); a bucket task sorts what it
gets and answers each chunk with one bit for each key it sent.  However often a
key occurs, no task gets more than one copy of it from a chunk, and no list of
its places is ever gathered.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import quoted

CHUNK_BYTES = 4 << 20
BUCKET_KEYS = 2_000_000
KEYS_SCHEMA = "bucket int, chunk int, keys binary"
MASKS_SCHEMA = "chunk int, bucket int, mask binary"
_KEYS = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("keys", pa.binary())])
_MASKS = pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("mask", pa.binary())])


@dataclass
class Chunks:
    """``rows``: chunk, text, row (the columns kept); and the corpus's size."""
    rows: DataFrame
    n_chunks: int
    n_bytes: int

    def buckets(self, keys_per_byte: float) -> int:
        return max(1, math.ceil(self.n_bytes * keys_per_byte / BUCKET_KEYS))


def corpus_bytes(docs: DataFrame, text_col: str) -> int:
    return docs.agg(F.sum(F.octet_length(quoted(text_col)))).first()[0] or 0


def chunked(docs: DataFrame, id_col: str, text_col: str, keep: list[str], chunk_bytes: int = CHUNK_BYTES) -> Chunks:
    """Deal texts into chunks by a hash of id and text; ``keep`` names the columns that ``row`` holds."""
    n_bytes = corpus_bytes(docs, text_col)
    n = max(1, math.ceil(n_bytes / chunk_bytes))
    rows = docs.select(F.pmod(F.xxhash64(quoted(id_col), quoted(text_col)), F.lit(n)).cast("int").alias("chunk"),
                       quoted(text_col).alias("text"), packed(keep).alias("row"))
    return Chunks(rows, n, n_bytes)


def ordered_chunks(docs: DataFrame, id_col: str, text_col: str, keep: list[str],
                   chunk_bytes: int = CHUNK_BYTES, sample_rows: int = 200_000) -> Chunks:
    """Deal texts into chunks by their id: a smaller chunk number means smaller ids; null ids count as the largest.

    The bounds between chunks come from a sample of about ``sample_rows`` ids
    with their texts' sizes, as Spark's own range partitioning draws one.
    """
    share = min(1.0, sample_rows / max(1, docs.count()))
    size = F.coalesce(F.octet_length(quoted(text_col)), F.lit(0))
    drawn = docs.select(quoted(id_col).alias("id"), size.alias("n"))
    drawn = drawn if share == 1 else drawn.sample(share, seed=9)
    ids = sorted((r["id"], r["n"]) for r in drawn.where(F.col("id").isNotNull()).collect())
    n_bytes = int(sum(n for _, n in ids) / share)
    bounds, full = [], 0
    for i, n in ids:
        if full * (1 / share) > chunk_bytes and (not bounds or bounds[-1] < i):
            bounds.append(i)
            full = 0
        full += n
    shared = docs.sparkSession.sparkContext.broadcast(bounds)  # one id for each chunk

    @F.arrow_udf("int")
    def chunk_of(values: pa.Array) -> pa.Array:
        top = len(shared.value)
        if pa.types.is_integer(values.type):
            at = np.searchsorted(np.array(shared.value, np.int64), pc.fill_null(values, 0).to_numpy(zero_copy_only=False), side="right")
            return pc.if_else(values.is_null(), pa.scalar(top, pa.int32()), pa.array(at, pa.int32()))
        return pa.array([top if v is None else bisect_right(shared.value, v) for v in values.to_pylist()], pa.int32())

    rows = docs.select(chunk_of(quoted(id_col)).alias("chunk"), quoted(text_col).alias("text"), packed(keep).alias("row"))
    return Chunks(rows, len(bounds) + 1, n_bytes)


def packed(names: list[str]) -> Column:
    return F.struct(*[quoted(c).alias(c) for c in names])


def _scaled(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """Keys scaled to [0, n_buckets) with 32 bits of fraction; does not fall as the key grows."""
    n, low = np.uint64(n_buckets), keys & np.uint64(0xFFFFFFFF)
    return (keys >> np.uint64(32)) * n + (low * n >> np.uint64(32))


def bucket_of(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """A bucket for each key, not falling as the key grows."""
    return (_scaled(keys, n_buckets) >> np.uint64(32)).astype(np.int32)


def _ranges(unique: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that ascending keys fall in, and where in the keys each begins and the last ends."""
    b = bucket_of(unique, n_buckets)
    cut = np.flatnonzero(np.diff(b)) + 1
    return b[np.concatenate([[0], cut])] if len(b) else b, np.concatenate([[0], cut, [len(b)]])


def _packed(keys: np.ndarray) -> bytes:
    """Ascending keys as differences, byte by byte of equal weight: the high ones are small and compress."""
    steps = np.diff(keys, prepend=keys.dtype.type(0))
    return zstandard.compress(steps.view(np.uint8).reshape(-1, keys.itemsize).T.tobytes(), 1)


def _unpacked(raw: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(kind).ravel(), dtype=kind)


def key_table(chunk: int, unique: np.ndarray, n_buckets: int, exact: bool) -> pa.Table:
    """A chunk's distinct keys, ascending, for the buckets; 32 bits below the bucket's where a few false repeats do no harm."""
    buckets, cuts = _ranges(unique, n_buckets)
    sent = unique if exact else _scaled(unique, n_buckets).astype(np.uint32)
    return pa.table({"bucket": buckets, "chunk": np.full(len(buckets), chunk, np.int32),
                     "keys": [_packed(sent[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)][:len(buckets)]}, _KEYS)


def no_keys() -> pa.Table:
    return _KEYS.empty_table()


def repeated(keys: DataFrame, exact: bool, later_only: bool = False) -> DataFrame:
    """Answer each (chunk, bucket): a bit for each key sent, set if another chunk sent it too.

    ``later_only``: set only where a chunk of a smaller number sent it.
    Chunks for which no bit is set get no answer.
    """
    kind = np.uint64 if exact else np.uint32

    def answer(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        sent = [_unpacked(x, kind) for x in table["keys"].to_pylist()]
        cuts = np.cumsum([len(x) for x in sent])[:-1]
        every = np.concatenate(sent)
        order = np.argsort(every, kind="stable")
        same = every[order[1:]] == every[order[:-1]]
        again = np.zeros(len(every), bool)
        again[order[1:]] = same
        if not later_only:
            again[order[:-1]] |= same
        masks = np.split(again, cuts)
        told = np.flatnonzero([m.any() for m in masks])
        return pa.table({"chunk": table["chunk"].take(told), "bucket": table["bucket"].take(told),
                         "mask": [np.packbits(masks[i]).tobytes() for i in told]}, _MASKS)

    return keys.groupBy("bucket").applyInArrow(answer, MASKS_SCHEMA)


def told(unique: np.ndarray, n_buckets: int, masks: pa.Table) -> np.ndarray:
    """The answers to a chunk, put together: a bit for each of its distinct keys."""
    out = np.zeros(len(unique), bool)
    buckets, cuts = _ranges(unique, n_buckets)
    for b, mask in zip(masks["bucket"].to_pylist(), masks["mask"].to_pylist(), strict=True):
        i = int(np.searchsorted(buckets, b))
        n = cuts[i + 1] - cuts[i]
        out[cuts[i]:cuts[i + 1]] = np.unpackbits(np.frombuffer(mask, np.uint8), count=n).astype(bool)
    return out
