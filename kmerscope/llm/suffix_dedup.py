"""Suffix-array dedup: bytes that repeat an earlier stretch of the corpus, by blockwise suffix sorting.

A byte is removed if a string of ``window`` bytes that also starts earlier (in a
text of a smaller id, or further left in the same text) covers it.  That is a
question about neighbours in the suffix array of the corpus: suffixes with their
first ``window`` bytes in common stand together, and all but the earliest are
repeats.  The array is made in blocks, so that no task holds more of it than one:

1. Cover sample.  Of each text, the suffixes at places in a difference cover are
   sampled and ranked by their first ``window - period + 1`` bytes.  For the ties
   that matter a rank need only say whether any other sample equals it.
2. Suffix blocks.  Suffixes whose samples within the next ``period`` bytes are all
   without an equal cannot tie with another over ``window`` bytes, whatever their
   order: they never enter a block.  The others are dealt into blocks by a
   64-bit fingerprint of their first ``window`` bytes and each block is sorted by
   itself.  (The order of unequal suffixes has no bearing on the result; the
   fingerprint's order stands in for that of the bytes.)
3. Each text's chunk learns which of its suffixes have an earlier equal.

Chunks hold texts of consecutive ids, so "earlier" is a smaller chunk number and
blocks carry no places.  Whole copies of an earlier text are found by their
text's hash first and take no part in the rest.

Defined results: null, empty and short texts keep all they have; a null id counts
as larger than any other; rows of one id are ordered by their text, and of two
equal rows one is the later; chances of a wrong match are 2**-64 a pair.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cover import COVERS, sample_places, sample_size, windows_around
from .exchange import KEYS_SCHEMA, key_table, no_keys, ordered_chunks, repeated, told
from .texthash import Texts, byte_windows, covered

WHOLE, SAMPLES, SUFFIXES = range(3)


class _Chunk:
    """One chunk of texts in order, and what the exchanges have told it so far."""

    def __init__(self, table: pa.Table, masks: pa.Table | None, window: int, period: int, n_buckets: tuple[int, int, int]):
        order = pc.sort_indices(pa.table({"id": pc.struct_field(table["row"], [0]), "text": table["text"]}),
                                sort_keys=[("id", "ascending"), ("text", "ascending")])
        self.table = table.take(order)
        self.number = table["chunk"][0].as_py()
        self.texts = Texts.of(self.table["text"])
        self.masks, self.window, self.period, self.n_buckets = masks, window, period, n_buckets

    def answers(self, kind: int, unique: np.ndarray) -> np.ndarray:
        return told(unique, self.n_buckets[kind], self.masks.filter(pc.equal(self.masks["kind"], kind)))

    def whole_keys(self) -> np.ndarray:
        return self.table["whole"].to_numpy().view(np.uint64)

    def copies(self) -> np.ndarray:
        """Texts with an earlier equal."""
        unique, first, back = np.unique(self.whole_keys(), return_index=True, return_inverse=True)
        later = self.answers(WHOLE, unique)[back]
        later |= first[back] != np.arange(len(back))
        return later

    def samples(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the cover samples of texts that are no copies, the numbers of their texts, and their hashes."""
        at, text = sample_places(self.texts.offsets, self.window, self.period)
        own = ~self.copies()[text]
        at, text = at[own], text[own]
        return at, text, byte_windows(self.texts.data, sample_size(self.window, self.period), at)

    def suffixes(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the suffixes that may have an equal, and fingerprints of their first ``window`` bytes."""
        at, text, hashes = self.samples()
        unique, back, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        tied = ((counts > 1) | self.answers(SAMPLES, unique))[back]
        starts = windows_around(at[tied], text[tied], self.texts.offsets, self.window, self.period)
        return starts, byte_windows(self.texts.data, self.window, starts)

    def removed(self) -> np.ndarray:
        """A flag for each byte."""
        starts, prints = self.suffixes()
        unique, first, back = np.unique(prints, return_index=True, return_inverse=True)
        later = self.answers(SUFFIXES, unique)[back] | (first[back] != np.arange(len(back)))
        out = covered(starts[later], self.window, len(self.texts.data))
        for i in np.flatnonzero(self.copies() & (np.diff(self.texts.offsets) >= self.window)):
            out[self.texts.offsets[i]:self.texts.offsets[i + 1]] = True
        return out


def removed_bytes(docs: DataFrame, finish, schema, keep: list[str], window: int = 100, period: int = 57,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``finish(table, texts, removed)`` for every chunk, with a flag for each byte: is it removed?

    ``table`` has the chunk's rows (chunk, text, row, whole) in order, ``row``
    the id and the columns of ``keep``; ``finish`` gives a table of ``schema``.
    """
    keep = [id_col, *(c for c in keep if c != id_col)]
    chunks = ordered_chunks(docs, id_col, text_col, keep)
    n = (chunks.buckets(1 / 1000), chunks.buckets(len(COVERS[period]) / period / 2), chunks.buckets(1 / 10))
    rows = chunks.rows.withColumn("whole", F.xxhash64("text"))
    setting = (window, period, n)

    def of_kind(masks: DataFrame, kind: int) -> DataFrame:
        return masks.withColumn("kind", F.lit(kind))

    def send_whole(table: pa.Table) -> pa.Table:
        keys = table["whole"].to_numpy().view(np.uint64)
        return key_table(table["chunk"][0].as_py(), np.unique(keys), n[WHOLE], exact=True)

    def send_samples(table: pa.Table, masks: pa.Table) -> pa.Table:
        if not len(table):
            return no_keys()
        c = _Chunk(table, masks, *setting)
        return key_table(c.number, np.unique(c.samples()[2]), n[SAMPLES], exact=False)

    def send_suffixes(table: pa.Table, masks: pa.Table) -> pa.Table:
        if not len(table):
            return no_keys()
        c = _Chunk(table, masks, *setting)
        return key_table(c.number, np.unique(c.suffixes()[1]), n[SUFFIXES], exact=True)

    def decide(table: pa.Table, masks: pa.Table) -> pa.Table:
        c = _Chunk(table, masks, *setting)
        return finish(c.table, c.texts, c.removed())

    groups = rows.groupBy("chunk")
    whole = rows.select("chunk", "whole").groupBy("chunk").applyInArrow(send_whole, KEYS_SCHEMA)
    masks = of_kind(repeated(whole, exact=True, later_only=True), WHOLE)
    samples = groups.cogroup(masks.groupBy("chunk")).applyInArrow(send_samples, KEYS_SCHEMA)
    masks = masks.unionByName(of_kind(repeated(samples, exact=False), SAMPLES))
    suffixes = groups.cogroup(masks.groupBy("chunk")).applyInArrow(send_suffixes, KEYS_SCHEMA)
    masks = masks.unionByName(of_kind(repeated(suffixes, exact=True, later_only=True), SUFFIXES))
    return groups.cogroup(masks.groupBy("chunk")).applyInArrow(decide, schema)


def _spans(removed: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of removed bytes; a run ends with its text."""
    inner = offsets[1:-1]
    start, end = removed.copy(), removed.copy()
    start[1:] &= ~removed[:-1]
    end[:-1] &= ~removed[1:]
    inner = inner[inner < len(removed)]
    start[inner] = removed[inner]
    inner = inner[inner > 0]
    end[inner - 1] = removed[inner - 1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def kept(docs: DataFrame, window: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, kept`` (the bytes that stay) and ``spans`` (removed runs, as start and end in bytes) for every row."""
    def finish(table: pa.Table, texts: Texts, removed: np.ndarray) -> pa.Table:
        starts, ends = _spans(removed, texts.offsets)
        cut = np.searchsorted(starts, texts.offsets)
        spans = [[{"start": int(a - o), "end": int(b - o)} for a, b in zip(starts[i:j], ends[i:j], strict=True)]
                 for i, j, o in zip(cut[:-1], cut[1:], texts.offsets[:-1], strict=True)]
        return pa.table({
            "id": pc.struct_field(table["row"], [0]),
            "kept": [texts.data[a:b][~removed[a:b]].tobytes() for a, b in zip(texts.offsets[:-1], texts.offsets[1:], strict=True)],
            "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))})

    schema = f"id {docs.schema[id_col].dataType.simpleString()}, kept binary, spans array<struct<start:long,end:long>>"
    return removed_bytes(docs, finish, schema, [], window, id_col=id_col, text_col=text_col).withColumnRenamed("id", id_col)


def digests(docs: DataFrame, window: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_bytes, n_removed, n_spans, kept_sha256`` for every row."""
    def finish(table: pa.Table, texts: Texts, removed: np.ndarray) -> pa.Table:
        gone = np.concatenate([[0], np.cumsum(removed)])
        starts = _spans(removed, texts.offsets)[0]
        o = texts.offsets
        return pa.table({
            "id": pc.struct_field(table["row"], [0]),
            "n_bytes": np.diff(o), "n_removed": gone[o[1:]] - gone[o[:-1]],
            "n_spans": np.diff(np.searchsorted(starts, o)),
            "kept_sha256": [sha256(texts.data[a:b][~removed[a:b]].tobytes()).hexdigest() for a, b in zip(o[:-1], o[1:], strict=True)]})

    schema = f"id {docs.schema[id_col].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return removed_bytes(docs, finish, schema, [], window, id_col=id_col, text_col=text_col).withColumnRenamed("id", id_col)
