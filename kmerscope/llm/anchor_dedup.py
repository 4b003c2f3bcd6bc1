"""Substring dedup with difference-cover anchors.

A word is removed if it lies in a window of ``window`` consecutive words whose
sequence occurs at another place of the corpus too (another text, or elsewhere
in the same one).  Places in a text are taken modulo a period; of these only
the ones in a difference cover are anchors.  Whatever two places a repeated
window has, within the first ``period`` words of it there is a place that is an
anchor in both: so a hash of the ``window - period + 1`` words at each anchor is
enough to find every repeat.  Anchors whose hash occurs once end there; around
the others the match is extended to whole windows, whose own hashes then decide.

Two exchanges (see ``exchange``) carry 4 bytes for each anchor and 8 for each
window beside a repeated anchor; texts are shuffled once, by chunk.

Defined results: null, empty and short texts keep all they have; repeated rows
are separate texts, so all of a repeated row's windows are repeats; judged on
the input, not on what is left.  Window hashes are 64-bit: two different windows
are taken for one with a chance of 2**-64 a pair.
"""

from __future__ import annotations

from hashlib import sha256
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .cover import COVERS, sample_places, sample_size, windows_around
from .exchange import KEYS_SCHEMA, chunked, key_table, no_keys, repeated, told
from .texthash import Texts, Words, covered, word_windows, words

def _anchors(w: Words, window: int, period: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of anchors, the numbers of their texts, and their hashes."""
    at, text = sample_places(w.offsets, window, period)
    return at, text, word_windows(w.hashes, sample_size(window, period), at)


def _flags(hashes: np.ndarray, n_buckets: int, masks: pa.Table) -> np.ndarray:
    """Which of a chunk's keys occur elsewhere, in this chunk or another."""
    unique, back, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    return ((counts > 1) | told(unique, n_buckets, masks))[back]


def _suspects(w: Words, masks: pa.Table, window: int, period: int, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows that hold a repeated anchor, and their hashes."""
    at, text, hashes = _anchors(w, window, period)
    hit = _flags(hashes, n_buckets, masks)
    starts = windows_around(at[hit], text[hit], w.offsets, window, period)
    return starts, word_windows(w.hashes, window, starts)


def removed_words(docs: DataFrame, finish, schema, keep: list[str], window: int = 35, period: int = 21,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``finish(table, texts, words, removed)`` for every chunk, with a flag for each word: is it removed?

    ``table`` has the chunk's rows (chunk, text, row); ``finish`` gives a table of ``schema``.
    """
    sample_size(window, period)
    chunks = chunked(docs, id_col, text_col, keep)
    # About one word in six bytes; an anchor's key counts half, being of 4 bytes.
    n1 = chunks.buckets(len(COVERS[period]) / period / 12)
    n2 = chunks.buckets(1 / 24)
    rows = chunks.rows

    def send_anchors(table: pa.Table) -> pa.Table:
        hashes = _anchors(words(Texts.of(table["text"])), window, period)[2]
        return key_table(table["chunk"][0].as_py(), np.unique(hashes), n1, exact=False)

    anchor_masks = repeated(rows.groupBy("chunk").applyInArrow(send_anchors, KEYS_SCHEMA), exact=False)

    def send_windows(table: pa.Table, masks: pa.Table) -> pa.Table:
        if not len(table):
            return no_keys()
        hashes = _suspects(words(Texts.of(table["text"])), masks, window, period, n1)[1]
        return key_table(table["chunk"][0].as_py(), np.unique(hashes), n2, exact=True)

    window_masks = repeated(rows.groupBy("chunk").cogroup(anchor_masks.groupBy("chunk"))
                            .applyInArrow(send_windows, KEYS_SCHEMA), exact=True)
    # The buckets of the second exchange are told apart by being negative.
    masks = anchor_masks.unionByName(window_masks.selectExpr("chunk", "-1 - bucket AS bucket", "mask"))

    def decide(table: pa.Table, masks: pa.Table) -> pa.Table:
        texts = Texts.of(table["text"])
        w = words(texts)
        number = masks["bucket"].to_numpy()
        second = number < 0
        of_anchors = masks.filter(pa.array(~second))
        of_windows = masks.filter(pa.array(second))
        of_windows = of_windows.set_column(of_windows.schema.get_field_index("bucket"), "bucket",
                                           pa.array(-1 - number[second], pa.int32()))
        starts, hashes = _suspects(w, of_anchors, window, period, n1)
        removed = covered(starts[_flags(hashes, n2, of_windows)], window, len(w.hashes))
        return finish(table, texts, w, removed)

    return rows.groupBy("chunk").cogroup(masks.groupBy("chunk")).applyInArrow(decide, schema)


def digests(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_words, n_removed, kept_sha256`` (of the kept words, joined by one space) for every row."""
    kind = docs.schema[id_col].dataType

    def finish(table: pa.Table, texts: Texts, w: Words, removed: np.ndarray) -> pa.Table:
        gone = np.concatenate([[0], np.cumsum(removed)])
        return pa.table({
            "id": pc.struct_field(table["row"], [0]),
            "n_words": w.counts, "n_removed": gone[w.offsets[1:]] - gone[w.offsets[:-1]],
            "kept_sha256": [sha256(b" ".join(kept_words(texts, w, removed, i))).hexdigest() for i in range(len(texts))]})

    schema = f"id {kind.simpleString()}, n_words long, n_removed long, kept_sha256 string"
    return removed_words(docs, finish, schema, [id_col], window, id_col=id_col, text_col=text_col).withColumnRenamed("id", id_col)


def cut_repeats(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) with the removed words cut from the texts; texts that lose every word are left out.

    Null, empty and blank texts lose nothing and stay.
    """
    def finish(table: pa.Table, texts: Texts, w: Words, removed: np.ndarray) -> pa.Table:
        gone = np.concatenate([[0], np.cumsum(removed)])
        lost = gone[w.offsets[1:]] - gone[w.offsets[:-1]]
        stays = np.flatnonzero((lost == 0) | (lost < w.counts))
        cut = [kept_text(texts, w, removed, i) if lost[i] else None for i in stays]
        return pa.table({"row": table["row"].take(stays), "cut": pa.array(cut, pa.string())})

    row = T.StructType([docs.schema[c] for c in docs.columns])
    out = removed_words(docs, finish, T.StructType([T.StructField("row", row), T.StructField("cut", T.StringType())]),
                        docs.columns, window, id_col=id_col, text_col=text_col)
    text = F.coalesce(F.col("cut"), F.col("row")[text_col])
    return out.select(*[(text if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])


def kept_words(texts: Texts, w: Words, removed: np.ndarray, i: int) -> list[bytes]:
    """The words of text i that stay."""
    a, b = w.offsets[i], w.offsets[i + 1]
    every = texts.raw(i).split()  # bytes are split at exactly the white space that ``words`` knows
    return every if not removed[a:b].any() else list(compress(every, ~removed[a:b]))


def kept_text(texts: Texts, w: Words, removed: np.ndarray, i: int) -> str:
    """Text i without its removed words; what stays keeps its own white space."""
    a, b = w.offsets[i], w.offsets[i + 1]
    raw = texts.raw(i)
    if not removed[a:b].any():
        return raw.decode()
    out, at = [], 0
    for word, gone in zip(raw.split(), removed[a:b], strict=True):
        start = raw.index(word, at)
        end = start + len(word)
        if not gone:
            out.append(raw[at:end])
        elif out and not out[-1].endswith(b"\n") and b"\n" in raw[at:start]:
            out.append(b"\n")
        at = end
    return b"".join(out).strip().decode()
