"""Best-fit packing of tokenised documents, planned over the histogram of their lengths.

Documents become pieces of at most ``capacity`` tokens (only longer documents
are cut).  A histogram says how many pieces have each length; best-fit
decreasing runs over these counts: sequences that are filled alike are one
class with a count, so a step places all pieces of a length that go to one
class.  The plan's size is bounded by the capacity, not by the number of
documents (see ``plan``).  Each piece then takes its planned slot: it is joined
with the plan on its length and its rank among the pieces of that length.

Texts are tokenised once, in the task that reads them; ranks come from counts
per (task, length) and need no sort of the pieces, so a length that holds a
third of all pieces is no group of its own anywhere.

Defined results: a null text is an empty one, a single end token; repeated rows
and equal ids are documents of their own; an empty table gives no pieces; other
columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, quoted

CAPACITY = 1024
END = 2
UNIT_CHARS = 64            # words up to this size go through the fast loop
BATCH_BYTES = 8 << 20

_UNIT = re.compile(r"(?<=\S)(?= )|(?<=\s)(?= \S)")


class Encoder:
    """Token ids of whole texts by a byte-level BPE tokenizer of ``tokenizers``, given as its definition.

    Such a tokenizer first splits a text so that a blank before a letter, digit
    or mark begins a new word, and so does a blank behind any of them; words
    are encoded on their own.  So a batch is cut at such blanks and each of its
    different words encoded once.  Texts with runs of white space are cut more
    carefully, texts with a special token in them are encoded whole.

    If the definition is the plain byte-level one whose merges stand in the
    order of their ids, short words go through tiktoken's merge loop over the
    same vocabulary, which gives the same ids in a fraction of the time.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.merge, self.sizes = _merge_loop(json.loads(definition), self.special)

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _unit(self, unit: str) -> np.ndarray:
        if self.merge is None or len(unit) > UNIT_CHARS:
            return self._whole(unit)
        return np.array(self.merge(unit), "<u4")

    def _words(self, words: pa.Array, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of words, each with a blank before it, in a row, where each begins and how many it has.

        ``blank`` says which are empty or have white space at an end.
       """
        apart = blank | (pc.utf8_length(words).to_numpy() > UNIT_CHARS) | (self.merge is None)
        row = words.filter(pa.array(~apart))
        # One call for all of them: the tokens' bytes are the text's bytes, so sizes tell where a word ends.
        every = pa.ListArray.from_arrays(pa.array([0, len(row)], pa.int32()), row)
        text = pc.binary_join(every, pa.scalar(" ", pa.large_string()))[0].as_py()
        ids = np.array(self.merge(" " + text) if len(row) else [], "<u4")
        ends = np.cumsum(pc.binary_length(row).to_numpy().astype(np.int64) + 1)
        cuts = np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1 if len(row) else np.empty(0, np.int64)
        alone = [self._unit(" " + w) for w in words.filter(pa.array(apart)).to_pylist()]
        size, begin = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        size[~apart] = np.diff(cuts, prepend=0)
        size[apart] = [len(x) for x in alone]
        begin[~apart] = np.cumsum(size[~apart]) - size[~apart]
        begin[apart] = len(ids) + np.cumsum(size[apart]) - size[apart]
        return np.concatenate([ids, *alone]), begin, size

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's begin and the last end."""
        texts = texts.cast(pa.large_string()).fill_null("")
        split = pc.split_pattern(texts, " ")
        pieces, first = split.flatten(), split.offsets.to_numpy() - (split.offsets[0].as_py() if len(texts) else 0)
        coded = pieces.dictionary_encode()
        words, codes = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        length = pc.binary_length(words).to_numpy()
        opens = (length == 0) | (pc.binary_length(pc.utf8_ltrim_whitespace(words)).to_numpy() < length)
        closes = (length == 0) | (pc.binary_length(pc.utf8_rtrim_whitespace(words)).to_numpy() < length)
        # A blank with white space on both sides may lie inside a run of it.
        inner = np.flatnonzero(closes[codes[:-1]] & opens[codes[1:]]) + 1
        text = np.searchsorted(first, inner, side="right") - 1
        runs, special = np.zeros(len(texts), bool), np.zeros(len(texts), bool)
        runs[text[first[text] < inner]] = True
        for s in self.special:
            special |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        flat, begin, size = self._words(words, opens | closes)
        size_at, begin_at = size[codes], begin[codes]
        size_at[np.repeat(runs | special, np.diff(first))] = 0
        # The first word of a text has no blank before it; a text that is not cut plainly is all in its first word.
        heads = [self._unit(h) for h in pieces.take(pa.array(first[:-1])).to_pylist()]
        for i in np.flatnonzero(runs & ~special):
            heads[i] = np.concatenate([self._unit(u) for u in _UNIT.split(texts[int(i)].as_py())])
        for i in np.flatnonzero(special):
            heads[i] = self._whole(texts[int(i)].as_py())
        size_at[first[:-1]] = [len(h) for h in heads]
        begin_at[first[:-1]] = len(flat) + np.cumsum(size_at[first[:-1]]) - size_at[first[:-1]]
        ends = np.cumsum(size_at)
        at = np.repeat(begin_at - ends + size_at, size_at)
        at += np.arange(len(at))
        return np.concatenate([flat, *heads])[at], np.concatenate([[0], ends])[first]


def _merge_loop(definition: dict, special: list[str]):
    """tiktoken's encoder for a byte-level BPE definition and its tokens' sizes in bytes; None if it is not the plain one."""
    import public_tokenizers
    import tiktoken

    model, pre = definition["model"], definition.get("pre_tokenizer") or {}
    vocabulary = {w: i for w, i in model.get("vocab", {}).items() if w not in special}
    merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
    plain = (model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
             and pre.get("use_regex", True) and not definition.get("normalizer") and not model.get("dropout")
             and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix"))
    first = len(vocabulary) - len(merges)
    if not plain or first != 256 or any(vocabulary.get(a + b) != first + i for i, (a, b) in enumerate(merges)):
        return None, None
    # Byte-level vocabularies write printable bytes as themselves and the others, in order, as code points from 256 on.
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    ranks = {bytes(byte[c] for c in w): i for w, i in vocabulary.items()}
    sizes = np.zeros(len(ranks), np.int64)
    sizes[list(ranks.values())] = [len(w) for w in ranks]
    encoding = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return encoding.encode_ordinary, sizes


def cut(n_tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones from its end, the first takes what is left over."""
    first = (n_tokens - 1) % capacity + 1
    return [(0, first), *[(s, capacity) for s in range(first, n_tokens, capacity)]]


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end: int = END,
           capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``doc, id, piece, start, length, ids_crc32`` (and ``ids``), ``part, nth`` for every piece of every document.

    ``tokenizer`` is a tokenizer file's path; it is read here and its text goes
    to the tasks (a vocabulary's size).  ``part`` is the task that read the
    document, ``nth`` counts its pieces of this length; ``doc`` numbers documents.
    """
    with open(tokenizer, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(quoted(id_col).alias("id"), F.monotonically_increasing_id().alias("doc"), quoted(text_col).alias("text"))
    fields = [T.StructField("id", rows.schema["id"].dataType), T.StructField("doc", T.LongType()), T.StructField("piece", T.IntegerType()),
              T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
              T.StructField("part", T.IntegerType()), T.StructField("nth", T.LongType()),
              *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else [])]

    def made(encode: Encoder, batch: pa.RecordBatch, seen: np.ndarray) -> list[pa.Array]:
        ids, offsets = encode(batch["text"])
        ids = np.insert(ids, offsets[1:], end)
        offsets = offsets + np.arange(len(offsets))
        raw = memoryview(ids).cast("B")
        rows = []
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            for k, (start, length) in enumerate(cut(b - a, capacity)):
                rows.append((i, k, start, length, zlib.crc32(raw[4 * (a + start):4 * (a + start + length)]), seen[length]))
                seen[length] += 1
        i, k, start, length, crc, nth = (pa.array(c) for c in np.array(rows, np.int64).reshape(-1, 6).T)
        out = [batch["id"].take(i), batch["doc"].take(i), k.cast(pa.int32()), start, length, crc, nth]
        if with_ids:  # the pieces follow each other as the ids do
            ends = np.concatenate([[0], np.cumsum(length.to_numpy())])
            out.append(pa.LargeListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32))).cast(pa.list_(pa.int32())))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = Encoder(shared.value), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False))
            bounds = [0, *(np.flatnonzero(np.diff(sizes // BATCH_BYTES)) + 1).tolist(), batch.num_rows]
            for a, b in zip(bounds, bounds[1:], strict=False):
                out = made(encode, batch.slice(a, b - a), seen)
                out.insert(6, pa.array(np.full(len(out[0]), part, np.int32)))
                yield pa.RecordBatch.from_arrays(out, names=[f.name for f in fields])

    return rows.mapInArrow(run, T.StructType(fields))


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: (length, from_rank, to_rank, first_sequence, per_sequence, offset) slots.

    Pieces of a length with ranks from ``from_rank`` up to ``to_rank`` go to
    sequences from ``first_sequence`` on, ``per_sequence`` to each, the first
    of them at ``offset`` there.

    Sequences filled alike form runs of consecutive numbers.  The longest
    lengths go first, each to the runs with the least room that is enough; such
    a sequence takes as many as fit, since it then has the least room of all.
    A length splits at most one run and leaves at most one sequence less full
    than the others, so there are at most three new runs for each length, and a
    run takes no more lengths than differ within ``capacity``: the plan's size
    depends on ``capacity`` alone.
    """
    room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # room left -> runs (first, how many)
    slots, n_sequences = [], 0
    for length in sorted((k for k, c in counts.items() if c), reverse=True):
        left, done = counts[length], 0
        for free in range(length, capacity + 1):
            fit = free // length
            while left and (room[free] or free == capacity):
                first, many = room[free].pop() if room[free] else (n_sequences, -(-left // fit))
                if first == n_sequences:
                    n_sequences += many
                full = min(many, left // fit)
                if full:
                    slots.append((length, done, done + full * fit, first, fit, capacity - free))
                    room[free - fit * length].append((first, full))
                    done, left = done + full * fit, left - full * fit
                if full < many and left:  # fewer than fit are left: one sequence takes them
                    slots.append((length, done, done + left, first + full, left, capacity - free))
                    room[free - left * length].append((first + full, 1))
                    done, left, full = done + left, 0, full + 1
                if full < many:
                    room[free].append((first + full, many - full))
            if not left:
                break
    return slots


SLOTS = "length long, from_rank long, to_rank long, first_sequence long, per_sequence long, offset long"


def packed(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut_pieces`` (as written by ``pieces``) with ``sequence_id`` and ``offset``."""
    per = cut_pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("c"))
    # One row for each length of a task; a length's window holds one for each task.
    before = F.sum("c").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    places = per.select("part", "length", F.coalesce(before, F.lit(0)).alias("before"))
    counts = {r["length"]: r["c"] for r in per.groupBy("length").agg(F.sum("c").alias("c")).collect()}  # capacity rows at most
    slots = cut_pieces.sparkSession.createDataFrame(plan(counts, capacity), SLOTS)
    ranked = cut_pieces.join(places, ["part", "length"]).withColumn("rank", F.col("before") + F.col("nth"))
    # The plan is bounded by the capacity, so it may be broadcast.
    s = F.broadcast(slots.withColumnRenamed("length", "of"))
    inside = (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank"))
    at = F.col("rank") - F.col("from_rank")
    sequence = F.col("first_sequence") + F.floor(at / F.col("per_sequence")).cast("long")
    offset = F.col("offset") + F.pmod(at, F.col("per_sequence")) * F.col("length")
    return ranked.join(s, inside).withColumn("sequence_id", sequence).withColumn("offset", offset).select(
        *[c for c in cut_pieces.columns if c not in ("part", "nth")], "sequence_id", "offset")


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end: int = END,
         capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Cut, plan and place: ``id, doc, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``)."""
    return packed(materialise(pieces(docs, tokenizer, id_col, text_col, end, capacity, with_ids), "pieces"), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """``sequence_id, ids, starts, docs``: the sequences themselves, of ``pack(..., with_ids=True)``.

    ``starts`` says where each document's piece begins.  A sequence holds at
    most the capacity in tokens, and so in pieces.
    """
    held = F.sort_array(F.collect_list(F.struct("offset", "id", "ids")))
    return placed.groupBy("sequence_id").agg(held.alias("held")).select(
        "sequence_id", F.flatten(F.col("held.ids")).alias("ids"), F.col("held.offset").alias("starts"), F.col("held.id").alias("docs"))
