"""Fill-in-the-middle transformation by displacement scatter.

A text is cut between lines into prefix, middle and suffix, and the parts are
put into another order with sentinels before them.  A batch of texts is one
array of bytes.  The cuts are found by scanning it for line ends; each part
moves as a whole, so the parts' first bytes get the change of displacement in a
difference array, its cumulative sum is every byte's shift, and one scatter
writes all outputs of the batch, the sentinels between.  Restoring scans an
output for its sentinels, builds the inverse displacements the same way and
gathers the text's bytes.

Both work in windows of ``WINDOW`` bytes with the shift carried over, so beside
a batch and its output only windows are held, also for one very long text.

Defined results: a null text counts as empty and stays plain (output ''); a
null id hashes as the empty text after the salt; a text that holds a sentinel
stays plain; repeated rows come out alike; an empty table gives no rows; other
columns pass through unread, the result is one new struct column.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, quoted

WINDOW = 1 << 20
FORMS = ("plain", "psm", "spm")
RESULT = "struct<output:string,form:string,n:bigint,prefix_chars:bigint,middle_chars:bigint>"


@dataclass(frozen=True)
class Layout:
    """Sentinels, and in how many of 100 texts they are used and the suffix comes first.

    A sentinel is ``<...>`` without another ``<`` or ``>``: then no piece of
    text beside one can look like one, and an output has each just once.
    """
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    fim_percent: int = 100
    spm_percent: int = 50
    salt: str = "7:"

    def __post_init__(self):
        marks = (self.prefix, self.suffix, self.middle)
        if len(set(marks)) < 3 or any(m[:1] != "<" or m[-1:] != ">" or len(m) < 3 or set(m[1:-1]) & set("<>") for m in marks):
            raise ValueError("sentinels must be three different strings like <P>")


def draws(id_col: Column, salt: str) -> list[Column]:
    """The first four groups of 8 hex digits of sha256 of the salt and the id, as numbers."""
    h = F.sha2(F.concat(F.lit(salt), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(h, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The batch's bytes and where each text begins and the last ends; null counts as empty."""
    a = (texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts).cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(a.buffers()[1], np.int64, len(a) + 1, a.offset * 8)
    raw = a.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    out = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data))
    return out.cast(pa.string())


def moved(data: np.ndarray, starts: np.ndarray, shifts: np.ndarray, out: np.ndarray, inverse: bool = False) -> None:
    """Move bytes: from ``starts[k]`` on, each byte goes ``shifts[k]`` further (``inverse``: comes from there)."""
    change = np.diff(shifts, prepend=0)
    size = len(out) if inverse else len(data)
    carried = 0
    for a in range(0, size, WINDOW):
        b = min(a + WINDOW, size)
        here = slice(*np.searchsorted(starts, [a, b]))
        step = np.zeros(b - a, np.int64)
        np.add.at(step, starts[here] - a, change[here])  # empty parts share a start with the next
        step[0] += carried
        shift = np.cumsum(step)
        carried = shift[-1]
        if inverse:
            out[a:b] = data[np.arange(a, b) + shift]
        else:
            out[np.arange(a, b) + shift] = data[a:b]


def _found(data: np.ndarray, mark: bytes) -> np.ndarray:
    """Places of a sentinel in the bytes, by windows."""
    places = []
    for a in range(0, len(data), WINDOW):
        piece = data[a:a + WINDOW + len(mark) - 1]
        if len(piece) >= len(mark):
            hit = piece[:len(piece) - len(mark) + 1] == mark[0]
            for j in range(1, len(mark)):
                hit &= piece[j:len(piece) - len(mark) + 1 + j] == mark[j]
            places.append(np.flatnonzero(hit) + a)
    return np.concatenate(places) if places else np.empty(0, np.int64)


def _inside(places: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The text of each place, for those that end before their text does."""
    text = np.searchsorted(offsets, places, side="right") - 1
    whole = places + size <= offsets[text + 1]
    return text[whole], places[whole]


def _char_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many code points begin before each of the ascending byte places ``bounds``."""
    out, done = np.zeros(len(bounds), np.int64), 0
    for a in range(0, len(data), WINDOW):
        first = np.cumsum((data[a:a + WINDOW] & 0xC0) != 0x80)
        here = slice(*np.searchsorted(bounds, [a + 1, a + len(first) + 1]))
        out[here] = done + first[bounds[here] - a - 1]
        done += int(first[-1])
    return out


def cut_points(data: np.ndarray, offsets: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines of each text, and the byte places where its prefix and its middle end."""
    ends = [np.flatnonzero(data[a:a + WINDOW] == 10) + a + 1 for a in range(0, len(data), WINDOW)]
    ends = np.concatenate(ends) if ends else np.empty(0, np.int64)
    first = np.searchsorted(ends, offsets[:-1], side="right")
    breaks = np.searchsorted(ends, offsets[1:], side="right") - first
    size = np.diff(offsets)
    closed = np.zeros(len(size), bool)
    closed[size > 0] = data[offsets[1:][size > 0] - 1] == 10
    n = breaks + ((size > 0) & ~closed)
    low, high = np.sort(np.stack([h1 % (n + 1), h2 % (n + 1)]), axis=0)

    def place(k: np.ndarray) -> np.ndarray:
        at = ends[np.clip(first + k - 1, 0, max(len(ends) - 1, 0))] if len(ends) else offsets[:-1]
        return np.where(k == 0, offsets[:-1], np.where(k > breaks, offsets[1:], at))

    return n, place(low), place(high)


def transform_batch(texts: pa.Array, h: list[np.ndarray], layout: Layout) -> pa.Array:
    """One batch of texts -> structs of output, form, lines and the parts' sizes."""
    data, offsets = _bytes_of(texts)
    rows = len(offsets) - 1
    n, p, m = cut_points(data, offsets, h[0], h[1])
    begin, end = offsets[:-1], offsets[1:]
    form = np.where(h[3] % 100 < layout.spm_percent, 2, 1)
    form[(begin == end) | (h[2] % 100 >= layout.fim_percent)] = 0
    marks = [x.encode() for x in (layout.prefix, layout.suffix, layout.middle)]
    for mark in marks:
        form[_inside(_found(data, mark), offsets, len(mark))[0]] = 0
    lp, ls, lm = (np.where(form > 0, len(x), 0) for x in marks)
    out_offsets = np.concatenate([[0], np.cumsum(end - begin + lp + ls + lm)]).astype(np.int64)
    at = out_offsets[:-1]
    # Where prefix, middle and suffix begin in the output; a plain text's parts stay in line.
    spm, plain = form == 2, form == 0
    to_p = np.where(plain, at, np.where(spm, at + ls + (end - m) + lp, at + lp))
    to_s = np.where(plain, at + (m - begin), np.where(spm, at + ls, at + lp + (p - begin) + ls))
    to_m = np.where(plain, at + (p - begin), np.where(spm, to_p + (p - begin) + lm, to_s + (end - m) + lm))
    out = np.empty(int(out_offsets[-1]), np.uint8)
    moved(data, np.stack([begin, p, m], 1).ravel(), np.stack([to_p - begin, to_m - p, to_s - m], 1).ravel(), out)
    for mark, to in zip(marks, (to_p, to_s, to_m), strict=True):
        for j, byte in enumerate(mark):
            out[to[~plain] - len(mark) + j] = byte
    chars = _char_starts(data, np.stack([begin, p, m], 1).ravel()).reshape(rows, 3) if rows else np.zeros((0, 3), np.int64)
    return pa.StructArray.from_arrays(
        [_strings(out, out_offsets), pa.array(np.array(FORMS)[form], pa.string()), pa.array(n, pa.int64()),
         pa.array(chars[:, 1] - chars[:, 0], pa.int64(), mask=plain), pa.array(chars[:, 2] - chars[:, 1], pa.int64(), mask=plain)],
        names=["output", "form", "n", "prefix_chars", "middle_chars"])


def restore_batch(outputs: pa.Array, forms: pa.Array, layout: Layout) -> pa.Array:
    """One batch of outputs -> the texts, from the sentinels in them and the forms alone."""
    data, offsets = _bytes_of(outputs)
    rows = len(offsets) - 1
    begin, end = offsets[:-1], offsets[1:]
    names = np.array([x or "plain" for x in forms.to_pylist()], dtype=object)
    spm, plain = names == "spm", ~np.isin(names, ("psm", "spm"))
    after = []  # where the part behind each sentinel begins
    for mark in (layout.prefix, layout.suffix, layout.middle):
        text, places = _inside(_found(data, mark.encode()), offsets, len(mark.encode()))
        text, first = np.unique(text, return_index=True)
        at = begin.copy()
        at[text] = places[first] + len(mark.encode())
        after.append(np.where(plain, begin, at))
    from_p, from_s, from_m = after
    lp, ls, lm = (np.where(plain, 0, len(x.encode())) for x in (layout.prefix, layout.suffix, layout.middle))
    len_p = np.where(plain, end - begin, np.where(spm, from_m - lm - from_p, from_s - ls - from_p))
    len_s = np.where(plain, 0, np.where(spm, from_p - lp - from_s, from_m - lm - from_s))
    len_m = np.where(plain, 0, end - from_m)
    text_offsets = np.concatenate([[0], np.cumsum(len_p + len_m + len_s)]).astype(np.int64)
    at = text_offsets[:-1]
    starts = np.stack([at, at + len_p, at + len_p + len_m], 1).ravel()
    shifts = np.stack([from_p - at, from_m - at - len_p, from_s - at - len_p - len_m], 1).ravel()
    out = np.empty(int(text_offsets[-1]), np.uint8)
    if rows:
        moved(data, starts, shifts, out, inverse=True)
    return _strings(out, text_offsets)


def transformed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", layout: Layout = Layout(),
                out_col: str = "fim") -> DataFrame:
    """``docs`` with ``out_col``: a struct of ``output, form, n`` (lines), ``prefix_chars, middle_chars`` (null if plain).

    If ``docs`` has a column of that name, underscores are added to the new one's.
    """

    @F.arrow_udf(RESULT)
    def fim(texts: pa.Array, a: pa.Array, b: pa.Array, c: pa.Array, d: pa.Array) -> pa.Array:
        return transform_batch(texts, [x.to_numpy(zero_copy_only=False) for x in (a, b, c, d)], layout)

    return docs.withColumn(free_name(out_col, docs.columns), fim(quoted(text_col), *draws(quoted(id_col), layout.salt)))


def restored(output: Column, form: Column, layout: Layout = Layout()) -> Column:
    """The text that an output and its form stand for."""

    @F.arrow_udf("string")
    def back(outputs: pa.Array, forms: pa.Array) -> pa.Array:
        return restore_batch(outputs, forms, layout)

    return back(output, form)
