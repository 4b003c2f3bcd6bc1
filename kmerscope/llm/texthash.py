"""Hashing of words, word windows and byte windows of many texts at once, with numpy inside a task.

Texts come as one Arrow string array: a byte buffer and the offsets of its
texts.  All hashes are 64-bit and the same in every task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_RANDOM = np.random.default_rng(20)
_BYTES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER_BYTES = _BYTES.copy()
_LOWER_BYTES[65:91] = _BYTES[97:123]
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0, base**1 and so on, modulo 2**64, at least ``n`` of them."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, BLOCK + (1 << 17)), base, np.uint64)
        have[0] = 1
        _POWERS[base] = have = np.cumprod(have)
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a hash's bits over all 64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Texts:
    """Texts of a batch as one byte array; text i is ``data[offsets[i]:offsets[i + 1]]``."""
    data: np.ndarray
    offsets: np.ndarray

    @classmethod
    def of(cls, column: pa.ChunkedArray | pa.Array) -> Texts:
        """Null texts count as empty."""
        column = pc.fill_null(pc.cast(column, pa.large_string()), "")
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):  # of several chunks or of none
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
        if not len(column):
            return cls(np.zeros(0, np.uint8), np.zeros(1, np.int64))
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        return cls(data, offsets - offsets[0])

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def raw(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def _blocks(space: np.ndarray, offsets: np.ndarray):
    """Stretches of about BLOCK bytes that cut no word."""
    n, at = len(space), 0
    while at < n:
        end = at + BLOCK
        if end >= n:
            end = n
        else:
            text = offsets[np.searchsorted(offsets, end)]
            gap = end + int(np.argmax(space[end:text])) if text > end else end
            end = gap if gap < text and space[gap] else int(text)
        yield at, end
        at = end


@dataclass
class Words:
    """Words of a batch as hashes; text i has those from ``offsets[i]`` to ``offsets[i + 1]``."""
    hashes: np.ndarray
    offsets: np.ndarray
    ends: np.ndarray  # of each word, among the batch's bytes

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)


def words(texts: Texts, lower: bool = False) -> Words:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of each text; ``lower`` lower-cases A-Z first."""
    table = _LOWER_BYTES if lower else _BYTES
    space = SPACE[texts.data]
    found, begun, ended = [], [], []
    for at, end in _blocks(space, texts.offsets):
        word = ~space[at:end]
        edge = texts.offsets[np.searchsorted(texts.offsets, at):np.searchsorted(texts.offsets, end)] - at
        fresh = np.empty(len(word), bool)  # a text or white space ends before this byte
        fresh[0] = True
        fresh[1:] = ~word[:-1]
        fresh[edge] = True
        starts = np.flatnonzero(word & fresh)
        done = np.empty(len(word), bool)
        done[-1] = True
        done[:-1] = ~word[1:]
        done[edge[edge > 0] - 1] = True
        ends = np.flatnonzero(word & done) + 1
        total = np.zeros(len(word) + 1, np.uint64)
        np.cumsum(table[texts.data[at:end]] * _powers(_BASE, len(word))[:len(word)], out=total[1:])
        h = (total[ends] - total[starts]) * _powers(_INVERSE, len(word))[starts]
        found.append(mix(h + (ends - starts).astype(np.uint64)))
        begun.append(starts + at)
        ended.append(ends + at)
    hashes = np.concatenate(found) if found else np.zeros(0, np.uint64)
    starts = np.concatenate(begun) if begun else np.zeros(0, np.int64)
    ends = np.concatenate(ended) if ended else np.zeros(0, np.int64)
    return Words(hashes, np.searchsorted(starts, texts.offsets), ends)


def word_windows(hashes: np.ndarray, size: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hash of ``size`` consecutive words from each place (or from those of ``at``, ascending), texts' ends ignored."""
    return _windows(hashes, None, size, at)


def byte_windows(data: np.ndarray, size: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hash of ``size`` bytes from each place (or from those of ``at``, ascending), texts' ends ignored."""
    return _windows(data, _BYTES, size, at)


def _windows(values: np.ndarray, table: np.ndarray | None, size: int, at: np.ndarray | None) -> np.ndarray:
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = []
    for a in range(0, n, BLOCK):
        b = min(n, a + BLOCK)
        piece = values[a:b + size - 1] if table is None else table[values[a:b + size - 1]]
        total = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(piece * _powers(_BASE, len(piece))[:len(piece)], out=total[1:])
        if at is None:
            h = (total[size:] - total[:-size]) * _powers(_INVERSE, len(piece))[:b - a]
        else:
            p = at[np.searchsorted(at, a):np.searchsorted(at, b)] - a
            h = (total[p + size] - total[p]) * _powers(_INVERSE, len(piece))[p]
        out.append(mix(h))
    return np.concatenate(out)


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Of n places, those within ``size`` of a start (starts ascending)."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + size, n), -1)
    return np.cumsum(step[:-1]) > 0
