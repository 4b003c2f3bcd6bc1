"""Pairs of sets that may reach a similarity, met in blocks and told apart by sketches of fixed size.

Sets meet that have equal or neighbouring bands (of size, or of length).  A band
is dealt into blocks of at most ``BLOCK_ROWS`` sets, and each pair of blocks is
a task's group of rows: a set travels once for each block that it meets, as its
sketch (``WORDS`` words of 64 bits, some 200 bytes), never once for each token or
hash.  Inside a group, pairs are screened by size, group, length and the parity
of their tokens, all exact.  Sets that pass with any other come to the same group
once more, whole, to be scored (``exact_pairs``); only answers leave a task, a
batch at a time.  So shuffles hold sets and answers, not everything that meets,
and no group of rows is larger than two blocks, however many sets share a token, a
hash or a length.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Python workers get these functions with the task, so executors need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 20000
WORDS = 16   # 1,024 bits tell sets of up to some thousand tokens apart
WORD_BITS = 26  # that unlike sets differ in, by and large, of a word's 64
NARROW = 7   # words whose differing bits are added up in a byte
TILE, TILE_ROWS = 1 << 14, 16  # pairs that are screened at once
AT = {"band": pa.int64(), "apart": pa.int32(), "i": pa.int32(), "j": pa.int32()}  # a cell
OPENED = 64  # sets whose tokens are looked up at once
FEW_GROUPS = 3
SLICE_ROWS = 256
EPS = 1e-9
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of an array of lists of integers."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = a.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return a.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)])


def opened_sets(column: pa.Array) -> list[np.ndarray]:
    """The sets of a column of packed ones (``counted.packed``), as sorted numbers."""
    press = zstandard.ZstdDecompressor()
    return [np.cumsum(np.frombuffer(press.decompress(x.as_py()), np.int64)) for x in column]


def _parities(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``WORDS`` words for each list: a bit is the parity of the values whose hash falls on it."""
    out = np.zeros((len(offsets) - 1, WORDS), np.uint64)
    for a in range(0, len(out), SLICE_ROWS):
        b = min(a + SLICE_ROWS, len(out))
        row = np.repeat(np.arange(b - a), np.diff(offsets[a:b + 1]))
        bit = ((values[offsets[a]:offsets[b]].view(np.uint64) * _MIX) >> np.uint64(64 - 10)).astype(np.int64)
        odd = np.bincount(row * (64 * WORDS) + bit, minlength=(b - a) * 64 * WORDS) & 1
        out[a:b] = np.packbits(odd.astype(np.uint8).reshape(b - a, -1), axis=1).view(np.uint64)
    return out


def list_minima(values: np.ndarray, offsets: np.ndarray, coefficients: list[tuple[int, int]], prime: int) -> np.ndarray:
    """The least of each hash of a list's values, one row for each list (none may be empty)."""
    out = np.zeros((len(offsets) - 1, len(coefficients)), np.int64)
    for r in range(0, len(out), SLICE_ROWS):
        cut = offsets[r:r + SLICE_ROWS + 1]
        some = values[cut[0]:cut[-1]] + 1
        for i, (a, b) in enumerate(coefficients):
            out[r:r + SLICE_ROWS, i] = np.minimum.reduceat((some * a + b) % prime, cut[:-1] - cut[0])
    return out


def minhashes(rows: DataFrame, keep: list[str], values: str, coefficients: list[tuple[int, int]], prime: int) -> DataFrame:
    """``keep`` and ``signature``, a MinHash for each of ``coefficients``, of rows whose list of integers is not empty."""
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep) + ", signature array<bigint>"

    def sign(batches):
        for batch in batches:
            data, offsets = _lists(batch.column("values"))
            some = np.flatnonzero(np.diff(offsets))
            least = list_minima(data, np.append(offsets[some], len(data)), coefficients, prime)
            ends = np.arange(len(least) + 1, dtype=np.int32) * least.shape[1]
            out = [batch.column(c).take(pa.array(some)) for c in keep]
            yield pa.RecordBatch.from_arrays([*out, pa.ListArray.from_arrays(pa.array(ends), pa.array(least.ravel()))], names=[*keep, "signature"])

    return rows.select(*keep, F.col(values).alias("values")).mapInArrow(sign, schema)


def sketched(sets: DataFrame, keep: list[str], tokens: str = "tokens", coefficients: list[tuple[int, int]] = (),
             prime: int = 1) -> DataFrame:
    """``keep``, ``bits`` (the parities) and ``signature`` (a MinHash for each of ``coefficients``) of sets with tokens."""
    if "packed" in sets.columns:
        values = F.col("packed")
    else:
        kind = sets.schema[tokens].dataType.elementType.simpleString()
        values = F.col(tokens) if kind in ("bigint", "int") else F.transform(tokens, lambda x: F.xxhash64(x))
    columns = [F.col(c) for c in keep]
    schema = ", ".join(f"`{c}` {sets.schema[c].dataType.simpleString()}" for c in keep) + ", bits binary, signature array<bigint>"

    def sketch(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):  # a batch's tokens are never opened all at once
                part = batch.slice(start, SLICE_ROWS)
                some = part.column("values")
                if pa.types.is_binary(some.type):
                    own = opened_sets(some)
                    data, offsets = np.concatenate(own), np.concatenate([[0], np.cumsum([len(x) for x in own])])
                else:
                    data, offsets = _lists(some)
                bits = _parities(data, offsets)
                least = list_minima(data, offsets, coefficients, prime)
                ends = np.arange(len(least) + 1, dtype=np.int32) * least.shape[1]
                out = [part.column(c) for c in keep]
                out += [pa.array([x.tobytes() for x in bits], pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(least.ravel()))]
                yield pa.RecordBatch.from_arrays(out, names=[*keep, "bits", "signature"])

    return sets.select(*columns, values.alias("values")).mapInArrow(sketch, schema)


def dealt(rows: DataFrame, bands: DataFrame, reach: int, block_rows: int = BLOCK_ROWS, blocks: Column | None = None) -> DataFrame:
    """Rows with ``_band``, once for each pair of blocks that they belong to (``_at``), with their ``_side`` of it.

    ``bands`` has the rows' bands alone, to count them by.  Two rows whose bands are equal, or up to ``reach``
    apart, are in exactly one pair of blocks together.  ``blocks``: how many a band needs, if not by its rows alone.
    """
    # One row for each band: no more than there are sizes (or lengths over the bucket's width) of a text.
    needed = F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("int") if blocks is None else blocks
    blocks = bands.groupBy("_band").agg(needed.alias("_blocks"))
    placed = rows.join(F.broadcast(blocks), "_band").withColumn("_block", F.pmod(F.xxhash64("sid"), F.col("_blocks")).cast("int"))
    own = F.col("_block")

    def at(band, apart, i, j, side):
        return F.struct(band.cast("long").alias("band"), F.lit(apart).alias("apart"), i.cast("int").alias("i"),
                        j.cast("int").alias("j"), side.cast("int").alias("side"))

    placed = placed.withColumn("_cells", F.transform(F.sequence(F.lit(0), F.col("_blocks") - 1), lambda o: at(
        F.col("_band"), 0, F.least(own, o), F.greatest(own, o), F.when(own <= o, 0).otherwise(1))))
    none = F.filter("_cells", lambda _: F.lit(False))
    for d in range(1, reach + 1):
        above = blocks.select((F.col("_band") - d).alias("_band"), F.col("_blocks").alias("_above"))
        below = blocks.select((F.col("_band") + d).alias("_band"), F.col("_blocks").alias("_below"))
        placed = placed.drop("_above", "_below").join(F.broadcast(above), "_band", "left").join(F.broadcast(below), "_band", "left")

        def up(o):
            return at(F.col("_band"), d, own, o, F.lit(0))  # noqa: B023  (called before the next turn)

        def down(o):
            return at(F.col("_band") - d, d, o, own, F.lit(1))  # noqa: B023

        more = [F.transform(F.sequence(F.lit(0), F.col(c) - 1), f) for c, f in (("_above", up), ("_below", down))]
        placed = placed.withColumn("_cells", F.concat(F.col("_cells"), *[F.coalesce(m, none) for m in more]))
    keep = [c for c in rows.columns if c != "_band"]
    out = placed.select(*keep, F.explode("_cells").alias("_c"))
    return out.select(*keep, F.struct("_c.band", "_c.apart", "_c.i", "_c.j").alias("_at"), F.col("_c.side").alias("_side"))


class _Screen:
    """The sets of a cell: which pairs of them may reach ``t``, a tile at a time.

    ``bits`` are the parities, ``group`` a number (-1: members of several groups), ``signs`` the signatures.
    """

    def __init__(self, table: pa.Table, bits: np.ndarray, signs: np.ndarray | None, t: float, bands: int, rows_per_band: int,
                 max_len_diff: float | None):
        self.n, side, at = table["n"].to_numpy().astype(np.int64), table["_side"].to_numpy(), table["_at"][0].as_py()
        self.same = at["apart"] == 0 and at["i"] == at["j"]
        names, both = np.unique(np.array([*table["g_lo"].to_pylist(), *table["g_hi"].to_pylist()], dtype=object), return_inverse=True)
        self.group = np.where(both[:len(self.n)] == both[len(self.n):], both[:len(self.n)], -1)
        self.length = None if max_len_diff is None else table["length"].to_numpy().astype(np.int64)
        self.bits, self.signs, self.t, self.bands, self.rows_per_band, self.max_len_diff = bits, signs, t, bands, rows_per_band, max_len_diff
        self.unshared = 1 - 2 * t / (1 + t)
        # Sides in order of size; with few groups a slice for each, so that those of one group are not set against each other.
        self.parts = [self.group == g for g in np.unique(self.group)] if len(names) <= FEW_GROUPS else [np.ones(len(self.n), bool)]
        sides = [np.flatnonzero(side == s) for s in ((0,) if self.same else (0, 1))]
        self.slices = [[x[np.argsort(self.n[x], kind="stable")] for p in self.parts if len(x := s[p[s]])] for s in sides]
        self.work = np.empty(TILE, np.uint64), np.empty(TILE, np.uint8), np.empty(TILE, np.uint8), np.empty(TILE, np.uint16)

    def pairs(self):
        """Arrays ``a, b`` of pairs of rows, in order of a, for each tile that has any."""
        for p, a_rows in enumerate(self.slices[0]):
            for q, b_rows in enumerate(self.slices[0][p:] if self.same else self.slices[1]):
                if len(self.parts) > 1 and self.group[a_rows[0]] == self.group[b_rows[0]] >= 0:
                    continue
                yield from self._against(a_rows, b_rows, self.same and q == 0)

    def _against(self, a_rows: np.ndarray, b_rows: np.ndarray, within: bool):
        size, own = self.n[b_rows], self.n[a_rows]
        words, one = np.ascontiguousarray(self.bits[b_rows].T), np.ascontiguousarray(self.bits[a_rows].T)
        first = np.arange(1, len(a_rows) + 1) if within else np.searchsorted(size, own * self.t - EPS, "left")
        last = np.searchsorted(size, own / self.t * (1 + EPS) + EPS, "right")
        for r in range(0, len(a_rows), TILE_ROWS):
            rows = slice(r, r + TILE_ROWS)
            for c in range(int(first[rows].min()), int(last[rows].max()), TILE // TILE_ROWS):
                cols = slice(c, min(c + TILE // TILE_ROWS, int(last[rows].max())))
                i, j = self._near(one[:, rows], words[:, cols], (own[rows] + size[cols.stop - 1]) * self.unshared + EPS)
                i, j = i + r, j + c
                ok = (j >= first[i]) & (j < last[i])
                i, j = i[ok], j[ok]
                if not len(i):
                    continue
                apart = np.bitwise_count(one[:, i] ^ words[:, j]).sum(axis=0, dtype=np.int64)
                ok = apart <= (own[i] + size[j]) * self.unshared + EPS
                a, b = a_rows[i[ok]], b_rows[j[ok]]
                a, b = self._allowed(a, b)
                if len(a):
                    yield a, b

    def _near(self, one: np.ndarray, words: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and columns of a tile that differ in no more bits than ``limit`` in their first words: as many as tell most pairs."""
        shape = one.shape[1], words.shape[1]
        x, c, narrow, wide = (w[:shape[0] * shape[1]].reshape(shape) for w in self.work)
        n_words = min(WORDS, int(limit.max() / WORD_BITS) + 2)
        total = narrow if n_words <= NARROW else wide
        total[:] = 0  # what overflows looks near, and is told by all words
        for k in range(n_words):
            np.bitwise_xor(words[k][None, :], one[k][:, None], out=x)
            np.bitwise_count(x, out=c)
            np.add(total, c, out=total)
        return np.nonzero(total <= np.minimum(limit, np.iinfo(total.dtype).max).astype(total.dtype)[:, None])

    def _allowed(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ok = (self.group[b] != self.group[a]) | (self.group[b] < 0)
        if self.max_len_diff is not None:
            one, other = self.length[a], self.length[b]
            ok &= np.abs(one - other) / np.maximum(np.maximum(one, other), 1) <= self.max_len_diff
            ok &= np.maximum(one, other) > 0
        if self.bands:
            ok &= (self.signs[a] == self.signs[b]).reshape(len(a), self.bands, self.rows_per_band).all(axis=2).any(axis=1)
        return a[ok], b[ok]


def _turned(table: pa.Table, a: np.ndarray, b: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """The names of pairs, the smaller set's first (of equal sizes the lesser name)."""
    n, sid = table["n"].to_numpy(), table["sid"].combine_chunks()
    one, other = sid.take(pa.array(a)), sid.take(pa.array(b))
    turn = pa.array(n[a] > n[b])
    turn = pc.or_(turn, pc.and_(pa.array(n[a] == n[b]), pc.greater(one, other)))
    return pc.if_else(turn, other, one), pc.if_else(turn, one, other)


def _overlaps(packed: pa.Array, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shared tokens and sizes added up, of a tile's pairs (in order of a)."""
    rows, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    own = opened_sets(packed.take(pa.array(rows)))
    size = np.array([len(x) for x in own])
    known, number = np.unique(np.concatenate(own), return_inverse=True)
    of = np.split(number, np.cumsum(size)[:-1])
    has, shared = np.zeros(len(known), np.uint8), np.empty(len(a), np.int64)
    one, other = at[:len(a)], at[len(a):]
    ends = np.concatenate([np.flatnonzero(np.diff(one)) + 1, [len(one)]])
    start = 0
    for end in ends:
        has[of[one[start]]] = 1
        for s in range(start, end, OPENED):
            some = other[s:min(s + OPENED, end)]
            starts = np.concatenate([[0], np.cumsum(size[some])[:-1]])
            shared[s:s + len(some)] = np.add.reduceat(has[np.concatenate([of[x] for x in some])], starts, dtype=np.int64)
        has[of[one[start]]] = 0
        start = end
    return shared, size[one] + size[other]


def _placed(sets: DataFrame, band: Column, filtered: bool) -> tuple[DataFrame, list[str]]:
    return sets.withColumn("_band", band.cast("long")), ["sid", "n", "g_lo", "g_hi"] + (["length"] if filtered else [])


def _signs(table: pa.Table) -> np.ndarray:
    data, _ = _lists(table["signature"])
    return data.reshape(table.num_rows, -1)


def screened_pairs(sets: DataFrame, band: Column, t: float, reach: int, bands: int = 0, rows_per_band: int = 1,
                   coefficients: list[tuple[int, int]] = (), prime: int = 1, max_len_diff: float | None = None,
                   block_rows: int = BLOCK_ROWS, involved: bool = False) -> DataFrame:
    """``a_sid, b_sid`` of sets (``sid, tokens, n, g_lo, g_hi`` and ``length`` if filtered) that may have ``J >= t``.

    a is the smaller set (of equal sizes the one of lesser ``sid``).  Dropped are
    pairs that cannot reach ``t`` by their sizes or by the bits they differ in
    (each token of one side alone turns one bit), pairs of one group, pairs
    outside the length filter, and with ``bands`` pairs that agree in no band
    of the signature.  ``involved``: not the pairs, but ``sid, _at, _side`` of the sets in any, for each cell.
    """
    placed, own = _placed(sets, band, max_len_diff is not None)
    cells = dealt(sketched(placed, [*own, "_band"], "tokens", coefficients, prime), placed.select("_band"), reach, block_rows)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        bits = np.frombuffer(b"".join(table["bits"].to_pylist()), np.uint64).reshape(-1, WORDS)
        found = _Screen(table, bits, _signs(table) if bands else None, t, bands, rows_per_band, max_len_diff).pairs()
        if involved:
            some = np.zeros(table.num_rows, bool)
            for a, b in found:
                some[a] = some[b] = True
            here = table["_at"][0].as_py()
            for batch in table.select(["sid", "_side"]).filter(pa.array(some)).combine_chunks().to_batches():
                where = [pa.array([here[c]] * batch.num_rows, kind) for c, kind in AT.items()]
                yield pa.RecordBatch.from_arrays([*batch.columns, *where], names=["sid", "_side", *AT])
        else:
            for a, b in found:
                yield pa.RecordBatch.from_arrays(list(_turned(table, a, b)), names=["a_sid", "b_sid"])

    keep = ["_at", "_side", *own, "bits"] + (["signature"] if bands else [])
    if not involved:
        return cells.select(*keep).groupBy("_at").applyInArrow(meet, "a_sid string, b_sid string")
    out = cells.select(*keep).groupBy("_at").applyInArrow(meet, "sid string, _side int, band bigint, apart int, i int, j int")
    return out.select("sid", F.struct(*AT).alias("_at"), "_side")


def exact_pairs(sets: DataFrame, band: Column, t: float, reach: int, score: str = "jaccard", strict: bool | None = True, bands: int = 0,
                rows_per_band: int = 1, coefficients: list[tuple[int, int]] = (), prime: int = 1, max_len_diff: float | None = None,
                block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``a_sid, b_sid`` and their similarity, of packed sets with ``J > t`` (``strict``) or ``J >= t``; None keeps all that are screened.

    Sets are screened as in ``screened_pairs``, but no pair is sent on to be
    verified: sets that are in any go once more to their cells, whole, and are
    screened and scored there.  So a set travels for its cells, not for its pairs.
    """
    placed, own = _placed(sets, band, max_len_diff is not None)
    some = screened_pairs(sets, band, t, reach, bands, rows_per_band, coefficients, prime, max_len_diff, block_rows, involved=True)
    whole = some.join(placed.select(*own, "packed"), "sid")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        packed, bits, signs = table["packed"].combine_chunks(), [], []
        for start in range(0, table.num_rows, SLICE_ROWS):
            opened = opened_sets(packed.slice(start, SLICE_ROWS))
            data, offsets = np.concatenate(opened), np.concatenate([[0], np.cumsum([len(x) for x in opened])])
            bits.append(_parities(data, offsets))
            signs.append(list_minima(data, offsets, coefficients, prime))
        screen = _Screen(table, np.concatenate(bits), np.concatenate(signs) if bands else None, t, bands, rows_per_band, max_len_diff)
        for a, b in screen.pairs():
            shared, sizes = _overlaps(packed, a, b)
            j = shared / (sizes - shared)
            if strict is not None:
                ok = j > t if strict else j >= t
                a, b, j = a[ok], b[ok], j[ok]
            if len(a):
                yield pa.RecordBatch.from_arrays([*_turned(table, a, b), pa.array(j)], names=["a_sid", "b_sid", score])

    return whole.groupBy("_at").applyInArrow(meet, f"a_sid string, b_sid string, `{score}` double")
