"""Exact overlaps of token sets that meet in blocks, added up where they meet.

At low similarities a large share of all pairs passes, so neither a prefix nor a
sketch tells much, and a table of the pairs would grow with the square of the
rows.  Here whole sets travel, packed (differences of sorted tokens, compressed),
once for each block that they meet.  A task holds two blocks: one side's tokens
stand in a matrix of bytes, token by set, and adding up the rows of another
set's tokens gives its overlap with thousands of sets at once.  What leaves the
task is what the query asks for, and no more rows than sets: links of each set
and a spanning forest of them, numbers of pairs, each set's best partners (of one
side's sets, or of all that meet).  Only ``"pairs"`` gives every pair, for joins
whose result is to be listed.

Sets meet as in ``blocks``: those of one band or of neighbouring bands (of size, or
of length), each pair in exactly one place.  ``asked`` sets alone can be set
against all, which then meet nothing else.
"""

from __future__ import annotations

import hashlib
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .blocks import EPS, dealt
from .collection import text_of
from .kmer_counts import feature_ids, kmer_codes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_BLOCK, MAX_BLOCK = 2048, 1 << 16  # sets in a block
PARTS = 6             # a table too small for whole blocks is cut into so many, for the tasks' sake
ROW_TOKENS = 600      # a block has at most so many tokens for each of its sets
COLUMNS = 4096        # sets in a matrix, fewer where it would be larger than MATRIX
MATRIX = 1 << 26
BINS = (1.0, 0.5, 0.1, 1e-9)


def _numbers(df: DataFrame, tokens: str) -> Column:
    kind = df.schema[tokens].dataType.elementType.simpleString()
    return F.col(tokens) if kind in ("bigint", "int") else F.transform(tokens, lambda x: F.xxhash64(x))


def packed(rows: DataFrame, keep: list[str], tokens: str = "tokens", name: bool = False, k: int = 3, num_features: int = 0) -> DataFrame:
    """``keep``, ``n`` and ``packed``, the set of the row's tokens; with ``name`` also ``sid``, 128 bits of a hash of it.

    Tokens that are known to be the k-mers of a text are read off the text here, as arrays of numbers.  Tokens
    that are no integers are told apart by 64 bits of a hash.  ``num_features``: not the tokens, packed k-mers, but
    the distinct features that they hash to (``hashing.feature_id``).
    """
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep) + ", n int, packed binary"
    text = text_of(rows, tokens)
    size = k if text is None else text[1]

    def sets_of(column):
        for x in column:
            if text is not None:
                own = kmer_codes(x.as_py(), size)
            else:
                own = x.values.to_numpy(zero_copy_only=False).astype(np.int64) if x.is_valid else np.zeros(0, np.int64)
            yield np.unique(feature_ids(own, size, num_features) if num_features else own)

    def pack(batches):
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            n, data, names = [], [], []
            for own in sets_of(batch.column("_of")):
                raw = np.diff(own, prepend=np.int64(0)).tobytes()
                n.append(len(own))
                data.append(press.compress(raw))
                if name:
                    names.append(hashlib.blake2b(raw, digest_size=16).hexdigest())
            out = [batch.column(c) for c in keep] + [pa.array(n, pa.int32()), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(out + ([pa.array(names, pa.string())] if name else []),
                                             names=[*keep, "n", "packed"] + (["sid"] if name else []))

    of = _numbers(rows, tokens) if text is None else F.col(text[0])
    return rows.select(*keep, of.alias("_of")).mapInArrow(pack, schema + (", sid string" if name else ""))


def packed_again(sets: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, ``n`` and ``packed`` of sets that may be packed already."""
    return sets.select(*keep, "n", "packed") if "packed" in sets.columns else packed(sets, keep)


def written(df: DataFrame, name: str) -> DataFrame:
    """A table in the session's shared scratch folder."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed_items(items_with_tokens: DataFrame) -> DataFrame:
    """All rows (``_g, dataset, id, length, n, packed, sid``), written once: every step reads them."""
    return written(packed(items_with_tokens, ["_g", "dataset", "id", "length"], name=True), "packed")


def units(rows: DataFrame, by_length: bool = False) -> DataFrame:
    """``sid, _g, length, n, packed, c``: the rows of one group and set (and length), ``c`` of them, as one; none that is empty.

    Without ``by_length`` every length is 1.
    """
    length = F.col("length") if by_length else F.lit(1)
    return (rows.where(F.col("n") > 0).groupBy("sid", "_g", length.alias("length"))
            .agg(F.first("n").alias("n"), F.first("packed").alias("packed"), F.count(F.lit(1)).alias("c")))


def block_rows(rows: DataFrame) -> int:
    """Sets in a block, by how many there are."""
    return max(MIN_BLOCK, min(MAX_BLOCK, rows.count() // PARTS + 1))


def _blocks(most: int) -> Column:
    """How many blocks a band needs."""
    return F.ceil(F.greatest(F.count(F.lit(1)) / F.lit(most), F.sum("n") / F.lit(most * ROW_TOKENS))).cast("int")


def dealt_sides(left: DataFrame, right: DataFrame, reach: int, most: int) -> DataFrame:
    """Rows of both sides (``_band, sid, n`` and the same others), once for each pair of blocks that they meet in.

    Each left row meets each right row whose band is at most ``reach`` apart exactly once.
    """
    counts = [x.select("_band", "n").groupBy("_band").agg(_blocks(most).alias("_blocks")) for x in (left, right)]
    out = []
    for side, rows in enumerate((left, right)):
        other = counts[1 - side].select(F.col("_band").alias("_to"), F.col("_blocks").alias("_others"))
        keep = [c for c in rows.columns if c != "_band"]
        r = rows.join(F.broadcast(counts[side]), "_band").withColumn("_block", F.pmod(F.xxhash64("sid"), F.col("_blocks")).cast("int"))
        r = r.withColumn("_to", F.explode(F.sequence(F.col("_band") - reach, F.col("_band") + reach))).join(F.broadcast(other), "_to")
        r = r.withColumn("_at_other", F.explode(F.sequence(F.lit(0), F.col("_others") - 1)))
        own, their = F.struct(F.col("_band").alias("band"), F.col("_block").alias("block")), F.struct(
            F.col("_to").alias("band"), F.col("_at_other").alias("block"))
        one, two = (own, their) if side == 0 else (their, own)
        out.append(r.select(*keep, F.struct(one.alias("left"), two.alias("right")).alias("_at"), F.lit(side).alias("_side")))
    return out[0].unionByName(out[1])


@dataclass
class _Sets:
    """Sets of a task: sizes, groups (-1: members of several), lengths, and tokens numbered within the task."""
    n: np.ndarray
    group: np.ndarray
    length: np.ndarray | None
    marks: np.ndarray | None
    tokens: np.ndarray
    offsets: np.ndarray
    n_tokens: int


def _codes(column) -> np.ndarray:
    """Numbers for a column's values; -1 for null."""
    c = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return pc.fill_null(c.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _sets(table: pa.Table, side: np.ndarray, same: bool) -> _Sets:
    n = table["n"].to_numpy().astype(np.int64)
    column, open_ = table["packed"], zstandard.ZstdDecompressor()

    def opened(rows: np.ndarray):
        for a in range(0, len(rows), COLUMNS):
            at = rows[a:a + COLUMNS]
            yield at, [np.cumsum(np.frombuffer(open_.decompress(x.as_py()), np.int64)) for x in column.take(pa.array(at))]

    # A token that the lesser side lacks is shared by nobody.
    few = np.arange(len(n)) if same else min((np.flatnonzero(side == s) for s in (0, 1)), key=lambda x: n[x].sum())
    known = np.zeros(0, np.int64)
    for _, some in opened(few):
        known = np.union1d(known, np.concatenate(some))
    order, parts, sizes = np.arange(len(n)), [], np.zeros(len(n), np.int64)
    for at, some in opened(order):
        flat = np.concatenate(some)
        if same:
            number = np.searchsorted(known, flat)
        else:
            number = np.minimum(np.searchsorted(known, flat), max(len(known) - 1, 0))
            hit = known[number] == flat if len(known) else np.zeros(len(flat), bool)
            own = np.repeat(np.arange(len(at)), [len(x) for x in some])[hit]
            number, sizes[at] = number[hit], np.bincount(own, minlength=len(at))
        if same:
            sizes[at] = [len(x) for x in some]
        parts.append(number.astype(np.int32))
    marks = None
    if "marks" in table.column_names:
        lists = table["marks"].combine_chunks()
        marks = np.ascontiguousarray(lists.flatten().to_numpy().reshape(len(n), -1).T)
    length = table["length"].to_numpy().astype(np.int64) if "length" in table.column_names else None
    return _Sets(n, _codes(table["_g"]), length, marks, np.concatenate(parts), np.concatenate([[0], np.cumsum(sizes)]), len(known))


def _overlaps(s: _Sets, a: int, matrix: np.ndarray, buffer: np.ndarray) -> np.ndarray:
    """How many tokens set ``a`` shares with each column of the matrix."""
    own = s.tokens[s.offsets[a]:s.offsets[a + 1]]
    total = np.zeros(matrix.shape[1], np.uint16 if len(own) < 1 << 16 else np.uint32)
    for k in range(0, len(own), 255):
        part = own[k:k + 255]
        total += np.add.reduce(np.take(matrix, part, axis=0, out=buffer[:len(part)], mode="clip"), axis=0, dtype=np.uint8)
    return total


def _met(s: _Sets, left: np.ndarray, right: np.ndarray, same: bool, t: float, strict: bool, max_len_diff: float | None,
         marked: str | None):
    """``a, b, jaccard, agree`` for each set and slice of others with pairs that pass (``b``, the scores and marks are arrays).

    ``marked``: "only" looks at pairs that agree in a mark, "told" says which do.
    """
    left, right = (x[np.argsort(s.n[x], kind="stable")] for x in (left, right))
    columns = int(max(64, min(COLUMNS, len(right), MATRIX // max(s.n_tokens, 1))))
    buffer, store = np.empty((255, columns), np.uint8), np.zeros((max(s.n_tokens, 1), columns), np.uint8)
    lesser = s.n[left]
    for start in range(0, len(right), columns):
        b_rows = right[start:start + columns]
        size, group = s.n[b_rows], s.group[b_rows]
        own = [s.tokens[s.offsets[b]:s.offsets[b + 1]] for b in b_rows]
        at = np.concatenate(own).astype(np.int64) * columns + np.repeat(np.arange(len(b_rows)), [len(x) for x in own])
        store.reshape(-1)[at] = 1
        marks = None if marked is None else np.ascontiguousarray(s.marks[:, b_rows])
        first = np.searchsorted(size, lesser * t - EPS, "left")
        last = np.searchsorted(size, lesser / t * (1 + EPS) + EPS, "right") if t > 0 else np.full(len(left), len(size))
        if same:
            first = np.maximum(first, np.arange(1, len(left) + 1) - start)
        for k in np.flatnonzero(first < last):
            a, i, j = left[k], first[k], last[k]
            ok = (group[i:j] != s.group[a]) | (group[i:j] < 0)
            if max_len_diff is not None:
                one, other = s.length[a], s.length[b_rows[i:j]]
                ok &= np.abs(other - one) / np.maximum(np.maximum(other, one), 1) <= max_len_diff
            agree = None
            if marked is not None:
                agree = np.zeros(j - i, bool)
                for own_mark, others in zip(s.marks[:, a], marks[:, i:j], strict=True):
                    agree |= others == own_mark
                if marked == "only":
                    ok &= agree
            if not ok.any():
                continue
            shared = _overlaps(s, a, store, buffer)[i:j].astype(np.int64)
            score = shared / (s.n[a] + size[i:j] - shared)
            ok &= (shared > 0) & (score > t if strict else score >= t)
            found = np.flatnonzero(ok)
            if len(found):
                yield a, b_rows[i:j][found], score[found], None if agree is None else agree[found]
        store.reshape(-1)[at] = 0


def _forest(joined: np.ndarray, a: int, b: np.ndarray) -> list[int]:
    """Of ``b`` those whose link to ``a`` joins two trees, which become one; ``joined`` holds the trees."""
    def tops(x):
        y = joined[x]
        while (joined[y] != y).any():
            y = joined[y]
        joined[x] = y
        return y

    own = tops(np.array([a]))[0]
    trees, at = np.unique(tops(b), return_index=True)
    new = trees != own
    joined[trees[new]] = own
    return b[at[new]].tolist()


class _Nearest:
    """The ``k`` best partners of each of ``rows`` sets: by score, then the partner's place."""

    def __init__(self, rows: int, k: int, place: np.ndarray):
        self.place = place
        self.score, self.who = np.full((rows, k), -1.0), np.full((rows, k), -1, np.int64)
        self.last = np.full((rows, k), np.iinfo(np.int64).max)  # places of ``who``

    def add(self, a: int, b: np.ndarray, score: np.ndarray) -> None:
        """``a`` has met ``b``: each becomes a partner of the other where it is among the best."""
        k = self.who.shape[1]
        fine = score >= self.score[a, -1]
        own, j = b[fine], score[fine]
        if len(own) > k:
            top = j >= np.partition(j, -k)[-k]
            own, j = own[top], j[top]
        own, j = np.concatenate([self.who[a], own]), np.concatenate([self.score[a], j])
        place = np.concatenate([self.last[a], self.place[own[k:]]])
        top = np.lexsort((place, -j))[:k]
        self.who[a], self.score[a], self.last[a] = own[top], j[top], place[top]

        at, least = self.place[a], self.score[b, -1]
        fine = (score > least) | ((score == least) & (at < self.last[b, -1]))
        rows, new = b[fine], score[fine]
        if not len(rows):
            return
        j, place, who = self.score[rows], self.last[rows], self.who[rows]
        j[:, -1], place[:, -1], who[:, -1] = new, at, a
        for c in range(k - 1, 0, -1):  # the newcomer goes up to its rank
            up = (j[:, c] > j[:, c - 1]) | ((j[:, c] == j[:, c - 1]) & (place[:, c] < place[:, c - 1]))
            for x in (j, place, who):
                x[up, c - 1], x[up, c] = x[up, c], x[up, c - 1]
        self.score[rows], self.last[rows], self.who[rows] = j, place, who


_RESULT = {"pairs": "a_sid string, b_sid string, jaccard double", "links": "a long, b long, n long",
           "bins": "bin int, n_pairs long", "recall": "n_exact long, n_found long",
           "best": "sid string, _g string, p_sid string, p_g string, nth int, jaccard double",
           "nearest": "sid string, _g string, p_sid string, p_g string, jaccard double"}


def met_sets(cells: DataFrame, result: str, t: float, strict: bool = True, max_len_diff: float | None = None, marked: str | None = None,
             k: int = 0, bins: tuple = BINS) -> DataFrame:
    """What becomes of the pairs of each cell (see ``dealt_sides`` and ``blocks.dealt``) that pass ``t``, by ``result``:

    * ``pairs``: ``a_sid, b_sid, jaccard``; with ``k`` those scoring at least the cell's k-th best;
    * ``links``: ``a, n``, how many rows pairs set ``uid`` a against, and ``a, b``, links that join all that is joined;
    * ``bins``: ``bin, n_pairs`` of rows, the bin being the first of ``bins`` that the score reaches;
    * ``recall``: ``n_exact, n_found``, the pairs of rows and those that agree in a mark;
    * ``best``: the ``k`` best partners of each left set (the right side is of rows ``id, dataset, nth``);
    * ``nearest``: the ``k`` best partners of every set, each pair being met once (sets carry the ``id, dataset`` of their first row).
    """
    def meet(table: pa.Table) -> pa.Table:
        side, at = table["_side"].to_numpy(), table["_at"][0].as_py()
        same = "apart" in at and at["apart"] == 0 and at["i"] == at["j"]
        left = np.flatnonzero(side == 0)
        right = left if same else np.flatnonzero(side == 1)
        some = len(left) and len(right)
        s = _sets(table, side, same) if some else None
        met = _met(s, left, right, same, t, strict, max_len_diff, marked) if some else ()
        if result == "pairs":
            sid, a_out, b_out, j_out, least, held = table["sid"].combine_chunks(), [], [], [], 0.0, 0
            for a, b, score, _ in met:
                if k:
                    fine = score >= least
                    b, score = b[fine], score[fine]
                a_out.append(np.full(len(b), a))
                b_out.append(b)
                j_out.append(score)
                held += len(b)
                if k and held > max(4 * k, 4096):
                    a_out, b_out, j_out = ([np.concatenate(x)] for x in (a_out, b_out, j_out))
                    least = np.partition(j_out[0], -k)[-k]
                    fine = j_out[0] >= least
                    a_out, b_out, j_out = [a_out[0][fine]], [b_out[0][fine]], [j_out[0][fine]]
                    held = 0
            a, b, j = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a_out, b_out, j_out))
            if k and len(j) > k:
                fine = j >= np.partition(j, -k)[-k]
                a, b, j = a[fine], b[fine], j[fine]
            n = table["n"].to_numpy()
            names = np.array(sid.to_pylist(), dtype=object)
            if len(a) and "apart" in at:  # the smaller set first, then the lesser name
                turn = (n[a] > n[b]) | ((n[a] == n[b]) & (names[a] > names[b]))
                a, b = np.where(turn, b, a), np.where(turn, a, b)
            return pa.table({"a_sid": sid.take(pa.array(a, pa.int64())), "b_sid": sid.take(pa.array(b, pa.int64())),
                             "jaccard": pa.array(j, pa.float64())})
        if result == "links":
            uid, c = table["uid"].to_numpy(), table["c"].to_numpy()
            links, joined, ends = np.zeros(len(c), np.int64), np.arange(len(c)), []
            for a, b, _, _ in met:
                links[a] += c[b].sum()
                links[b] += c[a]
                ends += [(a, x) for x in _forest(joined, a, b)]
            has = np.flatnonzero(links)
            tree = np.array(ends, np.int64).reshape(-1, 2)
            return pa.table({"a": pa.array(np.concatenate([uid[has], uid[tree[:, 0]]]), pa.int64()),
                             "b": pa.array(np.concatenate([uid[has], uid[tree[:, 1]]]), pa.int64()),
                             "n": pa.array(np.concatenate([links[has], np.zeros(len(tree), np.int64)]), pa.int64())})
        if result == "bins":
            c, total, floors = table["c"].to_numpy(), np.zeros(len(bins) + 1, np.int64), -np.array(bins)
            for a, b, score, _ in met:
                total += np.bincount(np.searchsorted(floors, -score), weights=c[b], minlength=len(total)).astype(np.int64) * c[a]
            return pa.table({"bin": pa.array(np.arange(len(total)), pa.int32()), "n_pairs": pa.array(total, pa.int64())})
        if result == "recall":
            c, total = table["c"].to_numpy(), np.zeros(2, np.int64)
            for a, b, _, agree in met:
                total += np.array([c[b].sum(), c[b][agree].sum()]) * c[a]
            return pa.table({"n_exact": pa.array(total[:1], pa.int64()), "n_found": pa.array(total[1:], pa.int64())})
        # Partners of one score go by id, then dataset, nulls first.
        place = np.empty(table.num_rows, np.int64)
        order = ["id", "dataset"] + (["nth"] if result == "best" else [])
        by = pc.sort_indices(table.select(order), sort_keys=[(x, "ascending") for x in order], null_placement="at_start")
        place[by.to_numpy()] = np.arange(table.num_rows)
        if result == "nearest":
            near = _Nearest(table.num_rows, k, place)
            for a, b, score, _ in met:
                near.add(a, b, score)
            a, nth = np.nonzero(near.who >= 0)
            j, b = near.score[a, nth], near.who[a, nth]
            a, b = (pa.array(x, pa.int64()) for x in (a, b))
            return pa.table({"sid": table["sid"].take(a), "_g": table["_g"].take(a), "p_sid": table["sid"].take(b), "p_g": table["_g"].take(b),
                             "jaccard": pa.array(j, pa.float64())})
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for a, b, score, _ in met:
            if a in best:
                b, score = np.concatenate([best[a][0], b]), np.concatenate([best[a][1], score])
            if len(b) > k:
                top = np.flatnonzero(score >= np.partition(score, -k)[-k])
                top = top[np.lexsort((place[b[top]], -score[top]))][:k]
                b, score = b[top], score[top]
            best[a] = b, score
        a = np.repeat(np.array(list(best), np.int64), [len(x[0]) for x in best.values()])
        b, j = (np.concatenate([x[i] for x in best.values()]) if best else np.zeros(0, np.int64) for i in (0, 1))
        a, b = (pa.array(x, pa.int64()) for x in (a, b))
        return pa.table({"sid": table["sid"].take(a), "_g": table["_g"].take(a), "p_sid": table["sid"].take(b), "p_g": table["_g"].take(b),
                         "nth": table["nth"].take(b), "jaccard": pa.array(j, pa.float64())})

    return cells.groupBy("_at").applyInArrow(meet, _RESULT[result])


def met_among(sets: DataFrame, band: Column, reach: int, most: int, result: str, t: float, **options) -> DataFrame:
    """``met_sets`` of all pairs of ``sets`` whose bands are at most ``reach`` apart."""
    rows = sets.withColumn("_band", band.cast("long"))
    return met_sets(dealt(rows, rows.select("_band", "n"), reach, blocks=_blocks(most)), result, t, **options)


def met_sides(left: DataFrame, right: DataFrame, band: Column, reach: int, most: int, result: str, t: float, **options) -> DataFrame:
    """``met_sets`` of the pairs of a left and a right set whose bands are at most ``reach`` apart."""
    left, right = (x.withColumn("_band", band.cast("long")) for x in (left, right))
    return met_sets(dealt_sides(left, right, reach, most), result, t, **options)
