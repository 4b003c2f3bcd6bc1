"""Exact Jaccard join of documents' word n-gram sets over a token-group matrix.

Documents link when the Jaccard similarity of their shingle sets reaches a
threshold.  Work is cut down step by step, and no step loses a link:

1. Sets of documents are made in chunks, and chunks learn which of their shingles
   occur in any other document.  A document of which too few do links with
   nothing.  Of the others the smallest hashes (the share that a linked set may
   lack, and a tenth of the set) stand for the set until blocks are opened.
2. Equal sets are collapsed into one, which stands for all its documents.
3. The remaining sets are partitioned into groups by their smallest shared
   shingle, large groups further into blocks of bounded size.  The token-group
   matrix says which block's union of shingles holds which shingle; blocks can
   only link if sets of a like size share one of their rarest shingles.
4. For each such pair of blocks, a set's overlap with the other block's union
   bounds its overlap with every set in it; only sets that reach the needed
   overlap are opened, and their exact overlaps are computed together.

Of two blocks the smaller one's sets travel to the larger.  What they find is the
number of links of each set and a spanning forest of them, never the links
themselves; components are found over these forests.

Defined results: null, empty and blank texts have no shingles and are linked with
nothing; a text of fewer words than a shingle has all of them as its one
shingle; repeated rows are separate documents of one id; a component that holds
only null ids has a null id.  Shingles are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, quoted
from .components import components
from .exchange import KEYS_SCHEMA, chunked, key_table, repeated, told
from .texthash import Texts, mix, word_windows, words

BLOCK_SETS = 256
BLOCK_SHINGLES = 1 << 18
MATRIX_COLUMNS = 4096


def _least_overlap(n: int, percent: int) -> int:
    """How many of a set's n shingles any linked set has too."""
    return -(-n * percent // 100)


def _extra(n: int) -> int:
    """Shared shingles asked for among the smallest: a tenth of the set."""
    return max(1, n // 10)


def _in_order(table: pa.Table, id_at: int) -> pa.Table:
    """A chunk's rows in an order that depends on ids and texts alone; a row's uid is its place in it."""
    ids = pc.struct_field(table["row"], [id_at])
    return table.take(pc.sort_indices(pa.table({"id": ids, "text": table["text"]}),
                                      sort_keys=[("id", "ascending"), ("text", "ascending")]))


def _sets(table: pa.Table, shingle: int) -> tuple[pa.Table, list[np.ndarray]]:
    """A chunk's rows in a fixed order, and each one's distinct shingle hashes, ascending."""
    table = _in_order(table, 0)
    w = words(Texts.of(table["text"]), lower=True)
    hashes = word_windows(w.hashes, shingle)
    out = []
    for a, b in zip(w.offsets[:-1], w.offsets[1:], strict=True):
        if b - a >= shingle:
            out.append(np.unique(hashes[a:b - shingle + 1]))
        elif b > a:
            out.append(mix(word_windows(w.hashes[a:b], int(b - a)) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return table, out


def _smallest(s: np.ndarray, percent: int) -> np.ndarray:
    """Enough of a set's smallest hashes for a linked set to share ``_extra`` of them."""
    return s[:len(s) - _least_overlap(len(s), percent) + _extra(len(s))]


def _distinct(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct hashes of a chunk's sets, how many sets have each, and where each set's hashes are among them."""
    every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    unique, back, counts = np.unique(every, return_inverse=True, return_counts=True)
    return unique, counts, back


def _documents(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """``uid, id, n, print1, print2`` for every row; ``keys`` and ``set`` for those that may have a link.

    ``keys``: the smallest hashes that another set has too, with ``need``, how many of them a linked set shares.
    """
    chunks = chunked(docs, id_col, text_col, [id_col])
    n_buckets = chunks.buckets(1 / 6)

    def send(table: pa.Table) -> pa.Table:
        return key_table(table["chunk"][0].as_py(), _distinct(_sets(table, shingle)[1])[0], n_buckets, exact=False)

    def judge(table: pa.Table, masks: pa.Table) -> pa.Table:
        table, sets = _sets(table, shingle)
        unique, counts, back = _distinct(sets)
        elsewhere = ((counts > 1) | told(unique, n_buckets, masks))[back]
        keys, need, at = [], [], 0
        for s in sets:
            again = elsewhere[at:at + len(s)]
            at += len(s)
            low = _smallest(s, percent)
            hit = low[again[:len(low)]]
            need.append(_extra(_least_overlap(len(s), percent)))
            may_link = len(s) and again.sum() >= _least_overlap(len(s), percent) and len(hit) >= need[-1]
            keys.append(hit.view(np.int64) if may_link else None)
        n = len(sets)
        first = (table["chunk"][0].as_py() << 32) if n else 0
        return pa.table({
            "uid": np.arange(n, dtype=np.int64) + first, "id": pc.struct_field(table["row"], [0]),
            "n": np.array([len(s) for s in sets], np.int64), "need": np.array(need, np.int32),
            "print1": np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64),
            "print2": np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64),
            "keys": pa.array(keys, pa.list_(pa.int64())),
            "set": pa.array([s.tobytes() if k is not None else None for s, k in zip(sets, keys, strict=True)], pa.binary())})

    groups = chunks.rows.groupBy("chunk")
    masks = repeated(groups.applyInArrow(send, KEYS_SCHEMA), exact=False)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"uid long, id {kind}, n long, need int, print1 long, print2 long, keys array<long>, set binary"
    return groups.cogroup(masks.groupBy("chunk")).applyInArrow(judge, schema)


class _Block:
    """Sets of one block, as one array of shingles with each one's set."""

    def __init__(self, members: pa.Table):
        sets = [np.frombuffer(x, np.uint64) for x in members["set"].to_pylist()]
        self.uid, self.copies = members["uid"].to_numpy(), members["copies"].to_numpy()
        self.n = np.array([len(s) for s in sets], np.int64)
        every = np.concatenate(sets)
        order = np.argsort(every, kind="stable")
        self.shingles, self.owner = every[order], np.repeat(np.arange(len(sets)), self.n)[order]
        self.union = self.shingles[np.concatenate([[True], self.shingles[1:] != self.shingles[:-1]])]

    def opened(self, union: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sets whose overlap with a union is enough for a link, and their shingles in it: column and row."""
        at = np.minimum(np.searchsorted(union, self.shingles), len(union) - 1)
        held = union[at] == self.shingles
        at, owner = at[held], self.owner[held]
        enough = 100 * np.bincount(owner, minlength=len(self.n)) >= percent * self.n
        return enough, at[enough[owner]], owner[enough[owner]]


def _linked(x: _Block, y: _Block, percent: int) -> np.ndarray:
    """A matrix: does set i of x link with set j of y?"""
    union = np.intersect1d(x.union, y.union, assume_unique=True)
    overlap = np.zeros((len(x.n), len(y.n)))
    if not len(union):
        return overlap > 0
    _, cx, rx = x.opened(union, percent)
    _, cy, ry = y.opened(union, percent)
    for a in range(0, len(union), MATRIX_COLUMNS):
        parts = []
        for block, c, r in ((x, cx, rx), (y, cy, ry)):
            i, j = np.searchsorted(c, [a, a + MATRIX_COLUMNS])
            m = np.zeros((len(block.n), min(MATRIX_COLUMNS, len(union) - a)), np.float32)
            m[r[i:j], c[i:j] - a] = 1
            parts.append(m)
        overlap += parts[0] @ parts[1].T
    overlap = overlap.astype(np.int64)
    return (overlap > 0) & (100 * overlap >= percent * (x.n[:, None] + y.n[None, :] - overlap))


def _forest(link: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a symmetric link matrix."""
    new, out = link.any(axis=1), []
    for root in range(len(link)):
        if not new[root]:
            continue
        new[root], front = False, [root]
        while front:
            i = front.pop()
            found = np.flatnonzero(link[i] & new)
            new[found] = False
            out += [(i, int(j)) for j in found]
            front += found.tolist()
    return out


VISITING_SHINGLES = 1 << 18
_FOUND = pa.schema([("uid", pa.int64()), ("other", pa.int64()), ("links", pa.int64())])


def _open(percent: int):
    """Open a block for its own sets (in part 0) and for the visiting ones.

    Gives ``uid, other`` of spanning forests' edges, and ``uid, links`` (other is -1) of the sets.
    """
    def rows(uid: np.ndarray, whole: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]]) -> pa.Table:
        edges = np.array(_forest(whole), np.int64).reshape(-1, 2)
        u, v, links = [uid[edges[:, 0]]], [uid[edges[:, 1]]], [np.zeros(len(edges), np.int64)]
        for who, n in found:
            u.append(who[n > 0])
            v.append(np.full(int((n > 0).sum()), -1, np.int64))
            links.append(n[n > 0].astype(np.int64))
        return pa.table({"uid": np.concatenate(u), "other": np.concatenate(v), "links": np.concatenate(links)}, _FOUND)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("guest", "ascending"), ("uid", "ascending")])
        n = len(table) - pc.sum(pc.cast(table["guest"], pa.int32())).as_py()
        out = [_FOUND.empty_table()]
        if not n:
            return out[0]
        home = _Block(table.slice(0, n))
        if table["part"][0].as_py() == 0 and n > 1:
            link = _linked(home, home, percent)
            np.fill_diagonal(link, False)
            out.append(rows(home.uid, link, [(home.uid, link @ home.copies)]))
        for a in range(n, len(table), BLOCK_SETS):
            guests = _Block(table.slice(a, BLOCK_SETS))
            link = _linked(home, guests, percent)
            if link.any():
                uid = np.concatenate([home.uid, guests.uid])
                whole = np.zeros((len(uid), len(uid)), bool)
                whole[:n, n:] = link
                whole |= whole.T
                out.append(rows(uid, whole, [(home.uid, link @ guests.copies), (guests.uid, link.T @ home.copies)]))
        return pa.concat_tables(out)

    return run


def _components(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """``uid, id, n, label, links`` for every row; ``label`` is null for those that cannot have a link."""
    every = materialise(_documents(docs, id_col, text_col, shingle, percent), "shingle-sets")
    some = every.where(F.col("keys").isNotNull())
    same = ["print1", "print2", "n"]
    classes = materialise(some.groupBy(*same).agg(F.min("uid").alias("rep"), F.count(F.lit(1)).alias("copies"))
                          .where(F.col("copies") > 1), "classes")
    member = materialise(some.select("uid", *same).join(classes, same, "left").select(
        "uid", F.coalesce("rep", "uid").alias("rep"), F.coalesce("copies", F.lit(1)).cast("long").alias("copies")), "members")

    reps = (some.select("uid", "n", "need", "keys", F.array_min("keys").alias("least"))
            .join(member.where(F.col("uid") == F.col("rep")).select("uid", "copies"), "uid"))
    sizes = reps.groupBy("least").agg(F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_SETS)),
                                                 F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES))).alias("parts"))
    block = F.xxhash64("least", F.pmod(F.xxhash64("uid"), F.col("parts")))
    placed = materialise(reps.join(sizes, "least").select("uid", "n", "need", "copies", "keys", block.alias("block")), "blocks")

    # The token-group matrix, and how many blocks have each shingle.
    matrix = placed.select("block", F.explode("keys").alias("key")).distinct()
    spread = matrix.groupBy("key").agg(F.count(F.lit(1)).alias("blocks"))
    rarest = (placed.select("uid", "block", "need", "n", F.explode("keys").alias("key")).join(spread, "key")
              .groupBy("uid", "block", "need", "n").agg(F.sort_array(F.collect_list(F.struct("blocks", "key"))).alias("k")))
    # Sizes of linked sets are in the same band or in neighbouring ones.
    width = math.log(100 / percent) * (1 + 1e-9)
    band = F.floor(F.log("n") / F.lit(width)) if width else F.col("n")
    index = (rarest.select("block", band.alias("band"), F.explode(F.slice("k", F.lit(1), F.size("k") - F.col("need") + 1)).alias("k"))
             .where(F.col("k.blocks") > 1).select("block", "band", F.col("k.key").alias("key")).distinct())
    near = index.select(F.col("block").alias("second"), "key", F.explode(F.sequence(F.col("band") - 1, F.col("band") + 1)).alias("band")).distinct()
    pairs = (index.withColumnRenamed("block", "first").join(near, ["key", "band"]).where(F.col("first") < F.col("second"))
             .select("first", "second").distinct())

    # Of two blocks the smaller one's sets visit the larger; a block with many visitors opens in several parts.
    weight = placed.groupBy("block").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("sets"), F.min("n").alias("low"), F.max("n").alias("high"))
    w1 = weight.select(F.col("block").alias("first"), F.struct("n", F.col("block").alias("b"), "low", "high").alias("x"))
    w2 = weight.select(F.col("block").alias("second"), F.struct("n", F.col("block").alias("b"), "low", "high").alias("y"))
    sizes_fit = (100 * F.col("x.high") >= percent * F.col("y.low")) & (100 * F.col("y.high") >= percent * F.col("x.low"))
    visits = materialise(pairs.join(w1, "first").join(w2, "second").where(sizes_fit).select(
        F.greatest("x", "y")["b"].alias("home"), F.least("x", "y")["b"].alias("block"), F.least("x", "y")["n"].alias("n")), "visits")
    parts = materialise(visits.groupBy("home").agg(F.ceil(F.sum("n") / F.lit(VISITING_SHINGLES)).cast("int").alias("parts")), "parts")
    guests = visits.join(parts, "home").select("block", "home", F.pmod(F.xxhash64("block"), F.col("parts")).cast("int").alias("part"),
                                               F.lit(True).alias("guest"))
    homes = (weight.join(parts, F.col("block") == F.col("home"), "left").where(F.col("parts").isNotNull() | (F.col("sets") > 1))
             .select("block", F.col("block").alias("home"), F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"),
                     F.lit(False).alias("guest")))
    going = placed.select("uid", "copies", "block").join(homes.unionByName(guests), "block").drop("block")
    found = materialise(going.join(some.select("uid", "set"), "uid").groupBy("home", "part")
                        .applyInArrow(_open(percent), "uid long, other long, links long"), "links")

    label = components(found.where(F.col("other") >= 0).select(F.col("uid").alias("a"), F.col("other").alias("b")))
    links = found.groupBy(F.col("uid").alias("rep")).agg(F.sum("links").alias("links"))
    known = (member.join(label.withColumnRenamed("node", "rep"), "rep", "left").join(links, "rep", "left")
             .select("uid", F.coalesce("label", "rep").alias("label"),
                     (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")))
    return every.select("uid", "id", "n").join(known, "uid", "left")


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                 percent: int = 90) -> DataFrame:
    """``id_col, n_shingles, component_id, n_links`` for every row.

    Documents link at a Jaccard similarity of ``percent`` / 100 or more;
    ``component_id`` is the smallest id reachable by links.
    """
    rows = _components(docs, id_col, text_col, shingle, percent)
    rows = materialise(rows, "components")
    lowest = materialise(rows.where(F.col("label").isNotNull()).groupBy("label").agg(F.min("id").alias("lowest")), "lowest")
    return rows.join(lowest, "label", "left").select(
        quoted("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("label").isNull(), F.col("id")).otherwise(F.col("lowest")).alias("component_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` (all columns) with one row of each component: that of the smallest id (a null id counts as the largest).

    Rows without shingles stay.
    """
    rows = _components(docs, id_col, text_col, shingle, percent).where(F.col("label").isNotNull())
    rows = materialise(rows.select("uid", "id", "label"), "components")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "uid")
    first = materialise(rows.groupBy("label").agg(F.min(order)["uid"].alias("first")), "first")
    gone = rows.join(first, "label").where(F.col("uid") != F.col("first")).select(
        F.shiftright("uid", 32).cast("int").alias("chunk"), F.col("uid").bitwiseAND(F.lit((1 << 32) - 1)).alias("at"))
    row = T.StructType([docs.schema[c] for c in docs.columns])
    chunks = chunked(docs, id_col, text_col, docs.columns)
    at = docs.columns.index(id_col)

    def stay(table: pa.Table, gone: pa.Table) -> pa.Table:
        table = _in_order(table, at)
        keep = np.ones(len(table), bool)
        keep[gone["at"].to_numpy()] = False
        return table.select(["row"]).filter(pa.array(keep))

    out = chunks.rows.groupBy("chunk").cogroup(gone.groupBy("chunk")).applyInArrow(stay, T.StructType([T.StructField("row", row)]))
    return out.select("row.*")
