"""Merkle manifest of a dataset: a content-addressed DAG, and proofs by descent from its root.

Each row is a leaf, the digest of its fields.  The leaves of a group, in the
order of their ids, are hashed in runs of ``arity`` until one digest is left;
the groups' digests, in the order of their names, are hashed likewise to the
root.  What is stored are segments: a record maps a digest to the children
below it, level by level, down to ``height`` levels, so a segment holds at most
``arity ** height`` children however large the dataset.

A proof is found from the root down.  Requests for leaves descend together: at
each segment the digits of a leaf's rank say which child is taken, the
unselected children of every run passed are collected, and requests part where
their digits do.  The path so collected, reversed, leads from leaf to root.
Segments are found by digest; their place goes into the join key too, so that
equal segments (of repeated rows) do not meet in one task.

Every step is a join, an aggregate or an array expression of Spark.  The texts
are read once and never shuffled.

Defined results: a null field counts as ``-``; a null group is a group of its
own, before all others; null ids come before all others; equal ids are ordered
by their leaves (and rows alike in all have the same leaf, so that their order
changes no digest); an empty table has no root (null) and no proofs.  Columns
that are not named are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, quoted

PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts put together."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A field as hashed: ``-`` for null, else its length in UTF-8 bytes, a colon, and the value."""
    s = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf(fields: list[Column]) -> Column:
    return digest(*[field(f) for f in fields])


@dataclass
class Forest:
    """Trees over ranked digests: ``segments[s]`` has ``g, index, levels, digest``, ``roots`` has ``g, n, digest``.

    ``levels`` are a segment's nodes from its lowest children up, ``n`` a tree's number of leaves.
    """
    segments: list[DataFrame]
    roots: DataFrame
    arity: int
    height: int

    @property
    def span(self) -> int:
        return self.arity ** self.height

    def records(self) -> DataFrame:
        """``digest, children``: each node stored once, whatever the places where it stands."""
        out = None
        for s in self.segments:
            upper = F.transform(
                F.sequence(F.lit(1), F.size("levels") - 1),
                lambda up: F.transform(F.get("levels", up), lambda d, i: F.struct(
                    d.alias("digest"), F.slice(F.get("levels", up - 1), i * self.arity + 1, self.arity).alias("children"))))
            rows = s.select(F.inline(F.flatten(upper)))
            out = rows if out is None else out.unionByName(rows)
        return None if out is None else out.dropDuplicates(["digest"])


@dataclass
class Manifest:
    """``leaves``: ``g, n, rank, id, group, leaf`` and the columns kept; the groups' trees; the tree over the groups."""
    leaves: DataFrame
    groups: DataFrame
    within: Forest
    above: Forest
    root: str | None


def ranked(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """Rows with ``rank`` (from 0, by ``order``) in their group and the group's size ``n``.

    Rows are dealt by ranges of (group, order), so a group of any size is
    spread over tasks; a row's number in its range, less that of its group's
    first row there, is added to the group's count in the ranges before.
    """
    at = F.monotonically_increasing_id()
    spread = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order).withColumn("at", at)
    spread = materialise(spread.withColumn("part", F.shiftright("at", 33)), name)
    counts = spread.groupBy(group, "part").agg(F.count(F.lit(1)).alias("c"), F.min("at").alias("first"))
    # One row for each range that a group reaches into.
    whole = Window.partitionBy(group)
    run = F.sum("c").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    places = counts.select(group, "part", "first", F.coalesce(run, F.lit(0)).alias("before"), F.sum("c").over(whole).alias("n"))
    return (spread.join(places, [group, "part"])
            .withColumn("rank", F.col("before") + F.col("at") - F.col("first")).drop("part", "first", "before", "at"))


def forest(nodes: DataFrame, arity: int, height: int, name: str) -> Forest:
    """Hash ``g, n, rank, digest`` up to one digest for each ``g``, a table of segments for every ``height`` levels."""
    span = arity ** height
    most = nodes.agg(F.max("n")).first()[0] or 0
    segments, trees = [], nodes.where("n = 1").select("g", F.col("n").cast("long"), "digest")
    # "leaves" stays the tree's size, "n" is the number of its nodes at the present level.
    level = nodes.select("g", F.col("n").cast("long").alias("leaves"), F.col("n").cast("long"), F.col("rank").cast("long"), "digest")
    while most > 1:
        row = F.sort_array(F.collect_list(F.struct("rank", "digest")))["digest"]
        dealt = (level.where(F.col("n") > 1)
                 .groupBy("g", "leaves", "n", F.floor(F.col("rank") / span).cast("long").alias("index"))
                 .agg(row.alias("row")))
        built = dealt.select("g", "leaves", "n", "index", _levels(F.col("row"), F.col("n"), arity, height).alias("levels"))
        built = materialise(built.withColumn("digest", F.get(F.element_at("levels", -1), F.lit(0))), name)
        segments.append(built)
        trees = trees.unionByName(built.where(F.col("n") <= span).select("g", F.col("leaves").alias("n"), "digest"))
        level = built.select("g", "leaves", F.ceil(F.col("n") / span).cast("long").alias("n"),
                             F.col("index").alias("rank"), "digest")
        most = -(-most // span)
    return Forest(segments, trees, arity, height)


def _levels(row: Column, n: Column, arity: int, height: int) -> Column:
    """The segment's levels from its children up; a tree's last segment ends where one digest is left."""
    steps = sum((F.when(n > arity ** j, 1).otherwise(0) for j in range(height)), F.lit(0))

    def up(nodes: Column) -> Column:
        runs = F.sequence(F.lit(0), F.ceil(F.size(nodes) / arity).cast("int") - 1)
        return F.transform(runs, lambda i: digest(F.array_join(F.slice(nodes, i * arity + 1, arity), "")))

    kind = "array<array<string>>"
    return F.aggregate(F.sequence(F.lit(1), steps), F.array(row).cast(kind),
                       lambda done, _: F.concat(done, F.array(up(F.element_at(done, -1)))).cast(kind))


def descend(trees: Forest, entry: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (``g, rank`` and more) with ``path``: the siblings passed from the root down.

    ``entry`` has ``g, n, digest, path``: where requests for a tree come in.
    """
    span, frontier = trees.span, None
    out = wanted.join(entry.where("n = 1").select("g", "path"), "g")
    for s in range(len(trees.segments) - 1, -1, -1):
        # Trees whose root is a segment of this level: span ** s < n <= span ** (s + 1).
        coming = (entry.where((F.col("n") > span ** s) & (F.col("n") <= span ** (s + 1)))
                  .select("g", F.lit(0).cast("long").alias("index"), "digest", "path"))
        frontier = coming if frontier is None else frontier.unionByName(coming)
        opened = trees.segments[s].select("g", "index", "digest", "levels").join(frontier, ["g", "index", "digest"])
        child = F.floor(F.col("rank") / span ** s).cast("long").alias("child")
        asked = wanted.select("g", child).distinct() if s else wanted.select("*", child)
        taken = (asked.withColumn("index", F.floor(F.col("child") / span).cast("long"))
                 .join(opened.drop("digest"), ["g", "index"]))
        digit = F.pmod(F.col("child"), F.lit(span)).cast("int")
        path = F.concat("path", _passed(F.col("levels"), digit, trees.arity)).cast(PATH)
        if s:
            frontier = taken.select("g", F.col("child").alias("index"), F.get(F.get("levels", F.lit(0)), digit).alias("digest"),
                                    path.alias("path"))
        else:
            out = out.unionByName(taken.withColumn("path", path).select(*out.columns))
    return out


def _passed(levels: Column, place: Column, arity: int) -> Column:
    """The unselected children of each run on the way down to the child at ``place``."""

    def run(up: Column) -> Column:
        at = F.floor(place / F.pow(F.lit(float(arity)), up)).cast("int")
        digit = F.pmod(at, F.lit(arity)).cast("int")
        nodes = F.get(levels, up)
        return F.struct(F.array_join(F.slice(nodes, at - digit + 1, digit), "").alias("before"),
                        F.array_join(F.slice(nodes, at + 2, F.lit(arity - 1) - digit), "").alias("after"))

    return F.transform(F.sequence(F.size(levels) - 2, F.lit(0), F.lit(-1)), run)


def fold(leaf_digest: Column, path: Column) -> Column:
    """The root that a leaf and a proof (from leaf to root) give."""
    return F.aggregate(path, leaf_digest, lambda d, s: digest(s["before"], d, s["after"]))


def build(docs: DataFrame, fields: list[str], id_col: str = "doc_id", group_col: str = "lang", keep: dict[str, Column] | None = None,
          arity: int = 2, height: int = 8) -> Manifest:
    """Hash and order all rows; ``keep`` names columns to carry with each leaf (small ones)."""
    if arity < 2 or height < 1:
        raise ValueError("arity must be 2 or more, height 1 or more")
    group = quoted(group_col)
    g = F.when(group.isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), group.cast("string")))
    leaves = materialise(docs.select(
        g.alias("g"), quoted(id_col).alias("id"), group.alias("group"), leaf([quoted(f) for f in fields]).alias("leaf"),
        F.monotonically_increasing_id().alias("number"), F.struct(F.lit(0).alias("_"), *[c.alias(n) for n, c in (keep or {}).items()]).alias("kept")),
        "merkle-leaves")
    # The number only spreads rows that are alike in all over the ranges.
    leaves = ranked(leaves, "g", ["id", "leaf", "number"], "merkle-ranges").drop("number")
    within = forest(leaves.select("g", "n", "rank", F.col("leaf").alias("digest")), arity, height, "merkle-segments")
    tops = ranked(within.roots.select(F.lit("").alias("all"), "g", F.col("n").alias("leaves"), "digest"), "all", ["g"], "merkle-groups")
    above = forest(tops.select(F.col("all").alias("g"), "n", "rank", "digest"), arity, height, "merkle-top")
    root = above.roots.first()
    return Manifest(leaves, tops.select("g", "rank", F.col("leaves").alias("n"), "digest"), within, above,
                    None if root is None else root["digest"])


def proofs(m: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """Leaves asked for (all without ``wanted``; else its ``g, rank``, each pair once) with ``subroot, root, path``.

    ``path`` goes from leaf to root: for every run passed, the siblings before
    and after the digest that stands for the leaf.
    """
    leaves = m.leaves if wanted is None else m.leaves.join(wanted.select("g", "rank").distinct(), ["g", "rank"], "left_semi")
    start = m.above.roots.select("g", "n", "digest", F.array().cast(PATH).alias("path"))
    groups = m.groups.select(F.lit("").alias("g"), "rank", F.col("g").alias("group_key"), "n", "digest")
    entry = descend(m.above, start, groups).select(F.col("group_key").alias("g"), "n", "digest", "path")
    found = descend(m.within, entry, leaves)
    subroots = m.groups.select("g", F.col("digest").alias("subroot"))
    return (found.join(subroots, "g")
            .withColumn("root", F.lit(m.root)).withColumn("path", F.reverse("path")))
