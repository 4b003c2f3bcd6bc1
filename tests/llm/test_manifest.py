"""Merkle manifest against a plain tree: roots, proofs, tampering, subsets, runs of other sizes, awkward tables."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kmerscope.llm import merkle_manifest as M

from . import brute

FIELDS = ["doc_id", "source", "text", "a.b"]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(v) -> str:
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes: list[str], arity: int) -> tuple[str, list[list[str]]]:
    """The tree's digest, and each leaf's siblings run by run."""
    proofs, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(i, min(i + arity, len(nodes))) for i in range(0, len(nodes), arity)]
        for run in runs:
            for k in run:
                for leaf in owners[k]:
                    proofs[leaf] += [("".join(nodes[j] for j in run if j < k), "".join(nodes[j] for j in run if j > k))]
        owners = [sum((owners[k] for k in run), []) for run in runs]
        nodes = [sha("".join(nodes[k] for k in run)) for run in runs]
    return nodes[0], proofs


def expected(rows, arity):
    groups = defaultdict(list)
    for r in rows:
        i, text, source, ab = r[0], r[1], r[2], r[-1]
        groups[source].append((i is not None, i or 0, sha("".join(map(field, (i, source, text, ab)))), i))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([x[2] for x in sorted(groups[s])], arity) for s in names}
    root, above = climb([trees[s][0] for s in names], arity)
    out = Counter()
    for k, s in enumerate(names):
        for x, path in zip(sorted(groups[s]), trees[s][1], strict=True):
            out[x[3], x[2], trees[s][0], root, tuple(path + above[k])] += 1
    return out


def got(m, wanted=None):
    return Counter((r.id, r.leaf, r.subroot, r.root, tuple(map(tuple, r.path))) for r in M.proofs(m, wanted).collect())


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(brute.rows(n=60), brute.DOCS).repartition(3)


@pytest.mark.parametrize("arity, height", [(2, 8), (2, 2), (3, 1)])
def test_roots_and_proofs(docs, arity, height):
    m = M.build(docs, FIELDS, group_col="source", arity=arity, height=height)
    assert got(m) == expected(brute.rows(n=60), arity)


def test_proof_of_some_leaves_and_of_none(docs):
    m = M.build(docs, FIELDS, group_col="source", height=2)
    asked = m.leaves.where("rank % 7 = 3").select("g", "rank")
    every = expected(brute.rows(n=60), 2)
    some = got(m, asked.unionByName(asked))
    assert sum(some.values()) == asked.count() and all(every[x] >= n for x, n in some.items())
    assert not got(m, asked.limit(0))


def test_tampered_leaf_does_not_fold_to_the_root(docs):
    m = M.build(docs, FIELDS, group_col="source", keep={"other": M.leaf([F.col("text"), F.lit("changed")])})
    r = M.proofs(m).select((M.fold(F.col("leaf"), F.col("path")) == F.col("root")).alias("own"),
                           (M.fold(F.col("kept.other"), F.col("path")) == F.col("root")).alias("other")).collect()
    assert all(x.own and not x.other for x in r) and len(r) == m.leaves.count()


def test_records_hash_to_their_digests_and_reach_every_leaf(docs):
    m = M.build(docs, FIELDS, group_col="source", height=2)
    children = {r.digest: r.children for r in m.within.records().unionByName(m.above.records()).collect()}
    assert all(sha("".join(c)) == d for d, c in children.items())
    seen, todo = set(), [m.root]
    while todo:
        d = todo.pop()
        seen.add(d)
        todo += children.get(d, [])
    assert {r.leaf for r in m.leaves.collect()} <= seen


def test_one_row_and_no_rows(spark):
    one = spark.createDataFrame([brute.rows()[0]], brute.DOCS)
    m = M.build(one, FIELDS, group_col="source")
    r = M.proofs(m).first()
    assert r.leaf == r.subroot == r.root == m.root and r.path == []
    m = M.build(one.limit(0), FIELDS, group_col="source")
    assert m.root is None and M.proofs(m).count() == 0


def test_many_rows_alike_and_a_full_segment(spark):
    """A group of one row repeated, of exactly a segment's size and of one more."""
    rows = [(1, "t", "a")] * 16 + [(1, "t", "b")] * 17 + [(None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("a.b", F.lit("x"))
    m = M.build(df, FIELDS, group_col="source", height=2)
    assert got(m) == expected([(*r, "x") for r in rows], 2)
