"""Sets counted in blocks: links and classes, searches, two sides, and no table of the pairs."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kmerscope.operators import collection as C
from kmerscope.operators import topk
from kmerscope.operators.counted import met_among, met_sides, packed_items, units
from kmerscope.operators.links import linked_rows
from kmerscope.operators.lsh import lsh_links, lsh_sided_join, lsh_threshold_join
from kmerscope.operators.nearest import nearest_matches, searched_pairs
from kmerscope.operators.threshold import set_pairs, prepare, sided_pairs, threshold_join
from kmerscope.operators.topk import best_matches, top_k_pairs
from tests.test_pairs import _fixture, _items, _j, _key, _kset
from tests.test_whole_results import _copies, _order, _scored


def _expected_links(rows, ok):
    near = defaultdict(set)
    for (a, b), j in _scored(rows).items():
        if ok(rows[a][2] or "", rows[b][2] or "", j):
            near[a].add(b)
            near[b].add(a)
    out = Counter()
    for a, (d, i, s) in enumerate(rows):
        seen, todo = {a}, [a]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        out[d, i, None if s is None else len(s), min(rows[x][1] for x in seen), len(near[a])] += 1
    return out


@pytest.mark.parametrize("t, diff", [(0.5, None), (0.5, 0.1), (0.2, 0.3)])
def test_links_and_classes_of_every_row(spark, t, diff):
    rows = _copies()
    got = Counter(tuple(r) for r in linked_rows(_items(spark, rows), t, strict=False, max_len_diff=diff).collect())
    assert got == _expected_links(rows, lambda a, b, j: j >= t and (diff is None or abs(len(a) - len(b)) <= diff * max(len(a), len(b))))


def test_classes_larger_than_a_task_takes(spark, monkeypatch):
    monkeypatch.setattr("kmerscope.operators.links.HOT_ROWS", 3)
    rows = _copies()
    got = Counter(tuple(r) for r in linked_rows(_items(spark, rows), 0.5).collect())
    assert got == _expected_links(rows, lambda a, b, j: j > 0.5)


def test_minhash_links_are_the_joins(spark):
    items = _items(spark, _fixture(60, seed=4))
    links = Counter()
    for r in lsh_threshold_join(items, 0.5).collect():
        links[r.left_id] += 1
        links[r.right_id] += 1
    assert len(links) > 30 and {r.id: r.n_links for r in lsh_links(items, 0.5).collect() if r.n_links} == links


@pytest.mark.parametrize("above", [0.0, 0.4])
def test_searches_find_the_best_of_the_asked_rows(spark, above):
    rows = _copies()
    items, asked, k = _items(spark, rows), F.col("id") % 20 == 0, 3
    per = defaultdict(list)
    for (a, b), j in _scored(rows).items():
        if j > above:
            per[a].append((-j, rows[b][1], _order(rows[b][0])))
            per[b].append((-j, rows[a][1], _order(rows[a][0])))
    expected = Counter((rows[a][0], rows[a][1], rank, d[1] if d[0] else None, i, -j) for a, found in per.items() if rows[a][1] % 20 == 0
                       for rank, (j, i, d) in enumerate(sorted(found)[:k], 1))
    found = best_matches(searched_pairs(items, k, asked, above), k, both=False)
    assert expected and Counter(tuple(r) for r in found.select(
        "dataset", "id", "rank", "partner_dataset", "partner_id", "jaccard").collect()) == expected
    if above == 0:
        assert Counter(tuple(r) for r in nearest_matches(items, k, asked=asked).collect()) == expected


@pytest.mark.parametrize("most", [2, 7, 5000])
def test_every_pair_meets_once_whatever_the_blocks(spark, most, monkeypatch):
    monkeypatch.setattr("kmerscope.operators.threshold.rows_of_block", lambda rows: most)
    rows = [(0 if d == "d0" else 1, i, s) for d, i, s in _fixture(70)]
    sides = [spark.createDataFrame([(i, s) for g, i, s in rows if g == x], "name long, sequence string") for x in (0, 1)]
    items = C.with_tokens(C.two_sides(*sides))
    expected = Counter(((i, j, x) for g, i, a in rows for h, j, b in rows if g < h and (x := _j(_kset(a), _kset(b))) > 0.3))
    assert expected and Counter((r.left_id, r.right_id, r.jaccard) for r in sided_pairs(items, 0.3).collect()) == expected
    assert Counter((r.left_id, r.right_id, r.jaccard) for r in threshold_join(items, 0.3, cell_rows=most).collect()) == expected


def test_what_leaves_a_task_does_not_grow_with_the_pairs(spark):
    """All of 300 rows are linked with each other: a row for each, and a forest, for some 45,000 pairs."""
    rng = random.Random(3)
    base = "".join(rng.choice("ABCDEFGH") for _ in range(300))
    rows = [(f"d{i % 5}", i, base + "".join(rng.choice("ABCDEFGH") for _ in range(20))) for i in range(300)]
    sets = units(packed_items(_items(spark, rows))).withColumn("uid", F.monotonically_increasing_id()).localCheckpoint()
    out = met_among(sets, F.lit(0), 0, 1000, "links", 0.5).collect()
    assert len(out) < 2 * 300 and sum(r.n for r in out) == 300 * 240
    kept = met_sides(sets, sets, F.lit(0), 0, 1000, "pairs", 0.0, k=5).count()
    assert 5 <= kept < 100


def test_frequent_tokens_are_not_met_by_token(spark):
    """At a low threshold no join by token is planned, and no token leaves its set."""
    items = _items(spark, _fixture(30))
    plan = set_pairs(prepare(items)[1], 0.5)._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan.lower() and "Generate inline" not in plan


def test_a_long_set_and_counts_beyond_a_byte(spark):
    text = "".join(chr(0x4E00 + i) for i in range(2000))
    items = _items(spark, [("d0", 1, text), ("d1", 2, text[:1500]), ("d1", 3, "xyz")])
    assert [(r.left_id, r.right_id, r.jaccard) for r in threshold_join(items, 0.5).collect()] == [(1, 2, 1498 / 1998)]


def test_two_sides_by_minhash(spark):
    rows = _fixture(60)
    left = spark.createDataFrame([(i, s) for d, i, s in rows if d == "d0"], "name long, sequence string")
    right = spark.createDataFrame([(i, s) for d, i, s in rows if d != "d0"], "name long, sequence string")
    items = C.with_tokens(C.two_sides(left, right))
    got = Counter(tuple(r) for r in lsh_sided_join(items, 0.3).collect())
    assert got and got == Counter(tuple(r) for r in lsh_threshold_join(items, 0.3).collect())


def test_equal_sets_suffice_for_the_top(spark, monkeypatch):
    """With k pairs of equal sets nothing is joined; two sides are met once."""
    rows = _copies()
    trace = []
    items = _items(spark, rows)
    got = top_k_pairs(items, 5, trace=trace).collect()
    best = sorted((-j, rows[a][1], rows[b][1]) for (a, b), j in _scored(rows).items())[:5]
    assert trace == [1.0] and [(-r.jaccard, r.left_id, r.right_id) for r in got] == best

    monkeypatch.setattr(topk, "set_pairs", None)
    left = spark.createDataFrame([(i, s) for d, i, s in rows if d == "d0"], "name long, sequence string")
    right = spark.createDataFrame([(i, s) for d, i, s in rows if d == "d1"], "name long, sequence string")
    sided = top_k_pairs(C.with_tokens(C.two_sides(left, right)), 9, sided=True).collect()
    best = sorted((-_j(_kset(a), _kset(b)), i, j) for d, i, a in rows if d == "d0" for e, j, b in rows if e == "d1")[:9]
    assert [(-r.jaccard, r.left_id, r.right_id) for r in sided] == best
    assert _key(sided[0])[0::2] == ("left", "right")
