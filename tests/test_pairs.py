"""Band join, threshold join, top-k and LSH against brute force on small fixtures."""

import random
from collections import Counter

from kmerscope.operators import collection as C
from kmerscope.operators.pairs import length_band_counts, length_band_pairs
from kmerscope.operators.lsh import minhash_join
from kmerscope.operators.threshold import prepare, threshold_join
from kmerscope.operators.topk import best_matches, top_k_pairs


def _fixture(n=80, seed=3):
    rng = random.Random(seed)
    base = ["".join(rng.choice("ACDEFGHIK") for _ in range(rng.randint(20, 60))) for _ in range(12)]
    rows = []
    for i in range(n):
        s = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            s[rng.randrange(len(s))] = rng.choice("ACDEFGHIKLM")
        if rng.random() < 0.2:
            s = s[: rng.randint(0, len(s))]
        rows.append((f"d{i % 3}", i, "".join(s)))
    rows.append(("d0", 1000, ""))
    rows.append(("d1", 1001, "ab"))
    return rows


def _kset(s, k=3):
    return {s[i:i + k] for i in range(len(s) - k + 1)} if s and len(s) >= k else set()


def _j(a, b):
    i = len(a & b)
    return 0.0 if i == 0 else i / (len(a) + len(b) - i)


def _brute(rows):
    out = {}
    for da, ia, sa in rows:
        for db, ib, sb in rows:
            if da < db:
                out[(da, ia, db, ib)] = (len(sa), len(sb), _j(_kset(sa), _kset(sb)))
    return out


def _items(spark, rows):
    df = spark.createDataFrame(rows, "dataset string, id long, seq string")
    return C.with_tokens(C.across_datasets(df, "id", "seq", "dataset"))


def _key(r):
    return (r["left_dataset"], r["left_id"], r["right_dataset"], r["right_id"])


def test_band_join_equals_filtered_pairs(spark):
    rows = _fixture()
    brute = {k for k, (la, lb, _) in _brute(rows).items() if la and lb and abs(la - lb) / max(la, lb) <= 0.1}
    items = _items(spark, rows)
    for grid in ({}, {"cell_rows": 3}):
        got = {_key(r) for r in length_band_pairs(items, 0.1, **grid).collect()}
        assert got == brute


def test_length_band_counts(spark):
    rows = _fixture()
    brute = Counter((k[0], k[2]) for k, (la, lb, _) in _brute(rows).items() if la and lb and abs(la - lb) / max(la, lb) <= 0.1)
    got = {(r.left_dataset, r.right_dataset): r.n_pairs for r in length_band_counts(_items(spark, rows)).collect()}
    assert got == dict(brute)


def test_length_filtered_threshold(spark):
    rows = _fixture()
    brute = {k: j for k, (la, lb, j) in _brute(rows).items() if j >= 0.4 and abs(la - lb) / max(la, lb) <= 0.1}
    got = {_key(r): r["jaccard"] for r in threshold_join(_items(spark, rows), 0.4, strict=False, max_len_diff=0.1).collect()}
    assert got == brute


def test_rows_of_one_id_stay_apart(spark):
    left = spark.createDataFrame([("p", "ABCDEFGH"), ("p", "zzzzz"), ("q", None)], "name string, sequence string")
    right = spark.createDataFrame([("x", "ABCDEFGH")], "name string, sequence string")
    got = threshold_join(C.with_tokens(C.two_sides(left, right)), 0.9).collect()
    assert [(r.left_id, r.right_id, r.jaccard) for r in got] == [("p", "x", 1.0)]


def test_null_dataset_is_a_dataset(spark):
    df = spark.createDataFrame([(1, "ABCDEFGH", None), (2, "ABCDEFGH", "a"), (3, "ABCDEFGH", None)], "i long, t string, d string")
    items = C.with_tokens(C.across_datasets(df, "i", "t", "d"))
    got = {(r.left_dataset, r.left_id, r.right_dataset, r.right_id) for r in threshold_join(items, 0.9).collect()}
    assert got == {("a", 2, None, 1), ("a", 2, None, 3)}
    assert minhash_join(items).count() == 2


def test_a_third_of_all_rows_equal(spark):
    """Equal sets meet once, whatever their number: candidates do not grow with the copies."""
    rows = [(i, "the same text again and again", f"d{i % 2}") for i in range(200)] + [
        (1000 + i, f"text number {i} of its own {i * i}", f"d{i % 2}") for i in range(400)]
    items = C.with_tokens(C.across_datasets(spark.createDataFrame(rows, "i long, t string, d string"), "i", "t", "d"))
    _, sets = prepare(items)
    assert sets.count() == 401
    hot = [r for r in threshold_join(items, 0.95).collect() if r.left_id < 1000 and r.right_id < 1000]
    assert len(hot) == 100 * 100


def test_top_k_fills_up_with_zero_pairs(spark):
    left = spark.createDataFrame([(i, "ABCDE") for i in range(1, 4)], "name long, sequence string")
    right = spark.createDataFrame([(7, "ABCXX"), (5, "zzzzz"), (6, None)], "name long, sequence string")
    got = top_k_pairs(C.with_tokens(C.two_sides(left, right)), 7).collect()
    assert [(r.left_id, r.right_id) for r in got] == [(1, 7), (2, 7), (3, 7), (1, 5), (1, 6), (2, 5), (2, 6)]
    assert [r.jaccard for r in got] == [0.2] * 3 + [0.0] * 4


def test_building_a_join_starts_no_job(spark):
    items = _items(spark, _fixture(20))
    spark.sparkContext.setJobGroup("building", "no job while a query is built")
    threshold_join(items, 0.9)
    minhash_join(items)
    best_matches(threshold_join(items, 0.5), 2)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")


def test_threshold_join_exact(spark):
    rows = _fixture()
    brute = _brute(rows)
    items = _items(spark, rows)
    for t in (0.3, 0.6, 0.9):
        expect = {k: j for k, (_, _, j) in brute.items() if j > t}
        got = {_key(r): r["jaccard"] for r in threshold_join(items, t, cell_rows=2).collect()}
        assert got == expect, t


def test_top_k_matches_brute_force(spark):
    rows = _fixture()
    brute = sorted(((-j, k[1], k[3], k[0], k[2]) for k, (_, _, j) in _brute(rows).items() if j > 0))[:10]
    got = top_k_pairs(_items(spark, rows), 10).collect()
    assert [(r["left_id"], r["right_id"], r["jaccard"]) for r in got] == [(b[1], b[2], -b[0]) for b in brute]


def test_best_matches_per_item(spark):
    rows = _fixture()
    pairs = threshold_join(_items(spark, rows), 0.5)
    got = best_matches(pairs, 2).collect()
    per = {}
    for r in got:
        per.setdefault((r["dataset"], r["id"]), []).append(r["rank"])
    assert all(sorted(v) == list(range(1, len(v) + 1)) and len(v) <= 2 for v in per.values())


def test_no_cartesian_in_plans(spark):
    items = _items(spark, _fixture(20))
    for df in (length_band_pairs(items), threshold_join(items, 0.9)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert "BatchEvalPython" not in plan
