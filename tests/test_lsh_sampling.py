"""MinHash LSH, hashed features and sampling."""

import random
import string

from pyspark.sql import functions as F

from kmerscope.functions.hashing import minhash_coefficients
from kmerscope.functions.similarity import length_ratio_ok
from kmerscope.operators.lsh import bands_for, hashed_features, lsh_recall, lsh_threshold_join, minhash_join, signatures
from kmerscope.operators.sampling import check_sample_size, sample_exact_n, sample_per_dataset
from kmerscope.operators.threshold import threshold_join
from kmerscope.plans.similarity_queries import RECALL, TWO_TABLE_THRESHOLD
from tests.test_pairs import _fixture, _items, _key

import pytest


def test_minhash_join_equals_exact_on_hashed_sets(spark):
    rows = _fixture()
    items = _items(spark, rows)
    feats = {(r["dataset"], r["id"]): (set(r["features"]), r["len_bucket"]) for r in hashed_features(items).collect()}
    expect = set()
    for (ga, ia), (fa, ba) in feats.items():
        for (gb, ib), (fb, bb) in feats.items():
            if ga < gb and ba == bb:
                i = len(fa & fb)
                if i and i / (len(fa) + len(fb) - i) > 0.9:
                    expect.add((ga, ia, gb, ib))
    got = {_key(r) for r in minhash_join(items, 0.1).collect()}
    assert got == expect


def test_signature_is_min_of_permutations(spark):
    items = _items(spark, _fixture(10))
    feats = hashed_features(items)
    sig = {r["id"]: r["signature"] for r in signatures(feats, 5).collect()}
    coeffs = minhash_coefficients(5)
    for r in feats.collect():
        expect = [min(((f + 1) * a + b) % 2038074743 for f in r["features"]) for a, b in coeffs]
        assert sig[r["id"]] == expect


def test_sample_exact_n_is_partition_independent(spark):
    df = spark.range(500).withColumn("dataset", (F.col("id") % 3).cast("string"))
    a = sorted(r["id"] for r in sample_exact_n(df.repartition(2), 37, "id").collect())
    b = sorted(r["id"] for r in sample_exact_n(df.repartition(7), 37, "id").collect())
    assert a == b and len(a) == 37


def test_sample_per_dataset(spark):
    df = spark.range(300).withColumn("dataset", (F.col("id") % 3).cast("string"))
    got = sample_per_dataset(df, 10, "id", "dataset").groupBy("dataset").count().collect()
    assert sorted(r["count"] for r in got) == [10, 10, 10]


def test_sample_size_errors(spark):
    df = spark.range(10).withColumn("dataset", F.lit("x"))
    with pytest.raises(ValueError):
        check_sample_size(df, 0)
    with pytest.raises(ValueError):
        check_sample_size(df, 11)
    with pytest.raises(ValueError):
        check_sample_size(df, 11, "dataset")


def test_minhash_join_adjacent_buckets(spark):
    rows = _fixture()
    items = _items(spark, rows)
    feats = {(r["dataset"], r["id"]): (set(r["features"]), r["len_bucket"])
             for r in hashed_features(items, bucket_width=10).collect()}
    expect = set()
    for (ga, ia), (fa, ba) in feats.items():
        for (gb, ib), (fb, bb) in feats.items():
            if ga < gb and abs(ba - bb) <= 1:
                i = len(fa & fb)
                if i and i / (len(fa) + len(fb) - i) > 0.9:
                    expect.add((ga, ia, gb, ib))
    got = {_key(r) for r in minhash_join(items, 0.1, bucket_width=10, neighbours=1).collect()}
    assert got == expect


@pytest.mark.parametrize("t", [TWO_TABLE_THRESHOLD, 0.5])
def test_pairs_at_the_threshold_are_found(spark, t):
    """Pairs just above the threshold, of unlike lengths too: the recall asked for, and no pair below."""
    rng = random.Random(5)
    rows = []
    for i in range(300):
        a, b = ("".join(rng.choices(string.ascii_lowercase, k=200)) for _ in range(2))
        n = round(200 * 2 * t / (1 + t)) + rng.randint(1, 8)
        rows += [("d0", i, a), ("d1", i, a[:n] + (b[n:] if i % 2 else ""))]
    items = _items(spark, rows)
    exact = {_key(r): r.jaccard for r in threshold_join(items, t).collect()}
    found = {_key(r): r.jaccard for r in lsh_threshold_join(items, t, RECALL, cell_rows=7).collect()}
    assert len(exact) > 100 and found.items() <= exact.items() and len(found) >= 0.9 * len(exact)
    if t == 0.5:
        r = lsh_recall(items, t, RECALL).first()
        assert (r.n_exact, r.n_found) == (len(exact), len(found))


def test_bands_follow_from_the_recall():
    assert bands_for(0.5, 0.9) == 9 and bands_for(0.3, 0.9) == 25 and bands_for(0.9, 0.9, 1) == 1
    for bad in ((0, 0.9), (1, 0.9), (0.5, 1)):
        with pytest.raises(ValueError):
            bands_for(*bad)


def test_length_filter_where_sets_meet(spark):
    rows = _fixture(120, seed=11)
    rows += [("d0", 900, "ABCABCABC"), ("d1", 901, "ABCABCABCABC"), ("d2", 902, "ABCABCABC")]
    items = _items(spark, rows)
    plain = minhash_join(items, 0.3, 12, 1, 100)
    expected = {_key(r) for r in plain.where(length_ratio_ok("left_length", "right_length", 0.1)).collect()}
    got = {_key(r) for r in minhash_join(items, 0.3, 12, 1, 100, max_len_diff=0.1).collect()}
    assert got == expected and ("d0", 900, "d2", 902) in got and ("d0", 900, "d1", 901) not in got
