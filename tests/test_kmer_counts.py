"""Numeric k-mer counts against plain Python, over texts with odd characters."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from kmerscope.functions.hashing import feature_id
from kmerscope.functions.kmers import with_kmers
from kmerscope.operators import kmer_counts
from kmerscope.operators.kmer_counts import vocabulary
from kmerscope.operators.lsh import hashed_tf

TEXTS = ["banana", "ab", "", None, "a\U0001F600\u00e9\nz\U0001F600\u00e9\n", "\x00\x00\x00\x00", "banana", "\u4e00" * 5000]


def _items(spark):
    return spark.createDataFrame([("d", i, s) for i, s in enumerate(TEXTS)], "dataset string, id int, seq string")


@pytest.mark.parametrize("k", [1, 2, 3])
def test_vocabulary(spark, k):
    bags = [[s[i:i + k] for i in range(len(s) - k + 1)] for s in TEXTS if s]
    n, held = Counter(x for b in bags for x in b), Counter(x for b in bags for x in set(b))
    got = {r.kmer: (r.doc_freq, r.occurrences) for r in vocabulary(_items(spark), k).collect()}
    assert got == {x: (held[x], n[x]) for x in n}
    assert vocabulary(_items(spark).limit(0), k).count() == 0


def test_a_long_text_is_counted_without_lambdas(spark):
    plan = vocabulary(_items(spark))._jdf.queryExecution().executedPlan().toString()
    assert "transform(" not in plan and "lambda" not in plan


@pytest.mark.parametrize("k", [1, 3])
def test_hashed_tf_of_texts_and_of_bags(spark, k):
    bag = with_kmers(_items(spark), "seq", "kmers", k, distinct=False, encoding="code")
    plain = bag.select("dataset", "id", F.explode(F.transform("kmers", lambda c: feature_id(c, k, 64))).alias("f"))
    expected = Counter(tuple(r) for r in plain.groupBy("dataset", "id", "f").count().collect())
    for items in (bag, _items(spark)):
        assert Counter(tuple(r) for r in hashed_tf(items, k, 64).collect()) == expected


def test_a_batch_is_counted_in_slices(spark, monkeypatch):
    """Whatever a batch holds, only so many k-mers are counted at once, and one row's more."""
    plain = kmer_counts.feature_ids

    def some(codes, k, num_features):
        assert len(codes) < 50 + 30
        return plain(codes, k, num_features)

    monkeypatch.setattr(kmer_counts, "SLICE_CODES", 50)
    monkeypatch.setattr(kmer_counts, "feature_ids", some)
    rows = [("d", i, s) for i, s in enumerate(["abcabcabd" * 3, "", None, "xyz", "na" * 15] * 20)]
    items = spark.createDataFrame(rows, "dataset string, id int, seq string").coalesce(1)
    bag = with_kmers(items, "seq", "kmers", 3, distinct=False, encoding="code")
    plain_rows = bag.select("dataset", "id", F.explode(F.transform("kmers", lambda c: feature_id(c, 3, 64))).alias("f"))
    expected = Counter(tuple(r) for r in plain_rows.groupBy("dataset", "id", "f").count().collect())
    for rows in (bag, items):
        assert Counter(tuple(r) for r in hashed_tf(rows, 3, 64).collect()) == expected
