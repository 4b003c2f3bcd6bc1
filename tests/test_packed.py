"""Sets packed as they are read off the texts: the same sets, joins and similarities as from token arrays."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kmerscope.functions.hashing import feature_set
from kmerscope.operators import blocks
from kmerscope.operators import collection as C
from kmerscope.operators.blocks import opened_sets
from kmerscope.operators.counted import packed
from kmerscope.operators.lsh import minhash_join
from kmerscope.operators.threshold import packed_sets, prepare, set_pair_table, set_pairs, threshold_join
from tests.test_blocks import _brute, _texts
from tests.test_blocks import _items as _int_items
from tests.test_counted import _copies
from tests.test_pairs import _fixture, _items, _j, _kset

TEXTS = ["banana", "ab", "", None, "a\U0001F600é\nz\U0001F600é\n", "\x00\x00\x00\x00", "banana", "一" * 5000, "x" * 9 + "yz"]


def _sets(df, *key):
    return {tuple(r[c] for c in key): (r.n, tuple(int(x) for x in own)) for r, own in
            ((r, opened_sets([_Value(r.packed)])[0]) for r in df.collect())}


class _Value:
    def __init__(self, value):
        self.value = value

    def as_py(self):
        return bytes(self.value)


@pytest.mark.parametrize("k", [1, 2, 3])
def test_sets_of_texts_are_those_of_tokens(spark, k):
    df = spark.createDataFrame([(i, s, "d") for i, s in enumerate(TEXTS)], "i long, t string, d string")
    items = C.with_tokens(C.across_datasets(df, "i", "t", "d"), k)
    assert C.text_of(items) == ("seq", k) and C.text_of(items.drop("seq")) is None
    tokens = {(r.id,): tuple(sorted(r.tokens)) for r in items.collect()}
    for known in (items, items.drop("seq")):
        assert _sets(packed(known, ["id"]), "id") == {i: (len(x), x) for i, x in tokens.items()}
    features = {(r.id,): tuple(sorted(r.f)) for r in items.select("id", feature_set("tokens", k, 64).alias("f")).collect()}
    for known in (items, items.drop("seq")):
        assert _sets(packed(known, ["id"], k=k, num_features=64), "id") == {i: (len(x), x) for i, x in features.items()}


def test_string_tokens_have_no_text(spark):
    items = C.with_tokens(C.from_table(spark.createDataFrame([(1, "abcdef")], "name long, sequence string")), 4)
    assert C.text_of(items) is None and "packed" not in packed_sets(items)[1].columns


def test_joins_make_no_token_arrays(spark):
    """Texts are read in Arrow batches: no lambda makes tokens, and no task holds a batch's tokens as arrays."""
    items = _items(spark, _fixture(20))
    for df in (threshold_join(items, 0.9), threshold_join(items, 0.9, max_len_diff=0.1), threshold_join(items, 0.5), minhash_join(items),
               *set_pair_table(items, 0.9)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "array_distinct" not in plan and "sort_array" not in plan


@pytest.mark.parametrize("t", [0.4, 0.8])
def test_pairs_of_packed_sets_are_those_of_tokens(spark, t):
    items = _items(spark, _copies())
    one = Counter(r.jaccard for r in set_pairs(prepare(items)[1], t).collect())
    assert one and Counter(r.jaccard for r in set_pairs(packed_sets(items)[1], t).collect()) == one


def test_no_pair_is_sent_on_to_be_verified(spark):
    """200 near copies: sets go to their cells twice, some 20,000 pairs leave the tasks with their scores."""
    rows = [(f"d{i % 5}", i, "the words that all of these rows share, whatever else they hold " * 2 + f"{i:03}") for i in range(200)]
    members, sets = packed_sets(_items(spark, rows))
    df = set_pairs(sets, 0.7)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "a_packed" not in plan and "a_tokens" not in plan
    texts = {i: _kset(s) for _, i, s in rows}
    expected = sorted(_j(texts[i], texts[j]) for i in texts for j in texts if i < j and i % 5 != j % 5)
    assert sorted(r.jaccard for r in df.collect()) == [x for x in expected if x > 0.7] and expected[0] > 0.7


@pytest.mark.parametrize("tile, rows, narrow", [(8, 4, 7), (1 << 14, 16, 0), (64, 1, 7)])
def test_tiles_lose_no_pair(spark, monkeypatch, tile, rows, narrow):
    for name, value in (("TILE", tile), ("TILE_ROWS", rows), ("NARROW", narrow), ("OPENED", 3)):
        monkeypatch.setattr(blocks, name, value)
    texts = _texts(120, 9, 5)
    for t, diff in ((0.75, None), (0.9, 0.05)):
        got = {(r.left_id, r.right_id, r.jaccard) for r in threshold_join(_int_items(spark, texts), t, max_len_diff=diff).collect()}
        assert got == _brute(texts, t, diff) and got


def test_long_sets_differ_in_more_bits_than_a_byte_counts(spark):
    rng = random.Random(6)
    base = [chr(0x4E00 + i) for i in rng.sample(range(20000), 6000)]
    rows = [("d0", 1, "".join(base)), ("d1", 2, "".join(base[:5600])), ("d1", 3, "".join(base[::-1])), ("d1", 4, "".join(base[:5300]) + "x" * 700)]
    assert {(r.left_id, r.right_id, r.jaccard) for r in threshold_join(_int_items(spark, rows), 0.8).collect()} == _brute(rows, 0.8)


def test_a_batch_is_sketched_in_slices(spark, monkeypatch):
    monkeypatch.setattr(blocks, "SLICE_ROWS", 4)
    plain, most = blocks._parities, 4

    def few(values, offsets):
        assert len(offsets) - 1 <= most
        return plain(values, offsets)

    monkeypatch.setattr(blocks, "_parities", few)
    items = _items(spark, _copies())
    expected = Counter(tuple(r) for r in threshold_join(items, 0.69).where("jaccard > 0.8").collect())
    assert Counter(tuple(r) for r in threshold_join(items, 0.8).collect()) == expected and expected
