"""Screening of set pairs in blocks: each pair met once, none lost, no group larger than two blocks."""

import random

import pytest
from pyspark.sql import functions as F

from kmerscope.functions.hashing import MINHASH_PRIME, minhash_coefficients
from kmerscope.operators import collection as C
from kmerscope.operators.blocks import dealt, screened_pairs
from kmerscope.operators.lsh import signatures
from kmerscope.operators.threshold import prepare, set_pairs, threshold_join


def _texts(n: int, groups: int, seed: int):
    rng = random.Random(seed)
    base = ["".join(rng.choice("ABCDEFGH") for _ in range(rng.randint(60, 90))) for _ in range(n // 4)]
    rows = []
    for i in range(n):
        s = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            s[rng.randrange(len(s))] = rng.choice("ABCDEFGH")
        rows.append((f"d{rng.randrange(groups)}", i, "".join(s)))
    return rows + [("d0", n, ""), ("d1", n + 1, None), ("d1", n + 2, "ab"), (None, n + 3, rows[0][2])]


def _items(spark, rows):
    df = spark.createDataFrame(rows, "dataset string, id int, seq string")
    return C.with_tokens(C.across_datasets(df, "id", "seq", "dataset"))


def _brute(rows, t, diff=None):
    out = set()
    sets = [{s[i:i + 3] for i in range(len(s) - 2)} if (s := r[2] or "") else set() for r in rows]
    place = [(r[0] is None, r[0] or "") for r in rows]
    for i in range(len(rows)):
        for j in range(len(rows)):
            if place[i] < place[j] and sets[i] and sets[j]:
                la, lb = len(rows[i][2]), len(rows[j][2])
                score = len(sets[i] & sets[j]) / len(sets[i] | sets[j])
                if score > t and (diff is None or abs(la - lb) / max(la, lb) <= diff):
                    out.add((rows[i][1], rows[j][1], score))
    return out


@pytest.mark.parametrize("t, groups, diff, block", [(0.7, 9, None, 7), (0.9, 2, None, 5), (0.75, 9, 0.02, 20000), (0.8, 2, 0.1, 11)])
def test_blocks_lose_no_pair(spark, t, groups, diff, block):
    rows = _texts(160, groups, 3)
    got = threshold_join(_items(spark, rows), t, max_len_diff=diff, cell_rows=block).collect()
    found = {(r.left_id, r.right_id, r.jaccard) for r in got}
    assert len(found) == len(got) and found == _brute(rows, t, diff) and found


def test_a_group_of_rows_is_two_blocks_and_each_pair_meets_once(spark):
    rows = spark.range(300).select(F.col("id").cast("string").alias("sid"), (F.col("id") % 3 * F.col("id") % 4).cast("long").alias("_band"))
    cells = dealt(rows, rows.select("_band"), 1, block_rows=20)
    each = cells.groupBy("_at").count().agg(F.max("count")).first()[0]
    assert each <= 2 * 45  # blocks are dealt by hash: near 20 rows, not exactly
    a, b = (cells.select("_at", "_side", F.col("sid").alias(s)) for s in "ab")
    apart = (F.col("_at.apart") == 0) & (F.col("_at.i") == F.col("_at.j"))
    met = a.join(b.withColumnRenamed("_side", "_other"), "_at").where(F.when(apart, F.col("a") < F.col("b")).otherwise(F.col("_side") < F.col("_other")))
    met = {frozenset((r.a, r.b)): n for r, n in [((x), x["count"]) for x in met.groupBy("a", "b").count().collect()]}
    band = {r.sid: r._band for r in rows.collect()}
    assert set(met.values()) == {1}
    assert set(met) == {frozenset((x, y)) for x in band for y in band if x < y and abs(band[x] - band[y]) <= 1}


def test_unlike_sets_of_one_hash_do_not_leave_the_task(spark):
    """All sets share their first tokens and hashes; only those that may reach the bound are sent on."""
    rng = random.Random(4)
    rows = [(f"d{i % 2}", i, "common" + "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(200))) for i in range(400)]
    rows += [("d0", 900, rows[5][2] + "x"), ("d1", 901, rows[6][2])]
    _, sets = prepare(_items(spark, rows))
    assert screened_pairs(sets, F.lit(0), 0.9, 0).count() <= 3
    assert {(r.jaccard > 0.9) for r in set_pairs(sets, 0.9).collect()} == {True}
    one_band = screened_pairs(sets, F.lit(0), 0.9, 0, 12, 1, minhash_coefficients(12), MINHASH_PRIME).count()
    assert 1 <= one_band <= 3


def test_signatures_of_empty_and_repeated_rows(spark):
    rows = [("a", [5, 9, 2]), ("b", []), ("a", [1]), ("c", None), ("d", list(range(2000)))]
    df = spark.createDataFrame(rows, "sid string, features array<int>")
    got = {r.sid: r.signature for r in signatures(df, 4, keys=("sid",)).collect()}
    sets = {"a": [5, 9, 2, 1], "d": range(2000)}
    assert got == {k: [min(((f + 1) * a + b) % MINHASH_PRIME for f in v) for a, b in minhash_coefficients(4)] for k, v in sets.items()}
    plan = signatures(df, 4, keys=("sid",))._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan  # no row for each token
