"""Exact operators against brute force, over tables with every awkward case."""

from __future__ import annotations

import itertools
import math
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kmerscope.llm import anchor_dedup, cover, decontaminate, jaccard_groups, mixing, rules_cascade, suffix_dedup
from kmerscope.llm.common import words

from . import brute


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(brute.rows(), brute.DOCS).repartition(3)


@pytest.fixture(scope="module")
def plain():
    return [r[:2] for r in brute.rows()]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], brute.DOCS)


def counted(df) -> Counter:
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("period", sorted(cover.COVERS))
def test_covers_hold_every_difference(period):
    d = cover.COVERS[period]
    assert {(a - b) % period for a in d for b in d} == set(range(period))


def test_any_two_equal_windows_share_a_sample():
    offsets = np.array([0, 200, 200, 407])
    at, text = cover.sample_places(offsets, 40, 21)
    places = [set((at[text == k] - offsets[k]).tolist()) for k in range(3)]
    for i in range(160):
        for j in range(167):
            assert any(i + d in places[0] and j + d in places[2] for d in range(21))


def test_anchor_dedup(docs, plain, empty):
    assert counted(anchor_dedup.digests(docs)) == Counter(brute.windows(plain))
    assert anchor_dedup.digests(empty).count() == 0


def test_cut_repeats_keeps_columns_and_clean_texts(docs, plain, empty):
    out = anchor_dedup.cut_repeats(docs)
    assert out.columns == docs.columns and anchor_dedup.cut_repeats(empty).columns == docs.columns
    expected = Counter()
    for (i, t), (_, n, gone, _) in zip(plain, brute.windows(plain), strict=True):
        if not gone:
            expected[i, t] += 1
        elif gone < n:
            expected[i, None] += 1
    got = Counter()
    whole = dict(plain)
    for r in out.select("doc_id", "text").collect():
        got[r.doc_id, r.text if r.text == whole[r.doc_id] else None] += 1
    # A null text reads as unchanged either way.
    assert got == expected


def test_suffix_dedup(docs, plain, empty):
    assert counted(suffix_dedup.digests(docs)) == Counter(brute.earlier_strings(plain))
    assert suffix_dedup.digests(empty).count() == 0


def test_suffix_dedup_gives_bytes_and_spans(docs, plain):
    text = {i: (t or "").encode() for i, t in plain}
    for r in suffix_dedup.kept(docs).collect():
        b = bytearray(text[r["doc_id"]])
        for s in reversed(r["spans"]):
            del b[s["start"]:s["end"]]
        assert bytes(b) == bytes(r["kept"])


@pytest.mark.parametrize(("shingle", "percent"), [(3, 90), (5, 80), (1, 50)])
def test_jaccard_join(docs, plain, shingle, percent):
    got = counted(jaccard_groups.jaccard_join(docs, shingle=shingle, percent=percent))
    assert got == Counter(brute.linked(plain, shingle, percent))


def test_jaccard_join_of_many_copies_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_groups, "BLOCK_SETS", 4)
    rows = brute.rows(seed=3, n=10)
    hot = [(1000 + k, " ".join(f"w{j}" if j % 40 != k % 37 else f"v{k}" for j in range(100)), "s", *rows[0][3:]) for k in range(60)]
    got = counted(jaccard_groups.jaccard_join(spark.createDataFrame(rows + hot, brute.DOCS)))
    assert got == Counter(brute.linked([r[:2] for r in rows + hot]))


def test_keep_one(docs, plain, empty):
    out = jaccard_groups.keep_one(docs)
    assert out.columns == docs.columns
    expected, seen = Counter(), set()
    for i, n, c, _ in brute.linked(plain, 5, 80):
        if not n or c is None or (i == c and c not in seen):
            expected[i] += 1
            seen.add(c if n else None)
    assert Counter(r.doc_id for r in out.collect()) == expected
    assert jaccard_groups.keep_one(empty).count() == 0


def test_jaccard_join_of_nothing(empty):
    assert jaccard_groups.jaccard_join(empty).count() == 0


BENCHMARK = "item_id long, text string, id string, seed string"


def test_decontaminate(spark):
    item = " ".join(f"q{j}" for j in range(30))
    short = " ".join(f"r{j}" for j in range(10))
    some = [f"q{j}" for j in range(30)]
    some[4] = some[12] = some[21] = "other"
    half = [f"q{j}" if j % 2 else "no" for j in range(30)]
    rows = [(1, f"before, {item.upper().replace(' ', ', ')}! after"), (2, "x " + " ".join(some) + " y"), (3, " ".join(half)),
            (4, "z " * 50 + short), (5, "nothing of it " * 20), (6, None), (7, ""), (1, "another text of the same id"), (None, item),
            (8, " ".join(f"q{j}" for j in range(12, 30))), (9, "long " * 30_000 + item)]
    docs = spark.createDataFrame([(i, t, "s", *["x"] * len(brute.EXTRA)) for i, t in rows], brute.DOCS)
    items = spark.createDataFrame([(100, item, "i", "s"), (101, short, "i", "s"), (102, None, "i", "s"), (103, "too short", "i", "s")], BENCHMARK)
    expected = {(1, 100, 13, 30), (2, 100, 12, 27), (4, 101, 10, 10), (None, 100, 13, 30), (8, 100, 13, 18), (9, 100, 13, 30)}
    for bound in (500_000, 0):  # seeds broadcast, and seeds shuffled
        found = decontaminate.contaminated(docs, items, broadcast_seeds=bound)
        got = {tuple(r) for r in found.collect()}
        assert {(r[0], r[1]) for r in got} == {(r[0], r[1]) for r in expected}
        assert {r for r in got if r[0] != 2} == {r for r in expected if r[0] != 2}
    kept = decontaminate.decontaminated(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 5, 6, 7]
    none = items.limit(0)
    assert decontaminate.contaminated(docs, none).count() == 0 and decontaminate.contaminated(docs.limit(0), items).count() == 0


def accepted(toks, item, overlap=13, agree=0.8):
    """Whether some line-up of an item along a text agrees in enough tokens, tried without seeds."""
    n = min(overlap, len(item))
    need = math.ceil(n * agree - 1e-9)
    for start in range(1 - len(item), len(toks)):
        same = [0 <= start + j < len(toks) and toks[start + j] == x for j, x in enumerate(item)]
        if any(sum(same[k:k + n]) >= need for k in range(len(item) - n + 1)):
            return True
    return False


@pytest.mark.parametrize("n", range(1, 14))
def test_some_mask_survives_every_accepted_pattern(n):
    need = math.ceil(n * 0.8 - 1e-9)
    for gone in itertools.combinations(range(n), n - need):
        assert any(not {at + o for o in mask} & set(gone) for mask in decontaminate.masks_for(n, 0.8) for at in range(n - mask[-1]))


def test_decontaminate_finds_every_accepted_pattern(spark):
    items, rows = [], []
    for n in (*range(1, 14), 15):
        item = [f"i{n}t{j}" for j in range(n)]
        items.append((n, " ".join(item), "i", "s"))
        w = min(n, 13)
        for gone in itertools.combinations(range(n), n - math.ceil(w * 0.8 - 1e-9)):
            rows.append((n, " ".join(["before", *["no" if j in gone else x for j, x in enumerate(item)], "after"])))
    texts = {k: (n, t) for k, (n, t) in enumerate(rows)}
    docs = spark.createDataFrame([(k, t, "s", *["x"] * len(brute.EXTRA)) for k, (_, t) in texts.items()], brute.DOCS)
    whole = {n: t.split() for n, t, *_ in items}
    expected = {(k, n) for k, (n, t) in texts.items() if accepted(t.split(), whole[n])}
    for bound in (500_000, 0):
        found = decontaminate.contaminated(docs, spark.createDataFrame(items, BENCHMARK), broadcast_seeds=bound)
        assert {(r.doc_id, r.item_id) for r in found.collect()} == expected


def test_decontaminate_by_row_keeps_clean_rows_of_a_hit_id(spark):
    item, clean = " ".join(f"q{j}" for j in range(20)), "nothing of it " * 5
    rows = [(1, item), (1, clean), (None, item), (None, clean), (None, None), (2, clean), (3, item), (3, item)]
    docs = spark.createDataFrame([(i, t, "s", *["x"] * len(brute.EXTRA)) for i, t in rows], brute.DOCS)
    items = spark.createDataFrame([(100, item, "i", "s")], BENCHMARK)
    for bound in (500_000, 0):
        kept = decontaminate.decontaminated(docs, items, by_row=True, broadcast_seeds=bound)
        assert counted(kept.select("doc_id", "text")) == Counter([(1, clean), (None, clean), (None, None), (2, clean)])


def test_benchmark_leaks_keeps_clean_rows_of_a_hit_id(spark, tmp_path):
    item, clean = " ".join(f"q{j}" for j in range(20)), "nothing of it " * 5
    spark.createDataFrame([(100, item, "i", "s")], BENCHMARK).write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([(1, item), (1, clean), (None, item), (None, clean)], "doc_id long, text string")
    kept = corpus_pipeline.benchmark_leaks(spark, docs, str(tmp_path))
    assert counted(kept) == Counter([(1, clean), (None, clean)])


def test_decontaminate_tells_items_of_one_id_apart(spark):
    texts = [" ".join(f"{c}{j}" for j in range(20)) for c in "abc"]
    docs = spark.createDataFrame([(k, t, "s", *["x"] * len(brute.EXTRA)) for k, t in enumerate(texts)], brute.DOCS)
    items = spark.createDataFrame([(None, texts[0], "i", "s"), (7, texts[1], "i", "s"), (7, texts[2] + " more", "i", "s")], BENCHMARK)
    got = [counted(decontaminate.contaminated(docs, items, broadcast_seeds=bound)) for bound in (500_000, 0)]
    assert got[0] == got[1] == Counter([(0, None, 13, 20), (1, 7, 13, 20), (2, 7, 13, 20)])


def test_source_targets(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), ("c", 1000), ("d", 5), (None, 0)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    weight, left = {"a": 1, "b": 2, "c": 3, "d": 1, None: 2}, 1115.0
    size = {"a": 10, "b": 100, "c": 1000, "d": 5, None: 0}
    target, open_ = dict.fromkeys(weight, 0.0), set(weight)
    while left > 1e-9 and open_:
        share = left / sum(weight[s] for s in open_)
        for s in list(open_):
            target[s] += share * weight[s]
        left = 0.0
        for s in list(open_):
            if target[s] > 3 * size[s]:
                left += target[s] - 3 * size[s]
                target[s] = 3.0 * size[s]
                open_.discard(s)
    assert got == pytest.approx(target)


def test_mix(docs, plain, empty):
    rows = mixing.systematic_mix(docs, F.size(words(F.col("text")))).collect()
    assert Counter(r["row"]["doc_id"] for r in rows) == Counter(i for i, _ in plain)
    taken, target = Counter(), {}
    for r in rows:
        assert 0 <= r["copies"] <= 3 and r["size"] == len((dict(plain)[r["row"]["doc_id"]] or "").encode().split())
        taken[r["source"]] += r["size"] * r["copies"]
        target[r["source"]] = r["target"]
    biggest = max(r["size"] for r in rows)
    assert all(abs(taken[s] - t) <= biggest for s, t in target.items())
    again = mixing.systematic_mix(docs.repartition(7), F.size(words(F.col("text")))).collect()
    assert Counter((r["row"]["doc_id"], r["copies"]) for r in rows) == Counter((r["row"]["doc_id"], r["copies"]) for r in again)
    copies = mixing.mixed(docs, F.size(words(F.col("text"))))
    assert copies.columns == [*docs.columns, "copy_"] and copies.count() == sum(r["copies"] for r in rows)
    assert mixing.mixed(empty, F.lit(0)).count() == 0


def test_rules(spark, docs, plain, empty):
    bad = ["HELLO!! " * 12 + "AND MORE LOUD WORDS HERE TO BE SEEN!!", "a| b| c| d| e| f| g| h| i| j| k| l|", "same line\n" * 12,
           "a b c d e f g h i j k l m n", "of of the the an an so so we we go go up up", "12 34 56 78 90 11 22 33 44 55 66 77"]
    good = ["Ordinary prose goes on for a little while here, and then it stops at the end."]
    extra = spark.createDataFrame([(9000 + k, t, "s", *["x"] * len(brute.EXTRA)) for k, t in enumerate(bad + good)], brute.DOCS)
    rows = rules_cascade.judge(docs.unionByName(extra)).collect()
    text = dict(plain) | {9000 + k: t for k, t in enumerate(bad + good)}
    for r in rows:
        t = text[r.doc_id] or ""
        w = t.encode().split()
        win = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
        again = set()
        for k in range(len(w) - 4):
            if win[tuple(w[k:k + 5])] > 1:
                again |= set(range(k, k + 5))
        lines = [x for x in t.split("\n") if x.encode().split()]
        expected = (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (len(w) < 10 or 100 * len(again) > 20 * len(w))
        assert not (r.kept and r.base_failed)
    kept = {r.doc_id: r.kept for r in rows}
    assert not any(kept[9000 + k] for k in range(len(bad))) and kept[9000 + len(bad)]
    assert rules_cascade.judge(empty).count() == 0


def test_any_order_of_the_rules_gives_one_verdict(docs):
    based = rules_cascade.with_base(docs)
    rules = rules_cascade.rules()
    one, other = (based.select("id", "text", rules_cascade.cascade(r).alias("k")) for r in (rules, rules[::-1]))
    assert counted(one) == counted(other)


def test_no_operator_swallows_import_errors():
    for p in Path(rules_cascade.__file__).parent.glob("*.py"):
        assert "ImportError" not in p.read_text() and "ModuleNotFoundError" not in p.read_text()
