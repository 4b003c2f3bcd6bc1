"""Results without a cut: nearest partners, pairs of sets with their members, band counts, progressive top-k."""

import random
from collections import Counter, defaultdict

import pytest

from kmerscope.functions.similarity import length_ratio_ok
from kmerscope.operators import collection as C
from kmerscope.operators.bands import BANDS, band_counts
from kmerscope.operators.nearest import nearest_matches
from kmerscope.operators.pairs import length_band_counts
from kmerscope.operators.threshold import candidate_pairs, ordered_tokens, prepare, set_pair_table, threshold_join
from kmerscope.operators.topk import top_k_pairs
from tests.test_pairs import _fixture, _items, _j, _key, _kset


def _copies():
    """A fixture with a third of its rows equal, over several datasets, rows of one id and a null dataset."""
    rows = _fixture(40, seed=5)
    rows += [(f"d{i % 3}", 2000 + i, "the one text that many rows share") for i in range(30)]
    rows += [(None, 5, rows[3][2]), (None, 6, ""), ("d1", 7, None), ("d0", 8, rows[4][2]), ("d0", 8, rows[5][2])]
    return rows


def _groups(d):
    return "-" if d is None else "+" + d


def _scored(rows):
    """(left row number, right row number) -> score, across datasets, left the lesser."""
    sets = [_kset(s) for _, _, s in rows]
    return {(a, b): _j(sets[a], sets[b]) for a in range(len(rows)) for b in range(len(rows)) if _groups(rows[a][0]) < _groups(rows[b][0])}


def _order(dataset):
    return (dataset is not None, dataset or "")


@pytest.mark.parametrize("k, bounds, cells", [(3, (0.8, 0.3), 20000), (7, (0.4,), 3)])
def test_nearest_matches(spark, k, bounds, cells):
    rows = _copies()
    per = defaultdict(list)
    for (a, b), j in _scored(rows).items():
        if j > 0:
            per[a].append((-j, rows[b][1], _order(rows[b][0])))
            per[b].append((-j, rows[a][1], _order(rows[a][0])))
    expected = Counter()
    for a, found in per.items():
        for rank, (j, i, d) in enumerate(sorted(found)[:k], 1):
            expected[rows[a][0], rows[a][1], rank, d[1] if d[0] else None, i, -j] += 1
    trace = []
    got = nearest_matches(_items(spark, rows), k, bounds, cells, trace=trace).collect()
    assert Counter(tuple(r) for r in got) == expected
    # Fewer and fewer sets are asked, and none at a bound above its own k-th best.
    n_sets = len({frozenset(_kset(s)) for _, _, s in rows if _kset(s)})
    assert [n for n, _ in trace] == sorted((n for n, _ in trace), reverse=True) and trace[0][0] < n_sets


def test_nearest_of_nothing(spark):
    items = _items(spark, [("d0", 1, "abcdef"), ("d1", 2, "uvwxyz"), ("d1", 3, None)])
    assert nearest_matches(items).count() == 0 and nearest_matches(items.limit(0)).count() == 0


@pytest.mark.parametrize("t, filtered", [(0.5, None), (0.3, 0.1)])
def test_set_pairs_stand_for_the_expanded_join(spark, t, filtered):
    rows = _copies()
    items = _items(spark, rows)
    pairs, members = (x.collect() for x in set_pair_table(items, t, max_len_diff=filtered))
    full = threshold_join(items, t, max_len_diff=filtered).collect()
    assert sum(p.n_pairs for p in pairs) == len(full)
    assert len(members) == sum(bool(_kset(s)) for _, _, s in rows)
    of = defaultdict(list)
    for m in members:
        of[m.set_dataset, m.set_id, m.length if filtered else None].append(m)
    sizes = Counter((p.left_rows, p.right_rows) for p in pairs)
    assert max(max(s) for s in sizes) >= 30
    # Each pair of rows belongs to exactly one pair of sets, of the same score.
    name = defaultdict(set)
    for m in members:
        name[m.dataset, m.id].add((m.set_dataset, m.set_id))
    scores = Counter()
    for p in pairs:
        scores[p.jaccard] += p.n_pairs
        assert p.n_pairs <= p.left_rows * p.right_rows
        for side in ("left", "right"):
            assert (p[side + "_dataset"], p[side + "_id"]) in name[p[side + "_dataset"], p[side + "_id"]]
    assert scores == Counter(r.jaccard for r in full)


def test_set_pairs_grow_with_rows_not_with_pairs(spark):
    rows = [(f"d{i % 4}", i, "a text that a third of all rows hold") for i in range(400)] + [
        (f"d{i % 4}", 1000 + i, f"row {i * 7919} has words {i * 104729} of its own") for i in range(800)]
    pairs, members = set_pair_table(_items(spark, rows), 0.95)
    hot = [p for p in pairs.collect() if p.left_rows == 400]
    assert [(p.n_pairs, p.right_rows) for p in hot] == [(6 * 100 * 100, 400)]
    assert members.count() == 1200


@pytest.mark.parametrize("lowest", list(BANDS))
def test_band_counts(spark, lowest):
    rows = _copies()
    items = _items(spark, rows)
    names, floors = list(BANDS), list(BANDS.values())
    cut = names.index(lowest)
    expected = Counter()
    for (a, b), j in _scored(rows).items():
        la, lb = len(rows[a][2] or ""), len(rows[b][2] or "")
        if la and lb and abs(la - lb) / max(la, lb) <= 0.1:
            band = next((n for n, f in zip(names[:cut + 1], floors, strict=False) if j >= f), "none" if lowest == "low" else f"below {floors[cut]}")
            expected[band] += 1
    got = {r.band: r.n_pairs for r in band_counts(items, lowest).collect()}
    assert got == expected
    assert sum(got.values()) == sum(r.n_pairs for r in length_band_counts(items).collect())


def test_length_filter_is_inside_the_join(spark):
    """The filtered join meets fewer candidates, and loses no pair; sets equal but for their length are told apart."""
    rng = random.Random(8)
    rows = []
    for i in range(150):
        s = "".join(rng.choice("ABCD") for _ in range(rng.randint(20, 30)))
        rows.append((f"d{i % 2}", i, s * rng.randint(1, 6)))
    items = _items(spark, rows)
    met = {}
    for diff in (None, 0.1):
        _, sets = prepare(items, by_length=diff is not None)
        ordered = ordered_tokens(sets)
        met[diff] = candidate_pairs(ordered, 0.4, max_len_diff=diff).count()
    assert met[0.1] < met[None] / 2
    full = threshold_join(items, 0.4, strict=False)
    expected = Counter(tuple(r) for r in full.where(length_ratio_ok("left_length", "right_length", 0.1)).collect())
    assert Counter(tuple(r) for r in threshold_join(items, 0.4, strict=False, max_len_diff=0.1, cell_rows=5).collect()) == expected


def test_top_k_goes_down_to_the_kth_score_and_no_further(spark):
    rng = random.Random(9)
    rows = [(f"d{i % 2}", i, "".join(rng.choice("ABCDEFGHIJKLMNOP") for _ in range(60))) for i in range(40)]
    trace = []
    got = top_k_pairs(_items(spark, rows), 10, trace=trace).collect()
    best = sorted((-j, rows[a][1], rows[b][1]) for (a, b), j in _scored(rows).items())[:10]
    assert [(-r.jaccard, r.left_id, r.right_id) for r in got] == best
    assert best[-1][0] > -0.2 and trace[-1] <= got[-1].jaccard and trace[-1] > 1e-6


@pytest.mark.parametrize("filtered", [None, 0.1])
def test_top_k_fills_up_exactly(spark, filtered):
    """Fewer pairs share a token than are asked for: the others in id order, of any lengths and groups."""
    rng = random.Random(10)
    letters = [chr(0x4E00 + i) for i in range(4000)]
    rows = [(f"d{rng.randint(0, 4)}", i, "".join(letters[40 * i:40 * i + rng.randint(3, 39)])) for i in range(90)]
    rows += [("d0", 500, ""), ("d4", 501, None), ("d1", 502, rows[7][2]), ("d2", 503, rows[7][2])]
    ok = {}
    for (a, b), j in _scored(rows).items():
        la, lb = len(rows[a][2] or ""), len(rows[b][2] or "")
        if filtered is None or (la and lb and abs(la - lb) / max(la, lb) <= filtered):
            ok[rows[a][0], rows[a][1], rows[b][0], rows[b][1]] = j
    best = sorted((-j, k[1], k[3], k[0], k[2]) for k, j in ok.items())[:12]
    got = top_k_pairs(_items(spark, rows), 12, max_len_diff=filtered).collect()
    assert [(-r.jaccard, r.left_id, r.right_id, r.left_dataset, r.right_dataset) for r in got] == best
    assert len({_key(r) for r in got}) == 12
