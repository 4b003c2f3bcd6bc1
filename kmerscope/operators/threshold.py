"""Exact Jaccard threshold join by prefix filtering over distinct sets (no cross product).

Rows with equal token sets are collapsed first: the join works on distinct
sets, each standing for its members, and only its result is expanded.  If
``J(A, B) >= t`` then ``|A n B| >= ceil(t * max(|A|, |B|))``, and under any
fixed global token order the first ``|A| - ceil(t|A|) + 1`` tokens of A and the
first ``|B| - ceil(t|B|) + 1`` tokens of B share at least one token (the
prefix-filter lemma of the AllPairs / PPJoin papers).  So:

1. frequencies over distinct sets, per hash cell of tokens (one aggregate with
   map-side combine, of fixed size);
2. per set, tokens sorted by (frequency, token); keep the prefix.  Rare tokens
   come first, so a common token enters a prefix only for sets made almost
   entirely of common tokens;
3. equi-join the prefixes on token and size band (sets of similar size only;
   hot tokens spread over a grid of tasks), the smaller set against the larger,
   each pair once, and only sets with members of different groups;
4. verify each candidate with the exact Jaccard of the full sets.

At ``t >= PARITY_FROM`` steps 1 to 3 are replaced by screening in blocks
(``blocks.screened_pairs``): sets of like size meet as sketches of fixed size, and
the parity of their tokens tells exactly which cannot reach ``t``.  Nothing is
shuffled by token there, so the frequent tokens of long texts cost no disk.

Below it, sets of integers (packed k-mers) are counted in blocks instead
(``counted``): there most sets of like size share frequent tokens, and a table of
what meets under them would be quadratic in the rows.  Steps 1 to 4 remain for
tokens that are texts.

With the length filter, sets are told apart by their members' length as well, so
the filter is exact on pairs of sets: it is part of the join key (as length
bands, where these are narrower than the size bands) and is checked before
anything is counted or verified, not on the expanded result.

``set_pair_table`` gives the result without expanding it: pairs of sets, each
named by its first member, with the number of member pairs they stand for, and
``set_members`` says which rows a set stands for.  Both grow with the rows and
the linked sets, however many copies there are.

The result is exact for every ``t > 0``: no pair above the threshold is lost,
none below it is returned.  The work shrinks as ``t`` grows; at low ``t`` the
prefixes approach the whole set.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import explode_values
from ..functions.similarity import jaccard, length_ratio_ok, log_length_band
from .blocks import BLOCK_ROWS, exact_pairs, screened_pairs
from .counted import met_among, met_sides, packed, packed_again, packed_items, units
from .counted import block_rows as rows_of_block
from .pairs import orient
from .skew import DEFAULT_CELL_ROWS, grid_self_join, grid_size, prefixed

EPS = 1e-9
CELLS = 1 << 17
RANK_STEPS = 4
PARITY_FROM = 0.7  # of lower similarity, the unshared tokens allowed are more than the bits


def set_id(tokens: Column) -> Column:
    """128-bit key of a token set, whatever its order: two 64-bit hashes of its sorted tokens."""
    ordered = F.sort_array(tokens)
    return F.concat_ws("-", *[F.hex(F.xxhash64(F.lit(seed), ordered)) for seed in (1, 2)])


def with_set_id(items: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Items with ``sid``, the key of their token set."""
    return items.withColumn("sid", set_id(F.col(tokens)))


def distinct_sets(items: DataFrame, tokens: str = "tokens", by: tuple = ()) -> DataFrame:
    """``sid, *by, tokens, n`` and ``g_lo, g_hi`` (least and greatest group of its members) per distinct set.

    Empty sets are left out (they match nothing), after the aggregate: a filter
    before it would be pushed into the lambdas that make the tokens.
    """
    sets = items.groupBy("sid", *by).agg(
        F.first(tokens).alias("tokens"), F.min("_g").alias("g_lo"), F.max("_g").alias("g_hi"))
    return sets.withColumn("n", F.size("tokens")).where(F.col("n") > 0)


def _cell(token: Column) -> Column:
    return F.pmod(F.hash(token), F.lit(CELLS))


def cell_ranks(sets: DataFrame) -> DataFrame:
    """One row with ``ranks``: for each of ``CELLS`` hash cells of tokens how frequent it is, a byte each.

    Of a cell whose tokens are held by ``df`` sets (added up) the rank is
    ``log2(df)`` in steps of a quarter, rounded up; no pair shares a token of
    rank 0.  The table's size is fixed, whatever the vocabulary.
    """
    counts = (sets.select(explode_values(F.transform("tokens", _cell), "cell"))
              .groupBy("cell").agg(F.count(F.lit(1)).alias("df")))
    rank = F.coalesce(F.ceil(F.log2("df") * RANK_STEPS - F.lit(EPS)), F.lit(0)).cast("tinyint")
    every = sets.sparkSession.range(CELLS).select(F.col("id").cast("int").alias("cell")).join(counts, "cell", "left")
    return every.agg(F.sort_array(F.collect_list(F.struct("cell", rank.alias("rank"))))["rank"].alias("ranks"))


def ordered_tokens(sets: DataFrame) -> DataFrame:
    """Sets with ``ord``: their tokens as ``struct(rank, tok)`` sorted rarest first.

    Any order that is the same for all sets will do for the prefix filter.
    This one goes by the frequency of a token's hash cell, which is at least
    the token's own: a table of fixed size tells it inside the row, so no token
    is shuffled to be ordered.
    """
    keys = [c for c in sets.columns if c not in ("tokens", "n")]
    told = sets.select(*keys, "tokens", cell_ranks(sets).scalar().alias("ranks"))
    ranked = F.transform("tokens", lambda x: F.struct(F.get("ranks", _cell(x)).alias("rank"), x.alias("tok")))
    return told.select(*keys, F.sort_array(ranked).alias("ord"))


def token_grid(rank: Column, cell_rows: int) -> Column:
    """Grid side for a token of this rank: that of the largest frequency that has it."""
    return grid_size(F.pow(F.lit(2.0), rank / F.lit(float(RANK_STEPS))), cell_rows)


def min_overlap(n, t: float):
    """``ceil(t * n)``: the least overlap a set of size n needs with any partner at ``J >= t``.

    Rounded so that floating error can only make it smaller (safe).
    """
    return F.ceil(n * F.lit(t) - F.lit(EPS))


def prefix_length(n, t: float, m: int = 1):
    """``n - ceil(t * n) + m``: the prefix that holds the first m shared tokens of any partner."""
    return F.least(n, n - min_overlap(n, t) + m)


def size_band(n: Column, t: float) -> Column:
    """Sets with ``J >= t`` have sizes in equal or adjacent bands."""
    width = -math.log(t) * (1 + EPS)
    return F.floor(F.log(n) / F.lit(width)) if width > EPS else n.cast("bigint")


def candidate_pairs(ordered: DataFrame, t: float, m: int = 3, cell_rows: int = DEFAULT_CELL_ROWS,
                    max_len_diff: float | None = None) -> DataFrame:
    """Distinct ``(a_sid, b_sid)`` sharing enough prefix tokens, a being the smaller set (or the shorter one).

    Extended prefix: if ``|A n B| = c >= alpha_A = ceil(t|A|)``, the first m
    shared tokens (in the global order) lie within the first
    ``|A| - alpha_A + m`` tokens of A, and likewise for B.  So with prefixes
    m - 1 tokens longer a pair must share ``min(m, max(alpha_A, alpha_B))``
    prefix tokens: barely more rows are joined, far fewer pairs survive.

    Positional filters (PPJoin): the first shared prefix token sits at
    positions ``(i, j)``; no earlier token of either set is shared (it would
    come first in the other prefix too), so ``|A n B| <= min(|A| - i, |B| - j)``.
    Likewise every shared token not counted in the prefixes comes after the
    last counted one (at ``(i', j')``), so ``|A n B| <= shared + min(|A| - i' - 1,
    |B| - j' - 1)``.  Pairs whose bound is below ``t / (1 + t) * (|A| + |B|)``
    cannot reach ``J >= t`` and are dropped before verification.

    ``max_len_diff`` needs sets that carry ``length``; the join key then holds
    the narrower of size and length bands, and the other filter is checked on
    each pair that meets.
    """
    n = F.size("ord")
    own = ["sid", "g_lo", "g_hi"] + (["length"] if max_len_diff is not None else [])
    by_length = max_len_diff is not None and 1 - max_len_diff > t
    band, by = (log_length_band("length", max_len_diff), "length") if by_length else (size_band(n, t), "n")
    pre = (ordered.select(*own, n.alias("n"), band.alias("_band"),
                          F.posexplode(F.slice("ord", 1, prefix_length(n, t, m).cast("int"))).alias("pos", "p"))
           .where(F.col("p.rank") > 0)
           .select(*own, "n", "_band", "pos", F.col("p.tok").alias("_key"), token_grid(F.col("p.rank"), cell_rows).alias("_grid")))
    keys = ["_key", "_band"]
    a = prefixed(pre, "a_", [*keys, "_grid"])
    b = pre.withColumn("_band", F.explode(F.array(F.col("_band"), F.col("_band") - 1)))
    b = prefixed(b, "b_", [*keys, "_grid"])
    j = grid_self_join(a, b, keys, "_grid", ["a_sid"], ["b_sid"])
    one, other = F.col("a_" + by), F.col("b_" + by)
    smaller = (one < other) | ((one == other) & (F.col("a_sid") < F.col("b_sid")))
    groups = F.least("a_g_lo", "b_g_lo") < F.greatest("a_g_hi", "b_g_hi")
    sizes = F.col("a_n") >= F.col("b_n") * F.lit(t) - F.lit(EPS)
    if by_length:
        sizes = sizes & (F.col("b_n") >= F.col("a_n") * F.lit(t) - F.lit(EPS))
    cond = smaller & groups & sizes
    if max_len_diff is not None:
        cond = cond & length_ratio_ok("a_length", "b_length", max_len_diff)
    pairs = (j.where(cond).groupBy("a_sid", "b_sid")
             .agg(F.min("a_pos").alias("i"), F.min("b_pos").alias("j"), F.max("a_pos").alias("il"),
                  F.max("b_pos").alias("jl"), F.first("a_n").alias("na"), F.first("b_n").alias("nb"),
                  F.count(F.lit(1)).alias("shared")))
    bound = F.least(F.col("na") - F.col("i"), F.col("nb") - F.col("j"),
                    F.col("shared") + F.least(F.col("na") - F.col("il") - 1, F.col("nb") - F.col("jl") - 1))
    need = (F.col("na") + F.col("nb")) * F.lit(t / (1 + t)) - F.lit(EPS)
    enough = F.col("shared") >= F.least(F.lit(m), F.greatest(min_overlap(F.col("na"), t), min_overlap(F.col("nb"), t)))
    return pairs.where((bound >= need) & enough).select("a_sid", "b_sid")


def screened(sets: DataFrame, t: float, cell_rows: int = BLOCK_ROWS, max_len_diff: float | None = None, strict: bool | None = True) -> DataFrame:
    """``a_sid, b_sid, jaccard`` of distinct sets above a high ``t`` (``strict`` None: all that are screened), a being the smaller set: see ``blocks``."""
    by_length = max_len_diff is not None and 1 - max_len_diff > t
    band = log_length_band("length", max_len_diff) if by_length else size_band(F.col("n"), t)
    rows = sets.where(F.col("length") > 0) if max_len_diff is not None else sets
    if "packed" in sets.columns:
        return exact_pairs(rows, band, t, 1, strict=strict, max_len_diff=max_len_diff, block_rows=cell_rows)
    return verified(screened_pairs(rows, band, t, 1, max_len_diff=max_len_diff, block_rows=cell_rows), sets, t, strict)


def counted_pairs(sets: DataFrame, t: float, strict: bool = True, cell_rows: int = BLOCK_ROWS, max_len_diff: float | None = None,
                  top: int = 0) -> DataFrame:
    """``a_sid, b_sid, jaccard`` of sets of integers above the threshold, counted in blocks; a is the smaller set.

    ``top``: those of the ``top`` best scores are enough.
    """
    by_length = max_len_diff is not None and 1 - max_len_diff > t
    band = log_length_band("length", max_len_diff) if by_length else size_band(F.col("n"), t)
    rows = sets.withColumn("_g", F.when(F.col("g_lo") == F.col("g_hi"), F.col("g_lo")))
    keep = ["sid", "_g"] + (["length"] if max_len_diff is not None else [])
    rows = packed_again(rows.where(F.col("length") > 0) if max_len_diff is not None else rows, keep)
    return met_among(rows, band, 1, cell_rows, "pairs", t, strict=strict, max_len_diff=max_len_diff, k=top)


def prepare(items_with_tokens: DataFrame, by_length: bool = False) -> tuple[DataFrame, DataFrame]:
    """Members (``sid, _g, dataset, id, length``) and their distinct sets.

    ``by_length``: sets are told apart by their members' length as well.  Both
    are cached lazily, as every step of a join reads them; nothing runs here, a
    lost block is computed again, and ``unpersist()`` or the session's
    ``catalog.clearCache()`` frees them.
    """
    keyed = with_set_id(items_with_tokens.select("_g", "dataset", "id", "length", "tokens")).withColumn("n_tokens", F.size("tokens"))
    if by_length:
        keyed = keyed.withColumn("sid", F.concat_ws(":", "sid", "length"))
    sets = distinct_sets(keyed, by=("length",) if by_length else ()).persist(StorageLevel.MEMORY_AND_DISK)
    return keyed.drop("tokens").persist(StorageLevel.MEMORY_AND_DISK), sets


def numbered(rows: DataFrame) -> bool:
    """Whether the rows' tokens are integers."""
    return rows.schema["tokens"].dataType.elementType.simpleString() in ("bigint", "int")


def packed_sets(items_with_tokens: DataFrame, by_length: bool = False) -> tuple[DataFrame, DataFrame]:
    """``prepare`` with sets that carry ``packed`` (``counted.packed``) for ``tokens``, if these are integers.

    Texts are read once: members and sets come from the packed rows, kept lazily on the executors' disks.
    """
    if not numbered(items_with_tokens):
        return prepare(items_with_tokens, by_length)
    rows = packed(items_with_tokens, ["_g", "dataset", "id", "length"], name=True)
    if by_length:
        rows = rows.withColumn("sid", F.concat_ws(":", "sid", "length"))
    rows = rows.persist(StorageLevel.DISK_ONLY)
    return rows.drop("packed").withColumnRenamed("n", "n_tokens"), distinct_packed(rows, ("length",) if by_length else ())


def distinct_packed(rows: DataFrame, by: tuple = ()) -> DataFrame:
    """``distinct_sets`` of packed rows, kept lazily on the executors' disks."""
    sets = rows.where(F.col("n") > 0).groupBy("sid", *by).agg(
        F.first("n").alias("n"), F.first("packed").alias("packed"), F.min("_g").alias("g_lo"), F.max("_g").alias("g_hi"))
    return sets.persist(StorageLevel.DISK_ONLY)


def verified(candidates: DataFrame, sets: DataFrame, t: float, strict: bool | None) -> DataFrame:
    """``a_sid, b_sid, jaccard`` of candidate pairs of sets that are above ``t`` (``strict`` None: of all)."""
    full = sets.select("sid", "tokens")
    v = candidates.join(prefixed(full, "a_", []), "a_sid").join(prefixed(full, "b_", []), "b_sid")
    v = v.select("a_sid", "b_sid", jaccard("a_tokens", "b_tokens").alias("jaccard"))
    return v if strict is None else v.where(F.col("jaccard") > F.lit(t)) if strict else v.where(F.col("jaccard") >= F.lit(t))


def set_pairs(sets: DataFrame, t: float, strict: bool = True, met: bool = False, top: int = 0, **grid) -> DataFrame:
    """``a_sid, b_sid, jaccard`` of distinct sets above the threshold, equal sets of several groups included.

    ``met``: also those below it that meet, where candidates are verified.  ``top``: those of the ``top`` best scores are enough.
    """
    if t < PARITY_FROM and ("packed" in sets.columns or numbered(sets)):
        v = counted_pairs(sets, t, strict, top=top, **grid)
    else:
        keep = None if met else strict
        v = screened(sets, t, strict=keep, **grid) if t >= PARITY_FROM else verified(candidate_pairs(ordered_tokens(sets), t, **grid), sets, t, keep)
    if strict and t >= 1:
        return v
    same = sets.where(F.col("g_lo") < F.col("g_hi")).select(F.col("sid").alias("a_sid"), F.col("sid").alias("b_sid"),
                                                            F.lit(1.0).alias("jaccard"))
    return v.unionByName(same)


def expand(pairs: DataFrame, members: DataFrame, score: str) -> DataFrame:
    """Pairs of sets -> pairs of their members in different groups, ``left`` being of the lesser group."""
    m = members.select("sid", "_g", "dataset", "id", "length")
    j = pairs.join(prefixed(m, "a_", []), "a_sid").join(prefixed(m, "b_", []), "b_sid")
    one_way = F.when(F.col("a_sid") == F.col("b_sid"), F.col("a__g") < F.col("b__g")).otherwise(F.col("a__g") != F.col("b__g"))
    return orient(j.where(one_way), ["dataset", "id", "length"], [F.col(score)])


def threshold_join(items_with_tokens: DataFrame, t: float = 0.9, strict: bool = True,
                   max_len_diff: float | None = None, **grid) -> DataFrame:
    """All pairs (a._g < b._g) with Jaccard > t (``strict``) or >= t, exactly.

    Output: ``left_dataset, left_id, left_length, right_dataset, right_id,
    right_length, jaccard``.  Rows that share an id stay rows of their own.
    """
    if not 0 < t <= 1:
        raise ValueError("threshold must be in (0, 1]")
    members, sets = packed_sets(items_with_tokens, max_len_diff is not None)
    return expand(set_pairs(sets, t, strict, max_len_diff=max_len_diff, **grid), members, "jaccard")


def sided_pairs(items_with_tokens: DataFrame, t: float, strict: bool = True, top: int = 0, mark=None) -> DataFrame:
    """``threshold_join`` of two collections (``collection.two_sides``): every left row against every right one, and none else.

    So its work grows with the product of the sides, not with the square of the
    larger.  ``top``: the ``top`` best pairs are among those returned, others may
    be left out.  ``mark`` adds ``marks`` to sets, and only pairs that agree in one are met.
    """
    rows = packed_items(items_with_tokens)
    sets = units(rows) if mark is None else mark(units(rows))
    left, right = (sets.where(F.col("_g") == g) for g in ("0", "1"))
    band, reach = (size_band(F.col("n"), t), 1) if t > EPS else (F.lit(0), 0)
    pairs = met_sides(left, right, band, reach, rows_of_block(rows), "pairs", t, strict=strict, k=top, marked=None if mark is None else "only")
    members = rows.select("sid", "_g", "dataset", "id", "length")
    if top:
        members = first_members(members, top, ["sid", "_g"])
    one, other = (members.where(F.col("_g") == g).drop("_g") for g in ("0", "1"))
    j = pairs.join(prefixed(one, "a_", []), "a_sid").join(prefixed(other, "b_", []), "b_sid")
    return j.select(*[F.col(s + c).alias(n + c) for s, n in (("a_", "left_"), ("b_", "right_")) for c in ("dataset", "id", "length")], "jaccard")


def first_members(rows: DataFrame, k: int, by: list[str]) -> DataFrame:
    """The k rows of least id per group of ``by``: Spark limits them before the shuffle."""
    w = Window.partitionBy(*by).orderBy("id", "dataset")
    return rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def set_members(members: DataFrame, sets: DataFrame) -> DataFrame:
    """``set_dataset, set_id`` (the set's first member), ``dataset, id, length`` for every row that has a token.

    ``members`` and ``sets`` as ``prepare`` gives them.  The first member is the one of
    least id, then dataset.  One row for each row, however many are alike.
    """
    first = _first_of_sets(members).select("sid", F.col("dataset").alias("set_dataset"), F.col("id").alias("set_id"))
    first = first.join(sets.select("sid"), "sid", "left_semi")  # the empty set is none of them
    return members.join(first, "sid").select("set_dataset", "set_id", "dataset", "id", "length")


def _first_of_sets(members: DataFrame) -> DataFrame:
    least = F.min(F.struct("id", F.col("_g").alias("g"), "dataset", "length"))
    return members.groupBy("sid").agg(least.alias("m")).select("sid", "m.dataset", "m.id", "m.length")


def member_pairs(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """``pairs`` (``a_sid, b_sid``) with ``a_rows, b_rows, n_pairs``: their rows, and the pairs of these across groups.

    Of all ``a_rows * b_rows`` those of one group are taken off, by counts per
    (set, group): no pair of members is made.
    """
    per = members.groupBy("sid", "_g").agg(F.count(F.lit(1)).alias("c"))
    rows = per.groupBy("sid").agg(F.sum("c").alias("rows"), F.sum(F.col("c") * F.col("c")).alias("own"))
    p = pairs.join(prefixed(rows, "a_", []), "a_sid").join(prefixed(rows, "b_", []), "b_sid")
    # Equal groups on both sides; within one set these are the squares already at hand.
    apart = pairs.where(F.col("a_sid") != F.col("b_sid")).select("a_sid", "b_sid")
    a, b = prefixed(per, "a_", ["_g"]), prefixed(per, "b_", ["_g"])
    both = (apart.join(a, "a_sid").join(b, ["b_sid", "_g"])
            .groupBy("a_sid", "b_sid").agg(F.sum(F.col("a_c") * F.col("b_c")).alias("both")))
    n = F.when(F.col("a_sid") == F.col("b_sid"), F.floor((F.col("a_rows") * F.col("a_rows") - F.col("a_own")) / 2))
    n = n.otherwise(F.col("a_rows") * F.col("b_rows") - F.coalesce("both", F.lit(0)))
    return p.join(both, ["a_sid", "b_sid"], "left").withColumn("n_pairs", n.cast("long")).drop("a_own", "b_own", "both")


def set_pair_table(items_with_tokens: DataFrame, t: float = 0.9, strict: bool = True, max_len_diff: float | None = None,
                   **grid) -> tuple[DataFrame, DataFrame]:
    """The threshold join as two tables, never expanded: pairs of distinct sets, and who their members are.

    Pairs: ``left_dataset, left_id, left_rows, right_dataset, right_id,
    right_rows, n_pairs, jaccard``, a set being named by its member of least id
    (then dataset) and the left one having the lesser name; ``n_pairs`` counts
    the pairs of rows across groups, and a set with members of several groups
    is paired with itself.  Members: see ``set_members``.
    """
    members, sets = packed_sets(items_with_tokens, max_len_diff is not None)
    # Kept lazily: the counts of members read the pairs twice.
    pairs = member_pairs(set_pairs(sets, t, strict, max_len_diff=max_len_diff, **grid).persist(StorageLevel.DISK_ONLY), members)
    first = _first_of_sets(members).select("sid", F.struct("id", "dataset", "length").alias("name"))
    p = pairs.join(prefixed(first, "a_", []), "a_sid").join(prefixed(first, "b_", []), "b_sid")
    ahead = F.col("a_name") <= F.col("b_name")
    out = []
    for side, (one, other) in (("left", ("a_", "b_")), ("right", ("b_", "a_"))):
        for c in ("name.dataset", "name.id", "rows"):
            out.append(F.when(ahead, F.col(one + c)).otherwise(F.col(other + c)).alias(f"{side}_{c.split('.')[-1]}"))
    return p.select(*out, "n_pairs", "jaccard"), set_members(members, sets)
