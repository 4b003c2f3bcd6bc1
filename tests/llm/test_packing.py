"""Packing: ids against the tokenizer itself, the plan against best fit one piece at a time, slots without gaps or overlaps."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kmerscope.llm import packing as M

from . import brute

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as f:
        return M.Encoder(f.read())


BITS = [" ", " ", "  ", "   ", "\n", "\t", "\xa0", "\x1c", "　", "\x85", "a", "b1", "'s", "'", "!", "é", "😀", "​", "<|endoftext|>", "x" * 70,
        "١", "_", "\r\n", "word", ".", "²"]


@pytest.mark.parametrize("fast", [True, False])
def test_ids_are_the_tokenizers(tokenizer, encoder, monkeypatch, fast):
    if not fast:
        monkeypatch.setattr(encoder, "merge", None)
    rng = random.Random(5)
    for _ in range(300):
        texts = [None if rng.random() < 0.05 else "".join(rng.choices(BITS, k=rng.randint(0, 12))) for _ in range(rng.randint(0, 30))]
        ids, at = encoder(pa.array([" b  c", *texts], pa.string()).slice(1))
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == [
            tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=5))
def test_ids_of_any_text(texts):
    tokenizer = Tokenizer.from_file(PATH)
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    ids, at = _any_encoder()(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def _any_encoder(made=[]):  # noqa: B006
    if not made:
        with open(PATH, encoding="utf-8") as f:
            made.append(M.Encoder(f.read()))
    return made[0]


def best_fit(counts: dict[int, int], capacity: int) -> int:
    room = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            best = min(((free, i) for i, free in enumerate(room) if free >= length), default=None)
            if best:
                room[best[1]] -= length
            else:
                room.append(capacity - length)
    return len(room)


def test_plan_is_best_fit(capacity=20):
    rng = random.Random(6)
    for _ in range(200):
        counts = {k: rng.randint(0, rng.choice([2, 40])) for k in rng.sample(range(1, capacity + 1), rng.randint(1, capacity))}
        slots, filled = M.plan(counts, capacity), defaultdict(list)
        for length in counts:
            ranks = []
            for of, a, b, first, per, offset in slots:
                for r in range(a, b) if of == length else ():
                    ranks.append(r)
                    filled[first + (r - a) // per].append((offset + (r - a) % per * length, length))
            assert sorted(ranks) == list(range(counts[length]))
        check_sequences(filled, capacity)
        assert len(filled) == best_fit(counts, capacity)


def check_sequences(filled, capacity):
    for held in filled.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity


def test_plan_size_depends_on_the_capacity_only():
    rng = random.Random(7)
    counts = {k: rng.randint(1, 1000) for k in range(1, 1025)}
    many = {k: c * 1_000_003 for k, c in counts.items()}
    assert len(M.plan(many)) < 20_000
    assert M.plan({}) == [] and M.plan({3: 0}) == []


@pytest.mark.parametrize("capacity", [1024, 32])
def test_pack(spark, tokenizer, capacity):
    rows = brute.rows()
    docs = spark.createDataFrame(rows, brute.DOCS).repartition(5)
    placed = M.pack(docs, PATH, capacity=capacity, with_ids=True)
    got = placed.collect()
    expected, total = Counter(), 0
    for r in rows:
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 2]
        total += len(ids)
        first = (len(ids) - 1) % capacity + 1
        bounds = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
            expected[r[0], k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()), tuple(ids[a:b])] += 1
    assert Counter((r.id, r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in got) == expected
    filled = defaultdict(list)
    for r in got:
        filled[r.sequence_id].append((r.offset, r.length))
    check_sequences(filled, capacity)
    assert len(filled) == best_fit(Counter(r.length for r in got), capacity)
    assert len(filled) >= -(-total // capacity)
    whole = {r.sequence_id: r for r in M.sequences(placed).collect()}
    for r in got:
        seq = whole[r.sequence_id]
        assert seq.ids[r.offset:r.offset + r.length] == r.ids and r.offset in seq.starts
    assert sum(len(s.ids) for s in whole.values()) == total


def test_pack_nothing(spark):
    assert M.pack(spark.createDataFrame([], brute.DOCS), PATH).count() == 0
