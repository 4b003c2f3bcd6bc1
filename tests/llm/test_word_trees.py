"""The language model's softmax over the words of a class: by hand, summing to one, and told by what came before."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kmerscope.llm import maxent_lm, queries
from kmerscope.llm.texthash import Texts

from . import brute


def _rows(n=240):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcdef", k=rng.randint(1, 4))) for _ in range(300)]
    return [(i, " ".join(rng.choices(vocabulary, k=rng.randint(5, 40)))) for i in range(n)] + [(900, None), (901, ""), (902, "NEVER seen"), (None, "a b")]


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, "s", *["x"] * len(brute.EXTRA)) for i, t in rows], brute.DOCS)


def _probability(model, count, total, types, token, before):
    """P(token | before), all levels worked out one by one; an unknown word is (0, its class)."""
    k, full = [int(x) for x in maxent_lm._K], (1 << 64) - 1
    one, two, three = before
    history = [one * k[0], one * k[1] + two * k[2], two * k[3], three * k[4], (one & 31) * k[5] + (two & 31) * k[6]]
    z = model.weights[-1].astype(float) + sum(model.weights[(h & full) >> 49].astype(float) for h in history)
    own = token[1] if isinstance(token, tuple) else token & 31
    p = math.exp(z[own]) / np.exp(z).sum()
    if own == 0:
        return p
    unknown = 0.75 * types[own] / total[own] if total[own] else 1.0
    if isinstance(token, tuple) or not count[token]:
        return p * unknown
    p *= 1 - unknown
    for level in range(3):
        node = own << 4 * level | (token >> 64 - 4 * level if level else 0)
        below = [sum(c for t, c in count.items() if t & 31 == own and t >> 60 - 4 * level == ((token >> 64 - 4 * level if level else 0) << 4 | part))
                 for part in range(16)]
        extra = sum(model.word_weights[(history[j] + (node | level << 24) * k[7] & full) >> 48].astype(float) for j in (0, 4))
        weight = [b * math.exp(x) for b, x in zip(below, extra, strict=True)]
        p *= weight[token >> 60 - 4 * level & 15] / sum(weight)
    return p * count[token] / sum(c for t, c in count.items() if t & 31 == own and t >> 52 == token >> 52)


@pytest.fixture(scope="module")
def learned(spark):
    rows = _rows()
    docs, learn = _frame(spark, rows).repartition(3), F.coalesce(F.col("doc_id") % 3 != 0, F.lit(False)) & (F.col("doc_id") < 900)
    model = maxent_lm.train_words(docs, learn)

    def tokens(text):
        return [int(x) for x in maxent_lm._tokens(Texts.of(pa.array([text])), model.classes).keys]

    count = Counter(t for i, text in rows if i is not None and i < 900 and i % 3 for t in tokens(text))
    total, types = Counter(), Counter()
    for t, c in count.items():
        total[t & 31] += c
        types[t & 31] += 1
    return rows, docs, learn, model, tokens, (model, count, total, types)


def test_scores_by_hand(learned, monkeypatch):
    rows, docs, learn, model, tokens, known = learned
    monkeypatch.setattr(maxent_lm, "train_words", lambda *_, **__: model)
    got = {r.doc_id: r.score for r in maxent_lm.score(docs, learn, levels=3).collect()}
    assert len(got) == len(rows) and np.abs(model.word_weights).max() > 0.01

    def by_hand(text):
        before, out = [int(maxent_lm._BEFORE)] * 3, 0.0
        for t in tokens(text):
            out += math.log10(_probability(*known, t, before))
            before = [t, *before[:2]]
        return out

    some = [(i, t) for i, t in rows if i is None or i % 20 == 7 or i >= 900]
    assert all(got[i] == pytest.approx(by_hand(t), rel=1e-4, abs=1e-4) for i, t in some)


def test_probabilities_add_up(learned):
    """All known tokens and each class's unknown word share a probability of 1 after any history."""
    _, _, _, model, tokens, known = learned
    count = known[1]
    for before in ([int(maxent_lm._BEFORE)] * 3, tokens("a cab fed")[:3]):
        every = [*count, *[(0, k) for k in range(1, maxent_lm.CLASSES)]]
        assert sum(_probability(*known, t, before) for t in every) == pytest.approx(1, abs=1e-4)


def test_words_of_one_class_follow_their_history(spark, tmp_path):
    """Words alike in class and count: the query tells which one stood after the word before."""
    pairs = [("red", "carting"), ("dim", "lasting"), ("odd", "meeting"), ("sly", "nesting")]
    rng = random.Random(2)
    rows = [(i, " ".join(" ".join(rng.choice(pairs)) for _ in range(30))) for i in range(600)]
    ask = [(10_000 + 10 * a + b, f"{x} {y}") for a, (x, _) in enumerate(pairs) for b, (_, y) in enumerate(pairs)]
    _frame(spark, rows + ask).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.score for r in queries.op2_maxent_lm(spark, str(tmp_path)).collect()}
    for a in range(4):
        own = got[10_000 + 10 * a + a]
        assert all(own > got[10_000 + 10 * a + b] + 0.5 for b in range(4) if b != a)


def test_without_training_texts(learned):
    rows, docs, _, _, _, _ = learned
    assert maxent_lm.score(docs.limit(0), F.lit(True), levels=3).count() == 0
    got = maxent_lm.score(docs, F.lit(False), levels=3).collect()
    assert len(got) == len(rows) and all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in got)
