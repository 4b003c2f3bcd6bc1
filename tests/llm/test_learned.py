"""Learned operators: held-out accuracy, counts against brute force, awkward inputs."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
import zstandard
from pyspark.sql import functions as F

from kmerscope.llm import maxent_lm, quality_zstd, texthash, toxicity
from kmerscope.llm.common import fold, quoted

from . import brute

LABELS = "doc_id long, quality int, toxic int, text string"


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 6))) for _ in range(500)]
    rows, labels = [], []
    for i in range(400):
        w = rng.choices(vocabulary, k=rng.randint(30, 120))
        toxic, good = int(i % 6 == 0), int(i % 4 != 0)
        if toxic:
            for _ in range(4):
                w.insert(rng.randrange(len(w)), rng.choice(["idiot", "you moron", "scum"]))
        text = " ".join(w) if good else " | ".join(x.upper() + "!!" for x in w)
        rows.append((i, text))
        labels.append((i, good, toxic, "x"))
    rows += [(1000, None), (1001, ""), (1002, "x" * 300_000), (1003, "word"), (0, rows[0][1]), (None, "no id")]
    labels += [labels[5], (None, 1, 1, "x"), (7777, 1, 0, "x"), (1003, None, None, "x")]
    docs = spark.createDataFrame([(i, t, "s", *["x"] * len(brute.EXTRA)) for i, t in rows], brute.DOCS).repartition(3)
    return docs, spark.createDataFrame(labels, LABELS), {r[0]: r for r in labels}, rows


def check(scored, truth, at, threshold, rows):
    got = scored.collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    assert all(r.score is not None and 0 <= r.score <= 1 for r in got)
    judged = [(r.score >= threshold) == bool(truth[r.doc_id][at]) for r in got if r.doc_id in truth and r.doc_id is not None and r.doc_id < 400]
    assert sum(judged) / len(judged) > 0.95


def test_quality(corpus):
    docs, labels, truth, rows = corpus
    learn = fold(quoted("doc_id"), 4) != 2
    model = quality_zstd.fit(docs, labels, learn)
    check(quality_zstd.score(docs, model), truth, 1, 0.7, rows)
    kept = quality_zstd.keep_good(docs, labels, learn)
    assert kept.columns == docs.columns and 250 < kept.count() < 320
    assert quality_zstd.score(docs.limit(0), model).count() == 0


def test_quality_scores_by_hand(corpus):
    """Each score, worked out text by text from the model's dictionaries and weights."""
    docs, labels, _, rows = corpus
    model = quality_zstd.fit(docs, labels, fold(quoted("doc_id"), 4) != 2)
    frame = {"write_content_size": False, "write_dict_id": False, "write_checksum": False}

    def by_hand(text):
        raw, total = text.encode(), 0.0
        for j in model.judges:
            sizes = []
            for d in (j.good, j.bad):
                c = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), **frame)
                sizes.append(sum(len(c.compress(raw[i:i + 1024])) for i in range(0, len(raw), 1024)))
            good, bad = sizes
            own = math.log(len(zstandard.ZstdCompressor(level=1, **frame).compress(raw)) / len(raw))
            d, n, with_good = 10 * (bad - good) / len(raw), math.log(len(raw)), math.log(good / len(raw))
            x = [1, d, abs(d), d * d, n, own, own * own, with_good, with_good ** 2, d * n, min(own, -2) + 2]
            z = sum((v - m) / s * w for v, m, s, w in zip(x, j.mean, j.scale, j.weights, strict=True))
            total += 1 / (1 + math.exp(-min(max(z, -30), 30)))
        return total / len(model.judges)

    got = {r.doc_id: r.score for r in quality_zstd.score(docs.where("doc_id % 23 = 0 OR doc_id > 1000"), model).collect()}
    texts = dict(reversed(rows))
    assert len(got) > 15 and all(got[i] == pytest.approx(by_hand(texts[i]) if texts[i] else 0.0, abs=1e-6) for i in got)


def test_toxicity(corpus):
    docs, labels, truth, rows = corpus
    model = toxicity.fit(docs, labels, fold(quoted("doc_id"), 5) != 0, trees=8)
    check(toxicity.score(docs, model), truth, 2, 0.5, rows)


@pytest.mark.parametrize("keep", ["none", "ones"])
def test_without_labels_or_with_one_class(corpus, keep):
    docs, labels, _, rows = corpus
    few = labels.limit(0) if keep == "none" else labels.where("quality = 1 AND toxic = 1")
    learn = F.lit(True)
    for scored in (quality_zstd.score(docs, quality_zstd.fit(docs, few, learn)), toxicity.score(docs, toxicity.fit(docs, few, learn))):
        got = scored.collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)


def test_labels_are_learned_only_from_their_folds(corpus):
    """Labels of rows that are held out change nothing."""
    docs, labels, _, _ = corpus
    learn = fold(quoted("doc_id"), 4) != 2
    turned = labels.withColumn("quality", F.when(fold(quoted("doc_id"), 4) == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, other = ({r.doc_id: r.score for r in quality_zstd.score(docs, quality_zstd.fit(docs, x, learn)).collect()} for x in (labels, turned))
    assert one == other


def test_language_model(corpus):
    docs, _, _, rows = corpus
    held_out = fold(quoted("doc_id"), 7) == 2
    got = maxent_lm.score(docs, ~held_out).withColumn("held_out", held_out).collect()
    held = {r.doc_id: r.held_out for r in got}
    tokens = [(i, [*(t or "").encode().translate(brute.LOWER).split(), None]) for i, t in rows]
    count = Counter(x for i, w in tokens if not held[i] for x in w)
    n, v = sum(count.values()), len(count)
    expected = Counter((i, len(w), sum(count[x] > 0 for x in w), n, round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), 6))
                       for i, w in tokens)
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == expected
    assert all(r.score <= 0 for r in got)
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_language_model_scores_by_hand(corpus, monkeypatch):
    """Each text's probability, worked out token by token from the weights, the classes and the training counts."""
    docs, _, _, rows = corpus
    held_out = fold(quoted("doc_id"), 7) == 2
    classes, weights = maxent_lm.train(docs, ~held_out)
    monkeypatch.setattr(maxent_lm, "train", lambda *_: (classes, weights))
    got = {r.doc_id: r.score for r in maxent_lm.score(docs, ~held_out).collect()}
    held = {r.doc_id: r.h for r in docs.select("doc_id", held_out.alias("h")).collect()}
    full, byte = (1 << 64) - 1, [int(x) for x in texthash._LOWER_BYTES]
    k = [int(x) for x in maxent_lm._K]

    def mixed(h):
        h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 & full
        h = (h ^ h >> 27) * 0x94D049BB133111EB & full
        return h ^ h >> 31

    def key(word):
        h = mixed(sum(byte[b] * pow(texthash._BASE, i, 1 << 64) for i, b in enumerate(word)) + len(word) & full)
        last = word.translate(brute.LOWER)[::-1][:3].ljust(3, b"\0")
        kind = mixed(last[0] << 16 | last[1] << 8 | last[2]) % maxent_lm.KINDS
        return h & ~31 & full | int(classes[kind])

    def tokens(text):
        return [*map(key, (text or "").encode().split()), int(maxent_lm._END)]

    count = Counter(t for i, text in rows if not held[i] for t in tokens(text))
    total, types = Counter(), Counter()
    for t, c in count.items():
        total[t & 31] += c
        types[t & 31] += 1

    def by_hand(text):
        before, out = [int(maxent_lm._BEFORE)] * 3, 0.0
        for t in tokens(text):
            one, two, three = before
            at = [one * k[0], one * k[1] + two * k[2], two * k[3], three * k[4], (one & 31) * k[5] + (two & 31) * k[6]]
            z = weights[-1].astype(float) + sum(weights[(a & full) >> 49].astype(float) for a in at)
            own = t & 31
            out += z[own] - math.log(sum(math.exp(x) for x in z))
            if own and total[own]:
                out += math.log((count[t] - 0.75 if count[t] else 0.75 * types[own]) / total[own])
            before = [t, one, two]
        return out / math.log(10)

    texts = dict(reversed(rows))
    some = [i for i in got if i is not None and (i % 40 == 7 or i in (1000, 1001, 1003))]
    assert len(some) > 10 and all(got[i] == pytest.approx(by_hand(texts[i]), rel=1e-4, abs=1e-4) for i in some)


def test_language_model_probabilities_add_up(spark):
    """Over all continuations of one history, known words and the unknown word share a probability of 1."""
    docs = spark.createDataFrame([(i, "a b a c", "s", *["x"] * len(brute.EXTRA)) for i in range(20)], brute.DOCS)
    ask = spark.createDataFrame([(100 + k, t, "s", *["x"] * len(brute.EXTRA)) for k, t in enumerate(["a", "b", "c", ""])], brute.DOCS)
    got = {r.doc_id: r for r in maxent_lm.score(docs.unionByName(ask), F.col("doc_id") < 100).collect()}
    assert all(math.isfinite(r.score) for r in got.values())
    assert 10 ** got[103].score + sum(10 ** got[100 + k].score for k in range(3)) <= 1


def test_language_model_of_nothing(corpus):
    docs, _, _, rows = corpus
    assert maxent_lm.score(docs.limit(0), F.lit(True)).count() == 0
    got = maxent_lm.score(docs, F.lit(False)).collect()
    assert len(got) == len(rows) and all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in got)
