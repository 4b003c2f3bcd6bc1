"""Toxicity classifier: gradient-boosted trees over dense features, calibrated by isotonic regression.

Per text: densities of a fixed lexicon of insults and of a lexicon learned from
the labels (words and word beginnings), how near insults stand to the second
person, capitals, punctuation, and words written to hide an insult ("id1ot").
The lexicon and the trees (Spark ML) are fitted on four fifths of a bounded
labelled sample, the isotonic calibration on the rest.

Defined results: null and empty texts have features of zero and are scored like
any other; repeated rows score alike; with no labels, or labels of one class
only, every text scores the share of label 1 (0.0 without labels).  Other
columns of the input are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import labelled_sample, materialise, quoted

INSULTS = frozenset("""
    idiot idiots moron morons imbecile stupid dumb dumbass loser losers scum trash garbage filth vermin pathetic
    worthless disgusting clown clowns fool fools jerk freak pig pigs rat coward liar ugly hate hateful kill die
    idiota imbécil estúpido estúpida basura asqueroso tonto inútil payaso cerdo
    idiote crétin débile stupide imbécile ordure minable dégoûtant nul clochard
    dumm dummkopf blöd blödmann trottel abschaum erbärmlich wertlos ekelhaft versager schwein
""".split())
SECOND_PERSON = frozenset("""
    you your yours yourself u ur du dich dir dein deine euch tu te toi ton ta tes vous votre vos tú ti tus usted ustedes
""".split())
TOKEN = re.compile(r"\w+")
# Only from the start of a run of letters, and without going back: linear in a text without white space too.
HIDDEN = re.compile(r"(?<![^\W\d_])[^\W\d_]++[0-9@$*!.]++[^\W\d_]+")
UNHIDE = str.maketrans("013457@$!", "oieastasi", "*.")
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
DIGITS = b"0123456789"
NEAR = 5
PREFIXES = range(3, 8)
CACHE = 200_000


class _Weights(dict):
    """Token -> its learned weight: the largest of those of the word and its beginnings, 0.0 if none is known."""

    def __init__(self, learned: dict[str, float]):
        super().__init__()
        self.learned = learned

    def __missing__(self, token: str) -> float:
        if len(self) > CACHE:  # only a memory of answers: dropping it costs time, not results
            self.clear()
        found = [self.learned[k] for k in _keys(token) if k in self.learned]
        self[token] = w = max(found, default=0.0)
        return w


def _keys(token: str) -> list[str]:
    return [token, *(token[:k] + "-" for k in PREFIXES if k < len(token))]


def _features(text: str, learned: _Weights) -> list[float]:
    raw = text.encode()
    low = text.lower()
    tokens = TOKEN.findall(low)
    n, size = max(1, len(tokens)), max(1, len(raw))
    at = [i for i, t in enumerate(tokens) if t in INSULTS]
    near = 0
    for i in at:
        near += any(t in SECOND_PERSON for t in tokens[max(0, i - NEAR):i + NEAR + 1])
    hidden = HIDDEN.findall(low)
    unmasked = sum(1 for t in hidden if t.translate(UNHIDE) in INSULTS)
    weights = [w for w in map(learned.__getitem__, tokens) if w]
    strong = sum(1 for w in weights if w >= 3.0)
    upper = size - len(raw.translate(None, UPPER))
    symbols = size - len(raw.translate(None, SYMBOLS))
    return [
        math.log(n), len(at), len(at) / n, near, near / n,
        len(weights), len(weights) / n, sum(weights), sum(weights) / n, strong, strong / n, max(weights, default=0.0),
        len({t for t in tokens if learned[t] >= 3.0}),
        unmasked, len(hidden) / n, upper / size, symbols / size, raw.count(b"!") / n, raw.count(b"?") / n,
        (size - len(raw.translate(None, DIGITS))) / size,
    ]


def _feature_function(spark: SparkSession, learned: dict[str, float]):
    shared = spark.sparkContext.broadcast(learned)  # at most max_terms entries

    @F.pandas_udf("array<double>")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights = _Weights(shared.value)
        for batch in batches:
            yield pd.Series([_features(t or "", weights) for t in batch], dtype=object)

    return features


def learn_lexicon(rows: DataFrame, max_terms: int = 400, least_docs: int = 4, least_odds: float = 1.5) -> dict[str, float]:
    """Words and word beginnings that mark label 1, with their log-odds: the ``max_terms`` with the largest G statistic."""

    def count(batches):
        by = {0: Counter(), 1: Counter()}
        for pdf in batches:
            for text, y in zip(pdf["text"], pdf["label"], strict=True):
                by[y].update({k for t in set(TOKEN.findall(text.lower())) for k in _keys(t)})
        keys = [k for k in by[1] if k not in by[0]] + list(by[0])
        yield pd.DataFrame({"key": pd.Series(keys, dtype=object), "n1": [by[1][k] for k in keys], "n0": [by[0][k] for k in keys]})

    total = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    t1, t0 = total.get(1, 0), total.get(0, 0)
    if not t1 or not t0:
        return {}
    p1 = (F.col("n1") + 0.5) / F.lit(t1 + 1.0)
    p0 = (F.col("n0") + 0.5) / F.lit(t0 + 1.0)
    top = (rows.select("text", "label").mapInPandas(count, "key string, n1 long, n0 long")
           .groupBy("key").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
           .where(F.col("n1") >= least_docs)
           .select("key", F.log(p1 / p0).alias("odds"), (F.col("n1") * F.log(p1 / p0)).alias("gain"))
           .where(F.col("odds") >= least_odds)
           .orderBy(F.desc("gain"), "key").limit(max_terms))
    return {r["key"]: r["odds"] for r in top.collect()}


@dataclass
class ToxicityModel:
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    prior: float
    learned: dict[str, float] = field(default_factory=dict)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", per_class: int = 5000, max_bytes: int = 32_768, trees: int = 30, depth: int = 4) -> ToxicityModel:
    """Fit on a bounded sample: ``per_class`` labelled texts of each class, each of at most ``max_bytes``."""
    spark = docs.sparkSession
    sample = labelled_sample(docs, labels, label_col, learn, id_col, text_col, per_class, max_bytes)
    prior = sample.prior if sample.counts else 0.0
    if not sample.both_classes:
        return ToxicityModel(None, None, prior)
    rows = materialise(sample.rows, "toxicity-sample")
    part = F.col("part")
    halves = [rows.where(part < 0.4), rows.where((part >= 0.4) & (part < 0.8))]
    learned = learn_lexicon(halves[0].unionByName(halves[1]))
    # The trees learn from features by the other half's lexicon, so that no text's words are known from its own label.
    by = [(halves[0], learn_lexicon(halves[1])), (halves[1], learn_lexicon(halves[0])), (rows.where(part >= 0.8), learned)]
    featured = [texts.select(F.col("label").cast("double").alias("label"), "weight", "part",
                             _feature_function(spark, lexicon)("text").alias("features")) for texts, lexicon in by]
    rest = materialise(featured[0].unionByName(featured[1]).unionByName(featured[2]), "toxicity-features")
    ready = rest.withColumn("features", array_to_vector("features")).coalesce(4)
    train, held = ready.where(F.col("part") < 0.8), ready.where(F.col("part") >= 0.8)
    if train.select("label").distinct().count() < 2 or held.select("label").distinct().count() < 2:
        return ToxicityModel(None, None, prior, learned)
    model = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=trees, maxDepth=depth,
                          stepSize=0.2, minInstancesPerNode=5, seed=5).fit(train)
    margin = _margin(model.transform(held)).select("margin", "label", "weight")
    iso = IsotonicRegression(featuresCol="margin", labelCol="label", weightCol="weight").fit(margin)
    return ToxicityModel(model, iso, prior, learned)


def _margin(scored: DataFrame) -> DataFrame:
    return scored.withColumn("margin", vector_to_array("rawPrediction")[1])


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score`` for every row, by its whole text."""
    if model.trees is None:
        return docs.select(quoted(id_col), F.lit(float(model.prior)).alias("score"))
    features = _feature_function(docs.sparkSession, model.learned)
    ready = docs.select(quoted(id_col).alias("id"), array_to_vector(features(quoted(text_col))).alias("features"))
    scored = model.calibration.transform(_margin(model.trees.transform(ready)).select("id", "margin"))
    return scored.select(quoted("id").alias(id_col),
                         F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("prediction"))).alias("score"))
