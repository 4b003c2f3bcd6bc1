"""Quality classifier by compression (zstandard dictionaries of good and of bad text).

One dictionary is built from texts labelled good and one from texts labelled
bad.  Each text is compressed in segments with either dictionary; the
difference of the two sizes, normalised by the text's size, says which kind of
text it resembles.  A logistic calibration on held-back labelled texts turns
that difference, together with how compressible the text is on its own, into
the probability of label 1.

Defined results: null and empty texts score 0.0; repeated rows score alike;
with no labels, or labels of one class only, every other text scores the share
of label 1 (0.5 without labels).  Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import labelled_sample, quoted

SEGMENT = 1024
LEVEL = 3


@dataclass
class Judge:
    """Two dictionaries, and the calibration of their sizes' difference."""
    good: bytes
    bad: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray


@dataclass
class CompressionModel:
    """Judges whose probabilities are averaged; without any, all that is known is the share of label 1."""
    judges: list[Judge]
    prior: float


def _dictionary(texts: list[bytes], size: int) -> bytes:
    pieces = [t[i:i + 4 * SEGMENT] for t in texts for i in range(0, len(t), 4 * SEGMENT)]
    try:
        return zstandard.train_dictionary(size, pieces, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: their content itself is the dictionary
        return b"".join(pieces)[-size:]


class _Sizes:
    """Compressed sizes of texts under both dictionaries and under none."""

    def __init__(self, good: bytes, bad: bytes):
        frame = {"level": LEVEL, "write_content_size": False, "write_dict_id": False, "write_checksum": False}
        self.by = []
        for raw in (good, bad):
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=LEVEL)
            self.by.append(zstandard.ZstdCompressor(dict_data=d, **frame))
        self.plain = zstandard.ZstdCompressor(**(frame | {"level": 1}))

    def __call__(self, text: bytes | memoryview) -> tuple[int, int, int, int]:
        good, bad = self.by
        a = b = 0
        for i in range(0, len(text), SEGMENT):
            piece = text[i:i + SEGMENT]
            a += len(good.compress(piece))
            b += len(bad.compress(piece))
        return len(text), a, b, len(self.plain.compress(text))


def _inputs(sizes: np.ndarray) -> np.ndarray:
    """Calibration inputs: the normalised size difference, and how compressible the text is."""
    n, a, b, plain = np.maximum(sizes.astype(float), 1.0).T
    d, own, with_good = 10 * (b - a) / n, np.log(plain / n), np.log(a / n)
    return np.stack([np.ones_like(n), d, np.abs(d), d * d, np.log(n), own, own * own, with_good,
                     with_good * with_good, d * np.log(n), np.minimum(own, -2.0) + 2.0], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1, rounds: int = 40) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + ridge * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w -= np.linalg.solve(hess, grad)
    return w


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", per_class: int = 2500, max_bytes: int = 32_768,
        dictionary_bytes: int = 65_536) -> CompressionModel:
    """Build the dictionaries and the calibration from a bounded sample of labelled texts.

    The sample (``per_class`` texts of each class, each of at most
    ``max_bytes``) is all that comes to the driver.  Each half of it makes the
    dictionaries of one judge and the calibration of the other, so no judge is
    calibrated on texts that its dictionaries hold.
    """
    sample = labelled_sample(docs, labels, label_col, learn, id_col, text_col, per_class, max_bytes)
    rows = sorted(sample.rows.collect(), key=lambda r: r["id"]) if sample.both_classes else []
    texts = {(k, half): [r["text"].encode() for r in rows if r["text"] and r["label"] == k and (r["part"] < 0.5) == half]
             for k in (0, 1) for half in (True, False)}
    if not all(texts.values()):
        return CompressionModel([], sample.prior)
    judges = []
    for half in (True, False):
        good, bad = (_dictionary(texts[k, half], dictionary_bytes) for k in (1, 0))
        sizes = _Sizes(good, bad)
        held = [(sizes(t), k) for k in (0, 1) for t in texts[k, not half]]
        x, y = _inputs(np.array([s for s, _ in held])), np.array([k for _, k in held])
        mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        mean[0], scale[0] = 0, 1
        share = np.where(y == 1, sample.prior, 1 - sample.prior) / np.where(y == 1, y.mean(), 1 - y.mean())
        judges.append(Judge(good, bad, mean, scale, _logistic((x - mean) / scale, y, share)))
    return CompressionModel(judges, sample.prior)


def scorer(spark: SparkSession, model: CompressionModel):
    """A vectorised function: text column -> score column."""
    # Bounded by dictionary_bytes.  Plain data: a broadcast is unpickled where the package may not be on the path.
    shared = spark.sparkContext.broadcast(([(j.good, j.bad, j.mean, j.scale, j.weights) for j in model.judges], model.prior))

    @F.arrow_udf("double")
    def score_texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        plain, prior = shared.value
        judges = [(Judge(*j), _Sizes(j[0], j[1])) for j in plain]
        for texts in batches:
            # Views into the batch: no text is copied to a Python string.
            batch = [memoryview(t.as_buffer() or b"") for t in texts.cast(pa.large_binary())]
            p = np.zeros(len(batch)) if judges else np.full(len(batch), prior)
            for j, sizes in judges:
                s = np.array([sizes(t) for t in batch]).reshape(-1, 4)
                z = (_inputs(s) - j.mean) / j.scale @ j.weights
                p += 1 / (1 + np.exp(-np.clip(z, -30, 30))) / len(judges)
            yield pa.array(np.where([not len(t) for t in batch], 0.0, p), pa.float64())

    return score_texts


def score(docs: DataFrame, model: CompressionModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score`` for every row, by its whole text."""
    return docs.select(quoted(id_col), scorer(docs.sparkSession, model)(quoted(text_col)).alias("score"))


def keep_good(docs: DataFrame, labels: DataFrame, learn: Column, threshold: float = 0.7, id_col: str = "doc_id",
              text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` (all columns) whose score reaches ``threshold``."""
    model = fit(docs, labels, learn, id_col, text_col, **options)
    return docs.where(scorer(docs.sparkSession, model)(quoted(text_col)) >= threshold)
