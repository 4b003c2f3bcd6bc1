"""Hashed maximum-entropy language model with a class-factored softmax.

The probability of a token is that of its class, given the tokens before it,
times that of the token within its class:

* A word's class follows from its last three bytes, hashed to one of KINDS kinds.
  Kinds with like neighbours share a class: how often kinds stand within two words
  of each other is counted over all training texts, and the leading eigenvectors
  of the counts' association are clustered.  The end of a text is a class of its
  own.  P(class | history) is a softmax over weights of hashed features: the
  word before, the pair before, the words two and three back (skips), and the
  classes of the two before.
* P(token | class, history): the words of a class stand in a tree of LEVELS levels,
  four bits of a word's hash choosing one of a node's 16 parts.  The parts of a node
  are a softmax, its reference the parts' training tokens, over weights of hashed
  features: the node with the word before, and with the classes of the two before.
  Words in one leaf share its probability by their training counts.  An unknown word
  has the probability of the class's discounts.

Both kinds of weights are trained by distributed gradient updates.  The training texts are
dealt into rounds, each text in one.  In a round every task starts from the last
round's weights, takes gradient steps (Adagrad) over its texts, and sends what
changed; a feature's changes are averaged, weighted by how often each task saw
it.  Weights have a fixed size and are broadcast; counts of all tokens are
exchanged between chunks of texts and ranges of token hashes, never gathered.

Defined results: null and empty texts are one token, the end; with no training
texts all weights are 0 and every word is unknown; repeated rows score alike.
With no levels, P(token | class) is its training count, less the discount, over the
class's training tokens, whatever came before.
Tokens are told apart by 59 bits of a hash and their class.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import quoted
from .exchange import bucket_of, chunked, corpus_bytes
from .texthash import SPACE, Texts, Words, mix, words

CLASSES = 16
KINDS = 1024
PARTS = 16
ROWS = 1 << 15
TEMPLATES = 5
LEVELS = 3
WORD_ROWS = 1 << 16
WORD_PARTS = 32
WORD_TEMPLATES = (0, 4)  # of a token's histories
BATCH = 4096
DISCOUNT = 0.75
SLICE_BYTES = 1 << 20
TASK_BYTES = 32 << 20  # each task of a round sends its weights' changes
_END = np.uint64(0x5851F42D4C957F20)  # its low bits, the class, are 0
_BEFORE = np.uint64(0x14057B7EF767814F)
_K = np.random.default_rng(6).integers(1, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)


@dataclass
class _Tokens:
    """Tokens of a batch of texts, each text's end included; the low 5 bits of a key are the token's class."""
    keys: np.ndarray
    offsets: np.ndarray
    classes: np.ndarray


def _kinds(texts: Texts, w: Words) -> np.ndarray:
    """A kind for each word, by its last three bytes (those before a shorter word count as 0)."""
    first = np.repeat(texts.offsets[:-1], w.counts)
    key, inside = np.zeros(len(w.ends), np.uint64), np.ones(len(w.ends), bool)
    for k in (1, 2, 3):
        at = w.ends - k
        inside &= at >= first
        byte = texts.data[np.where(inside, at, 0)] if len(at) else np.zeros(0, np.uint8)
        inside &= ~SPACE[byte]
        key = key * np.uint64(256) + np.where(inside, _LOWER[byte], np.uint64(0))
    return (mix(key) % np.uint64(KINDS)).astype(np.int64)


def _tokens(texts: Texts, classes: np.ndarray) -> _Tokens:
    w = words(texts, lower=True)
    keys = (w.hashes & ~np.uint64(31)) | classes[_kinds(texts, w)].astype(np.uint64)
    keys = np.insert(keys, w.offsets[1:], _END)
    return _Tokens(keys, w.offsets + np.arange(len(w.offsets)), (keys & np.uint64(31)).astype(np.int64))


def _near(texts: Texts) -> np.ndarray:
    """How often two kinds stand one or two words apart in one text."""
    w = words(texts, lower=True)
    kinds, text = _kinds(texts, w), np.repeat(np.arange(len(texts)), w.counts)
    out = np.zeros(KINDS * KINDS, np.int64)
    for gap in (1, 2):
        same = text[gap:] == text[:-gap]
        out += np.bincount(kinds[:-gap][same] * KINDS + kinds[gap:][same], minlength=KINDS * KINDS)
    return out


def _clustered(near: np.ndarray, dimensions: int = 8, rounds: int = 30) -> np.ndarray:
    """A class from 1 to CLASSES - 1 for each kind."""
    near = (near + near.T).astype(float)
    seen = near.sum(axis=1)
    if not seen.any():
        return np.ones(KINDS, np.int64)
    association = np.log(np.maximum(near * seen.sum() / np.maximum(np.outer(seen, seen), 1), 1))
    weight = np.sqrt(seen / seen.sum())
    values, vectors = np.linalg.eigh(association * np.outer(weight, weight))
    lead = np.argsort(-values)[:dimensions]
    x = vectors[:, lead] * np.maximum(values[lead], 0) / np.maximum(weight, 1e-9)[:, None]
    centres = x[np.argsort(-seen, kind="stable")[:CLASSES - 1]].copy()
    for _ in range(rounds):
        own = ((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        for k in range(len(centres)):
            mine = own == k
            if seen[mine].any():
                centres[k] = np.average(x[mine], axis=0, weights=seen[mine])
    return own + 1


def _counted(texts: DataFrame, of, size: int) -> np.ndarray:
    """The sum of ``of`` (Texts to ``size`` counts) over all of ``text``.

    Tasks send their counts in PARTS rows; what comes to the driver is one
    table of ``size``, whatever the corpus.
    """
    schema = "part int, counts binary"

    def count(batches):
        out = np.zeros(size, np.int64)
        for batch in batches:
            for part in _slices(batch):
                out += of(Texts.of(part["text"]))
        rows = [{"part": k, "counts": zstandard.compress(x.tobytes(), 1)} for k, x in enumerate(np.split(out, PARTS)) if x.any()]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("part", pa.int32()), ("counts", pa.binary())]))

    def add(table: pa.Table) -> pa.Table:
        total = 0
        for x in table["counts"]:
            total = total + np.frombuffer(zstandard.decompress(x.as_py()), np.int64)
        return pa.table({"part": pa.array([table["part"][0].as_py()], pa.int32()), "counts": [zstandard.compress(total.tobytes(), 1)]})

    counts = np.zeros((PARTS, size // PARTS), np.int64)
    for r in texts.mapInArrow(count, schema).groupBy("part").applyInArrow(add, schema).collect():
        counts[r["part"]] = np.frombuffer(zstandard.decompress(r["counts"]), np.int64)
    return counts.ravel()


def learn_classes(texts: DataFrame) -> np.ndarray:
    """The class of each kind, from how kinds stand together in all of ``text``."""
    return _clustered(_counted(texts, _near, KINDS * KINDS).reshape(KINDS, KINDS))


def count_leaves(texts: DataFrame, classes: np.ndarray, levels: int = LEVELS) -> np.ndarray:
    """How many tokens of ``text`` each leaf of each class's tree has."""
    size = CLASSES << 4 * levels

    def leaves(part: Texts) -> np.ndarray:
        return np.bincount(_node(_tokens(part, classes).keys, levels), minlength=size)

    return _counted(texts, leaves, size)


def _node(keys: np.ndarray, level: int) -> np.ndarray:
    """The node that each token passes at a level of its class's tree (0: the root)."""
    own = (keys & np.uint64(31)).astype(np.int64) << 4 * level
    return own | (keys >> np.uint64(64 - 4 * level)).astype(np.int64) if level else own


def _references(leaves: np.ndarray, levels: int) -> list[np.ndarray]:
    """For each level, the logarithms of the tokens in each node's 16 parts (-1e4 for none)."""
    out = []
    for level in range(levels):
        parts = leaves.reshape(CLASSES << 4 * level, 16, -1).sum(axis=2)
        out.append(np.where(parts > 0, np.log(np.maximum(parts, 1)), -1e4).astype(np.float32))
    return out


def _histories(t: _Tokens) -> list[np.ndarray]:
    """Hashes of what stands before each token, TEMPLATES of them; their high bits are spread."""
    first = t.offsets[:-1]

    def back(x: np.ndarray) -> np.ndarray:
        y = np.empty_like(x)
        y[1:] = x[:-1]
        y[first] = _BEFORE
        return y

    one = back(t.keys)
    two = back(one)
    three = back(two)
    low = np.uint64(31)
    return [one * _K[0], one * _K[1] + two * _K[2], two * _K[3], three * _K[4], (one & low) * _K[5] + (two & low) * _K[6]]


def _features(histories: list[np.ndarray]) -> np.ndarray:
    """Weight rows of each token's features, TEMPLATES of them."""
    return np.stack([h >> np.uint64(64 - 15) for h in histories]).astype(np.uint16)


def _choices(t: _Tokens, histories: list[np.ndarray], references: list[np.ndarray], known: np.ndarray | None = None):
    """For each level of the words' trees: which tokens have a choice there, its node, the part taken and the features' weight rows."""
    for level, reference in enumerate(references):
        node = _node(t.keys, level)
        several = (reference > -1e4).sum(axis=1) > 1
        at = np.flatnonzero(several[node] if known is None else several[node] & known)
        node = node[at]
        part = (t.keys[at] >> np.uint64(60 - 4 * level) & np.uint64(15)).astype(np.int64)
        own = (node | level << 24).astype(np.uint64) * _K[7]
        rows = np.stack([h[at] + own >> np.uint64(64 - 16) for h in (histories[k] for k in WORD_TEMPLATES)]).astype(np.uint16)
        yield at, node, part, rows, reference


def _log_classes(rows: np.ndarray, bias: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Natural logarithm of each class's (or part's) probability, for each token; ``bias``: for all tokens or for each."""
    z = np.take(weights, rows[0], axis=0)
    z += bias
    for r in rows[1:]:
        z += np.take(weights, r, axis=0)
    z = np.ascontiguousarray(z.T)  # classes are few: sums over them go along whole rows of tokens
    z -= z.max(axis=0)
    z -= np.log(np.exp(z).sum(axis=0))
    return np.ascontiguousarray(z.T)


class _Trainer:
    """Gradient steps of one task, from the weights that all tasks start from."""

    def __init__(self, weights: np.ndarray, rate: float):
        self.start, self.w, self.rate = weights, weights.copy(), rate
        self.square = np.full(len(weights), 1.0, np.float32)
        self.seen = np.zeros(len(weights), np.float64)

    def learn(self, rows: np.ndarray, classes: np.ndarray, node: np.ndarray | None = None, reference: np.ndarray | None = None) -> None:
        """Steps towards ``classes``; with a ``reference`` for each node in place of the biases."""
        for a in range(0, rows.shape[1], BATCH):
            r, y = rows[:, a:a + BATCH], classes[a:a + BATCH]
            g = np.exp(_log_classes(r, self.w[-1] if reference is None else np.take(reference, node[a:a + BATCH], axis=0), self.w))
            g[np.arange(len(y)), y] -= 1
            flat = r.ravel()
            order = np.argsort(flat, kind="stable")
            by = flat[order]
            cut = np.concatenate([[0], np.flatnonzero(by[1:] != by[:-1]) + 1])
            count = np.diff(np.append(cut, len(by)))
            each, many = order % len(y), count > 1
            total = np.take(g, each[cut], axis=0)  # most rows are met once in a batch, the others are added up
            if many.any():
                again = np.take(g, each[np.repeat(many, count)], axis=0)
                total[many] = np.add.reduceat(again, np.cumsum(count[many]) - count[many], axis=0)
            self._step(by[cut].astype(np.int64), total, count)
            if reference is None:
                self._step(np.array([len(self.w) - 1]), g.sum(axis=0, keepdims=True), np.array([len(y)]))

    def _step(self, at: np.ndarray, total: np.ndarray, count: np.ndarray) -> None:
        g = total / np.sqrt(count)[:, None].astype(np.float32)
        square = np.take(self.square, at) + np.einsum("ij,ij->i", g, g) / g.shape[1]
        self.square[at] = square
        g *= (self.rate / np.sqrt(square))[:, None]
        self.w[at] = np.take(self.w, at, axis=0) - g
        self.seen[at] += count


def _slices(batch: pa.RecordBatch):
    """Parts of a batch of about SLICE_BYTES of text each."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE_BYTES)) + 1
        yield batch.slice(at, end - at)
        at = min(end, batch.num_rows)


def _sent(trainer: _Trainer, parts: int, first: int = 0):
    """Weights' changes, as half floats, and how often each was seen, in ``parts`` rows of bytes."""
    change = np.clip(trainer.w - trainer.start, -6e4, 6e4).astype(np.float16)
    for k, (d, n) in enumerate(zip(np.array_split(change, parts), np.array_split(trainer.seen, parts), strict=True)):
        if n.any():
            yield {"part": first + k, "change": d.tobytes(), "seen": n.astype(np.float32).tobytes()}


def _move(weights: np.ndarray, parts: int, changes: dict, first: int = 0) -> None:
    """Add the mean changes of one round to the weights."""
    for k, at in enumerate(np.array_split(np.arange(len(weights)), parts)):
        if first + k in changes:
            change, seen = changes[first + k]
            seen = np.frombuffer(seen, np.float64)
            weights[at] += np.frombuffer(change, np.float32).reshape(-1, CLASSES) / np.maximum(seen, 1)[:, None].astype(np.float32)


def _summed(table: pa.Table) -> pa.Table:
    """One part's changes, weighted by how often each task saw the row, and the counts, added up over the tasks."""
    change = seen = 0
    for c, n in zip(table["change"], table["seen"], strict=True):
        n = np.frombuffer(n.as_py(), np.float32).astype(np.float64)
        change = change + np.frombuffer(c.as_py(), np.float16).reshape(len(n), -1) * n[:, None]
        seen = seen + n
    return pa.table({"part": pa.array([table["part"][0].as_py()], pa.int32()),
                     "change": [change.astype(np.float32).tobytes()], "seen": [seen.tobytes()]})


@dataclass
class Model:
    """``classes`` of the kinds; ``weights``: ROWS of features and a last one of biases, each over CLASSES; ``leaves``:
    training tokens in each leaf of the classes' trees; ``word_weights``: WORD_ROWS of features over a node's 16 parts."""
    classes: np.ndarray
    weights: np.ndarray
    leaves: np.ndarray
    word_weights: np.ndarray


def train(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", rounds: int = 4,
          rate: float = 0.3) -> tuple[np.ndarray, np.ndarray]:
    """The kinds' classes and the weights of the softmax over classes alone."""
    model = train_words(docs, learn, id_col, text_col, rounds, rate, levels=0)
    return model.classes, model.weights


def train_words(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", rounds: int = 4,
                rate: float = 0.3, levels: int = LEVELS) -> Model:
    """The whole model: the softmax over classes and those within them.

    What comes to the driver each round is one set of weights, whatever the corpus.
    """
    spark = docs.sparkSession
    weights = np.zeros((ROWS + 1, CLASSES), np.float32)
    word_weights = np.zeros((WORD_ROWS if levels else 0, 16), np.float32)
    texts = docs.where(learn).select(quoted(text_col).alias("text"),
                                     F.pmod(F.xxhash64(quoted(id_col), F.lit(3)), F.lit(rounds)).alias("round"))
    texts = texts.coalesce(max(1, math.ceil(corpus_bytes(texts, "text") / TASK_BYTES)))
    classes = learn_classes(texts.select("text"))
    leaves = count_leaves(texts.select("text"), classes, levels) if levels else np.zeros(CLASSES, np.int64)
    references = spark.sparkContext.broadcast(_references(leaves, levels))
    for k in range(rounds):
        shared = spark.sparkContext.broadcast((weights, word_weights))

        def run(batches, shared=shared, rate=rate):
            trainer, within = (_Trainer(w, rate) for w in shared.value)
            for batch in batches:
                for part in _slices(batch):
                    t = _tokens(Texts.of(part["text"]), classes)
                    histories = _histories(t)
                    trainer.learn(_features(histories), t.classes)
                    for _, node, taken, rows, reference in _choices(t, histories, references.value):
                        within.learn(rows, taken, node, reference)
            rows = [*_sent(trainer, PARTS), *_sent(within, WORD_PARTS, PARTS)]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("part", pa.int32()), ("change", pa.binary()), ("seen", pa.binary())]))

        schema = "part int, change binary, seen binary"
        parts = (texts.where(F.col("round") == k).select("text").mapInArrow(run, schema)
                 .groupBy("part").applyInArrow(_summed, schema).collect())
        changes = {p["part"]: (p["change"], p["seen"]) for p in parts}
        _move(weights, PARTS, changes)
        _move(word_weights, WORD_PARTS, changes, PARTS)
        shared.unpersist()
    references.unpersist()
    return Model(classes, weights, leaves, word_weights)


_COUNTS = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_ANSWERS = pa.schema([("chunk", pa.int32()), ("bucket", pa.int32()), ("counts", pa.binary()), ("types", pa.list_(pa.int64())),
                      ("total", pa.list_(pa.int64()))])


def _count_table(chunk: int, keys: np.ndarray, learned: np.ndarray, n_buckets: int) -> pa.Table:
    """A chunk's distinct tokens and how often its training texts have each, by buckets of the key."""
    unique, back = np.unique(keys, return_inverse=True)
    counts = np.bincount(back, weights=learned, minlength=len(unique)).astype(np.uint32)
    b = bucket_of(unique, n_buckets)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(b)) + 1, [len(b)]]) if len(b) else np.zeros(1, np.int64)
    spans = list(zip(cuts[:-1], cuts[1:], strict=True))
    return pa.table({"bucket": b[cuts[:-1]], "chunk": np.full(len(spans), chunk, np.int32),
                     "keys": [unique[i:j].tobytes() for i, j in spans],
                     "counts": [counts[i:j].tobytes() for i, j in spans]}, _COUNTS)


def _add_up(table: pa.Table) -> pa.Table:
    """Answer each chunk with the corpus's counts of the tokens it sent; and, on one row, the bucket's classes' totals."""
    keys = [np.frombuffer(x, np.uint64) for x in table["keys"].to_pylist()]
    counts = np.concatenate([np.frombuffer(x, np.uint32) for x in table["counts"].to_pylist()])
    unique, back = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(back, weights=counts, minlength=len(unique)).astype(np.int64)
    kind = (unique & np.uint64(31)).astype(np.int64)
    wide = np.uint64 if len(total) and total.max() >= 1 << 32 else np.uint32
    answers = np.split(total[back].astype(wide), np.cumsum([len(k) for k in keys])[:-1])
    types = np.bincount(kind, weights=total > 0, minlength=CLASSES).astype(np.int64).tolist()
    sums = np.bincount(kind, weights=total, minlength=CLASSES).astype(np.int64).tolist()
    n = len(keys)
    return pa.table({"chunk": table["chunk"], "bucket": table["bucket"], "counts": [a.tobytes() for a in answers],
                     "types": [types] + [None] * (n - 1), "total": [sums] + [None] * (n - 1)}, _ANSWERS)


def _told(unique: np.ndarray, n_buckets: int, answers: pa.Table) -> np.ndarray:
    """The corpus's count of each of a chunk's distinct tokens."""
    out = np.zeros(len(unique), np.int64)
    b = bucket_of(unique, n_buckets)
    for bucket, raw in zip(answers["bucket"].to_pylist(), answers["counts"].to_pylist(), strict=True):
        i, j = np.searchsorted(b, [bucket, bucket + 1])
        out[i:j] = np.frombuffer(raw, np.uint32 if len(raw) == 4 * (j - i) else np.uint64)
    return out


def score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", rounds: int = 4,
          levels: int = 0) -> DataFrame:
    """``id_col, n_tokens, n_known, train_tokens, base_score, score`` for every row, whole texts.

    ``base_score``: the sum over tokens of log10((c + 1) / (N + V + 1)) with
    the training texts' counts; ``score``: the model's log10 probability.
    ``levels``: of the trees of words within classes (LEVELS is the whole
    model; 0 leaves the words of a class to their counts).
    """
    if levels:
        learned = train_words(docs, learn, id_col, text_col, rounds, levels=levels)
    else:
        learned = Model(*train(docs, learn, id_col, text_col, rounds), np.zeros(CLASSES, np.int64), np.zeros((0, 16), np.float32))
    classes = learned.classes
    shared = docs.sparkSession.sparkContext.broadcast(
        (learned.weights, learned.word_weights, learned.leaves, _references(learned.leaves, levels)))
    flagged = docs.select(quoted(id_col), quoted(text_col), learn.alias("_learn"))
    chunks = chunked(flagged, id_col, text_col, [id_col, "_learn"])
    n_buckets = chunks.buckets(1 / 25)
    n_chunks = chunks.n_chunks

    def send(table: pa.Table) -> pa.Table:
        t = _tokens(Texts.of(table["text"]), classes)
        own = pc.struct_field(table["row"], [1]).to_numpy().astype(bool)
        return _count_table(table["chunk"][0].as_py(), t.keys, np.repeat(own, np.diff(t.offsets)), n_buckets)

    groups = chunks.rows.groupBy("chunk")
    answers = (groups.applyInArrow(send, "bucket int, chunk int, keys binary, counts binary").groupBy("bucket")
               .applyInArrow(_add_up, "chunk int, bucket int, counts binary, types array<long>, total array<long>"))
    # The classes' totals go to every chunk as a row of bucket -1.
    per_class = [F.sum(F.coalesce(F.col(c)[k], F.lit(0))).cast("long") for c in ("types", "total") for k in range(CLASSES)]
    totals = answers.agg(F.array(*per_class[:CLASSES]).alias("types"), F.array(*per_class[CLASSES:]).alias("total"))
    totals = totals.select(F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))).alias("chunk"), F.lit(-1).alias("bucket"),
                           F.lit(None).cast("binary").alias("counts"), "types", "total")
    answers = answers.withColumn("types", F.lit(None).cast("array<long>")).withColumn(
        "total", F.lit(None).cast("array<long>")).unionByName(totals)

    def finish(table: pa.Table, told: pa.Table) -> pa.Table:
        t = _tokens(Texts.of(table["text"]), classes)
        whole = told.filter(pc.equal(told["bucket"], -1)).to_pylist()
        types, total = (np.array(whole[0][c], np.float64) for c in ("types", "total")) if whole and len(table) else np.zeros((2, CLASSES))
        n, v = int(total.sum()), int(types.sum())
        unique, back = np.unique(t.keys, return_inverse=True)
        count = _told(unique, n_buckets, told.filter(pc.greater_equal(told["bucket"], 0)))[back]
        base = np.log10((count + 1) / (n + v + 1))
        # Within its class: unknown words have the discounts' sum, or all of a class without training tokens.
        own = t.classes
        known = (count > 0) & (own > 0)
        of_class = np.maximum(total[own], 1)
        unknown = np.where(total[own] > 0, DISCOUNT * types[own] / of_class, 1.0)
        w, word_w, leaves, references = shared.value
        if levels:  # the known ones the rest: the words of a leaf by their counts, the leaves by the parts taken
            within = (1 - unknown) * count / np.maximum(leaves[_node(t.keys, levels)], 1)
        else:
            within = (count - DISCOUNT) / of_class
        model = np.log10(np.where(own == 0, 1.0, np.where(known, within, unknown)))
        histories = _histories(t) if len(own) else [t.keys] * TEMPLATES
        rows = _features(histories)
        for a in range(0, len(own), BATCH):
            z = _log_classes(rows[:, a:a + BATCH], w[-1], w)
            model[a:a + BATCH] += z[np.arange(len(z)), own[a:a + BATCH]] / np.log(10)
        for at, node, taken, rows, reference in _choices(t, histories, references, known):
            for a in range(0, len(at), BATCH):
                z = _log_classes(rows[:, a:a + BATCH], np.take(reference, node[a:a + BATCH], axis=0), word_w)
                model[at[a:a + BATCH]] += z[np.arange(len(z)), taken[a:a + BATCH]] / np.log(10)
        first = t.offsets[:-1]

        def each(x: np.ndarray) -> np.ndarray:
            return np.add.reduceat(x, first) if len(first) else x[:0]

        return pa.table({
            "id": pc.struct_field(table["row"], [0]), "n_tokens": np.diff(t.offsets).astype(np.int64),
            "n_known": each((count > 0).astype(np.int64)), "train_tokens": np.full(len(first), n, np.int64),
            "base_score": each(base), "score": each(model)})

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return groups.cogroup(answers.groupBy("chunk")).applyInArrow(finish, schema).withColumnRenamed("id", id_col)
