"""Plain Python versions of the operators, and small tables with every awkward case."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

from pyspark.sql import types as T

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
# Extra columns whose names clash with the operators' own.
EXTRA = ["row", "chunk", "keys", "id", "score", "label", "words", "size", "bucket", "copy", "a.b"]
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("source", T.StringType()), *[T.StructField(c, T.StringType()) for c in EXTRA]])


def texts(seed: int = 1, n: int = 40) -> list[str | None]:
    """Random texts, exact and near copies, shared passages, and texts that are null, empty, blank, short or long."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdeéñ", k=rng.randint(2, 7))) for _ in range(4000)]

    def words(k):
        return rng.choices(vocabulary, k=k)

    passage = words(60)
    out = []
    for i in range(n):
        w = words(rng.randint(5, 150))
        if i % 5 == 0:
            w[3:3] = passage
        out.append("\n".join(" ".join(w[j:j + 30]) for j in range(0, len(w), 30)))
    base = words(120)
    out += [" ".join(base)] * 4
    for edits in (1, 1, 2, 3, 6, 12, 30):
        w = list(base)
        for j in rng.sample(range(len(w)), edits):
            w[j] = rng.choice(vocabulary)
        out.append(" ".join(w).upper() if edits == 2 else " ".join(w))
    out += [None, "", " \n\t ", "one", "One two", "one two three", "x " * 400, " a  b", " ".join(words(20_000))]
    return out


def rows(seed: int = 1, n: int = 40) -> list[tuple]:
    """Documents with ids out of order, a repeated row, a null id and a null source."""
    t = texts(seed, n)
    ids = random.Random(seed + 1).sample(range(10, 10 + 3 * len(t)), len(t))
    extra = tuple("x" for _ in EXTRA)
    out = [(i, x, f"s{k % 3}", *extra) for k, (i, x) in enumerate(zip(ids, t, strict=True))]
    return [*out, out[0], out[0], (5, "an odd one", None, *extra), (None, "a text without an id of its own", "s1", *extra)]


def windows(docs, size: int = 35) -> list[tuple]:
    """(id, n_words, n_removed, sha256 of what is kept)."""
    ws = [(i, (t or "").encode().split()) for i, t in docs]
    seen = Counter(tuple(w[k:k + size]) for _, w in ws for k in range(len(w) - size + 1))
    out = []
    for i, w in ws:
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if seen[tuple(w[k:k + size])] > 1:
                gone[k:k + size] = [True] * size
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def earlier_strings(docs, size: int = 100) -> list[tuple]:
    """(id, n_bytes, n_removed, n_spans, sha256 of what is kept)."""
    seen, out = set(), []
    for i, t in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0, d[1] or "")):
        b = (t or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - size + 1):
            if b[k:k + size] in seen:
                gone[k:k + size] = [True] * size
            seen.add(b[k:k + size])
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return out


def shingles(text: str | None, k: int) -> set:
    w = (text or "").encode().translate(LOWER).split()
    return {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def linked(docs, k: int = 3, percent: int = 90) -> list[tuple]:
    """(id, n_shingles, component_id, n_links)."""
    sets = [shingles(t, k) for _, t in docs]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = Counter()
    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if both and 100 * both >= percent * (len(x) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    lowest = defaultdict(list)
    for i in range(len(sets)):
        if docs[i][0] is not None:
            lowest[find(i)].append(docs[i][0])
    return [(docs[i][0], len(s), min(lowest[find(i)], default=None), links[i]) for i, s in enumerate(sets)]
