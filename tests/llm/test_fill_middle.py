"""Fill-in-the-middle against plain cutting and joining, and the exact way back."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kmerscope.llm import fill_middle as M

from . import brute


def plain(i, text, layout=M.Layout()):
    t = text or ""
    u = re.findall(r"[^\n]*\n|[^\n]+", t)
    x = hashlib.sha256(f"{layout.salt}{'' if i is None else i}".encode()).hexdigest()
    h = [int(x[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    p, m, s = ("".join(z) for z in (u[:a], u[a:b], u[b:]))
    if not t or any(k in t for k in (layout.prefix, layout.suffix, layout.middle)) or h[2] % 100 >= layout.fim_percent:
        return t, "plain", len(u), None, None
    if h[3] % 100 < layout.spm_percent:
        return f"{layout.suffix}{s}{layout.prefix}{p}{layout.middle}{m}", "spm", len(u), len(p), len(m)
    return f"{layout.prefix}{p}{layout.suffix}{s}{layout.middle}{m}", "psm", len(u), len(p), len(m)


def awkward():
    rng = random.Random(3)
    bits = ["a", "é", "😀", "\n", "\n", "<", "P>", "<P", ">", "\r\n", " ", "word", "<S>", "</M>"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 40))) for _ in range(300)]
    texts += [None, "", "\n", "\n\n\n", "no line end", "<P>", "a<M>\nb", "é" * 50_000 + "\n" + "b" * 2_000_000 + "\nc"]
    return texts + texts[:20]


@pytest.mark.parametrize("layout", [M.Layout(), M.Layout("<pre>", "<suf>", "<mid>", fim_percent=60, spm_percent=0, salt="x")])
@pytest.mark.parametrize("window", [1 << 20, 5])
def test_transform_and_restore(spark, monkeypatch, layout, window):
    texts = awkward()
    if window == 5:
        texts = [t for t in texts if len(t or "") < 1000]
        ids = list(range(len(texts)))
        monkeypatch.setattr(M, "WINDOW", window)
        df = spark.createDataFrame([(i,) for i in ids], "i long").select(*M.draws(F.col("i"), layout.salt))
        h = [c.to_numpy() for c in df.toArrow().columns]
        out = M.transform_batch(pa.array(texts, pa.string()), h, layout)
        assert [tuple(x.values()) for x in out.to_pylist()] == [plain(i, t, layout) for i, t in zip(ids, texts, strict=True)]
        assert M.restore_batch(out.field("output"), out.field("form"), layout).to_pylist() == [t or "" for t in texts]
        return
    rows = [(i if i % 50 else None, t, "s", *["x"] * len(brute.EXTRA)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, brute.DOCS).repartition(3)
    done = M.transformed(df, layout=layout)
    assert done.columns == [*df.columns, "fim"]
    got = done.select("doc_id", "text", "fim.*", M.restored(F.col("fim.output"), F.col("fim.form"), layout).alias("back")).collect()
    assert all(r.back == (r.text or "") for r in got)
    assert Counter((r.doc_id, r.output, r.form, r.n, r.prefix_chars, r.middle_chars) for r in got) == Counter(
        (r[0], *plain(r[0], r[1], layout)) for r in rows)


def test_empty_table_and_clashing_name(spark):
    df = spark.createDataFrame([], brute.DOCS).withColumn("fim", F.lit(1))
    out = M.transformed(df)
    assert out.columns == [*df.columns, "fim_"] and out.count() == 0


def test_sentinels_that_could_run_together_are_refused():
    for marks in (("P", "<S>", "<M>"), ("<P>", "<P>", "<M>"), ("<<P>", "<S>", "<M>"), ("<>", "<S>", "<M>")):
        with pytest.raises(ValueError):
            M.Layout(*marks)
