"""The pipeline over small tables: stages' decisions against brute force, columns, clean documents kept."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from kmerscope.llm.common import materialise

from . import brute

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = materialise(stage(spark, docs, SF), name)
        out.append((name, docs.toPandas(), after.toPandas()))
        docs = after
    return {name: (before, after) for name, before, after in out}


def test_columns(steps):
    names = list(steps)
    assert names == ["quality", "near_duplicates", "repeated_passages", "benchmark_leaks", "source_mix"]
    first = list(steps[names[0]][0].columns)
    assert all(list(steps[n][1].columns) == first for n in names[:-1])
    assert list(steps[names[-1]][1].columns) == [*first, "copy"]


def test_quality_keeps_good_documents(spark, steps):
    before, after = steps["quality"]
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id").quality
    kept = set(after.doc_id)
    good = [i for i in before.doc_id if labels.get(i) == 1]
    bad = [i for i in before.doc_id if labels.get(i) == 0]
    assert sum(i in kept for i in good) >= 0.95 * len(good) and sum(i in kept for i in bad) <= 0.4 * len(bad)


def test_near_duplicates(steps):
    before, after = steps["near_duplicates"]
    docs = list(zip(before.doc_id, before.text, strict=True))
    assert set(after.doc_id) == {c if n else i for i, n, c, _ in brute.linked(docs, 5, 80)}


def test_repeated_passages(steps):
    before, after = steps["repeated_passages"]
    text = dict(zip(after.doc_id, after.text, strict=True))
    for (i, n, gone, _), old in zip(brute.windows(list(zip(before.doc_id, before.text, strict=True))), before.text, strict=True):
        assert (i in text) == (gone == 0 or gone < n)
        if i in text:
            assert (text[i] == old) == (gone == 0) and len(text[i].encode().split()) == n - gone
    assert (after.n_chars == after.text.str.len()).all()


def test_benchmark_leaks(spark, steps):
    before, after = steps["benchmark_leaks"]
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    whole = {i for i, t in zip(before.doc_id, before.text, strict=True) if any(x in " ".join(t.lower().split()) for x in items)}
    gone = set(before.doc_id) - set(after.doc_id)
    assert whole <= gone and len(gone) <= len(whole) + 0.05 * len(before)


def test_source_mix(steps):
    before, after = steps["source_mix"]
    copies = Counter(after.doc_id)
    assert set(copies) <= set(before.doc_id) and max(copies.values()) <= 3
    assert all(sorted(g) == list(range(1, len(g) + 1)) for _, g in after.groupby("doc_id")["copy"])


def test_run(spark, steps):
    assert corpus_pipeline.run(spark, SF).count() == len(steps["source_mix"][1])
