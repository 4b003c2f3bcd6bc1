"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

Each rule rejects a text or passes it.  On a sample, every rule's cost (the time
that evaluating it takes) and selectivity (the share of texts that it rejects)
are measured, and the rules are ordered by rejection per cost.  They become one
CASE expression: a text that an early rule rejects never reaches the later,
dearer ones.  The order changes only the time; a text is kept if it passes all.

Defined results: null, empty and blank texts have no words, counts of 0, fail
the base rules and are not kept; repeated rows are judged alike; other columns
of the input are not read.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITESPACE, let, quoted, words

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """``rejects``: a condition over ``text``, ``words`` and the base columns, never null."""
    name: str
    rejects: Column


def rules() -> list[Rule]:
    """The rules beyond the base: bounds on a text's shape that ordinary prose of any length keeps."""
    c, n = F.col, F.col("n_words")
    text = c("text")
    return [
        Rule("word_length", (c("word_chars") < 2 * n) | (c("word_chars") > 15 * n)),
        Rule("symbols", 10 * c("n_symbols") > n),
        Rule("dup_lines", 2 * c("n_dup_lines") > F.size(F.split(text, "\n"))),
        Rule("exclamations", 5 * F.regexp_count(text, F.lit("!")) > n),
        Rule("capitals", 2 * F.regexp_count(text, F.lit(r"\p{Lu}")) > F.regexp_count(text, F.lit(r"\p{L}"))),
        Rule("letters", 2 * F.regexp_count(text, F.lit(r"\p{L}")) < c("word_chars")),
        Rule("stutter", 4 * let(c("words"), lambda w: F.size(F.filter(w, lambda x, i: F.get(w, i - 1).eqNullSafe(x)))) > n),
        Rule("one_word", 4 * F.size(F.array_distinct(c("words"))) < F.least(n, F.lit(100))),
    ]


def _repeated_words(w: Column) -> Column:
    """How many words stand in ``WINDOW``-word windows that the text holds twice or more."""
    def windows(h: Column) -> Column:
        return F.when(F.size(h) >= WINDOW, F.transform(
            F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])))

    def covered(win: Column) -> Column:
        pairs = F.sort_array(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        starts = let(pairs, lambda p: F.filter(F.transform(p, lambda x, i: F.when(
            (F.get(p, i - 1)["h"] == x["h"]) | (F.get(p, i + 1)["h"] == x["h"]), x["i"])), lambda s: s.isNotNull()))
        step = F.struct(F.lit(0).cast("int").alias("n"), F.lit(0).cast("int").alias("end"))
        return F.aggregate(F.sort_array(starts), step, lambda a, s: F.struct(
            (a["n"] + F.least(F.lit(WINDOW), s + WINDOW - a["end"])).cast("int").alias("n"),
            (s + WINDOW).cast("int").alias("end")), lambda a: a["n"])

    def count(win: Column) -> Column:
        return F.when(win.isNull(), 0).when(F.size(F.array_distinct(win)) == F.size(win), 0).otherwise(covered(win))

    hashes = F.transform(w, lambda x: F.xxhash64(x))
    return let(let(hashes, windows), count).cast("long")


def with_base(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text, words`` and the base columns for every row."""
    d = docs.select(quoted(id_col).alias("id"), F.coalesce(quoted(text_col), F.lit("")).alias("text"))
    d = d.withColumn("words", words(F.col("text")))
    w, text = F.col("words"), F.col("text")
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WHITESPACE)) != "")
    return d.select(
        "id", "text", "words",
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeated_words(w).alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def plan(docs: DataFrame, candidates: list[Rule], id_col: str = "doc_id", text_col: str = "text",
         sample_rows: int = 2000) -> list[Rule]:
    """The rules by rejection per cost, both measured on a random sample of about ``sample_rows`` rows."""
    drawn = docs.sample(min(1.0, sample_rows / max(1, docs.count())), seed=3)
    sample = with_base(drawn, id_col, text_col).where(~base_failed()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = max(1, sample.count())

        def timed(condition: Column) -> tuple[float, int]:
            began = time.monotonic()
            rejected = sample.agg(F.sum(condition.cast("long"))).first()[0] or 0
            return time.monotonic() - began, rejected

        timed(F.lit(False))
        idle = timed(F.lit(False))[0]
        rank = {}
        for r in candidates:
            cost, rejected = timed(r.rejects)
            rank[r.name] = (rejected / n) / max(cost - idle, 1e-3)
    finally:
        sample.unpersist()
    return sorted(candidates, key=lambda r: (-rank[r.name], r.name))


def cascade(ordered: list[Rule]) -> Column:
    """False at the first rule that rejects, else true: one CASE, evaluated no further than needed."""
    out = F.when(base_failed(), False)
    for r in ordered:
        out = out.when(r.rejects, False)
    return out.otherwise(True)


def judge(docs: DataFrame, candidates: list[Rule] | None = None, id_col: str = "doc_id", text_col: str = "text",
          sample_rows: int = 2000) -> DataFrame:
    """Base columns, ``base_failed`` and ``kept`` for every row, with rules ordered by a sample."""
    ordered = plan(docs, rules() if candidates is None else candidates, id_col, text_col, sample_rows)
    based = with_base(docs, id_col, text_col)
    return based.select(quoted("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        base_failed().alias("base_failed"), cascade(ordered).alias("kept"))
