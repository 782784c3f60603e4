"""Quality rules as a short-circuit cascade. DataFrame functions only.

A rule is a boolean column, true for a document to be rejected. ``plan_cascade`` estimates each rule's
cost and rejections on a bounded sample and orders the rules by rejection per cost; ``first_rejection``
evaluates them in that order and stops at the first that rejects. The order never changes who is kept,
only what it costs to find out.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maillage.llm.columns import id_hash, words

SAMPLE_ROWS = 2000  # rows on which costs and rejections are estimated; nothing but the order depends on them
REPEATS = 3  # of every timing; mostly start-up, which varies
WINDOW = 8

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30  # words in repeated windows
MAX_SYMBOL_PERCENT = 30  # symbols to words
MAX_EXCLAIM_PERCENT = 30  # exclamation marks to words
MAX_ECHO_PERCENT = 30  # words that repeat the word before them
MAX_DUP_LINE_PERCENT = 50  # lines that repeat an earlier one
MEAN_WORD_CHARS = (2, 16)


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column
    cost: float = 0.0  # seconds on the sample
    rejection: float = 0.0  # share of the sample that it rejects


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# Measures of a text and of its words. Each reads whole texts.
def word_chars(tokens: Column) -> Column:
    return F.length(F.array_join(tokens, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long")


def n_exclaims(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^!]+", "")).cast("long")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def n_dup_lines(text: Column) -> Column:
    return let(lines_with_words(text), lambda lines: (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))


def n_echoed_words(tokens: Column) -> Column:
    """Words equal to the word before them."""
    return F.size(F.filter(tokens, lambda w, i: F.coalesce(w == F.get(tokens, i - 1), F.lit(False)))).cast("long")


def n_repeat_words(tokens: Column) -> Column:
    """Words inside windows of eight words that occur twice or more in the text, each word once.

    Windows are compared by 64-bit hashes within one text. Hashes are sorted with their places, a
    repeated window equals a neighbour, and each repeated window adds the words that the repeated
    window before it left uncovered.
    """

    def window(hashes: Column, i: Column) -> Column:
        return F.struct(F.xxhash64(*(F.get(hashes, i + k) for k in range(WINDOW))).alias("h"), i.alias("i"))

    def repeated(order: Column) -> Column:
        def place(w: Column, k: Column) -> Column:
            return F.when((F.get(order, k - 1)["h"] == w["h"]) | (F.get(order, k + 1)["h"] == w["h"]), w["i"])

        return F.array_sort(F.filter(F.transform(order, place), lambda i: i.isNotNull()))

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(i - F.get(places, k - 1), F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

    hashed = F.transform(tokens, lambda w: F.xxhash64(w))
    windows = let(hashed, lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: window(h, i)))
    count = let(F.array_sort(windows), lambda order: let(repeated(order), covered))
    return F.when(F.size(tokens) > WINDOW, count).otherwise(F.lit(0).cast("long"))


def production_rules(text: Column, tokens: Column, measures: dict[str, Column] | None = None) -> list[Rule]:
    """The rules in the order in which they are stated. ``measures`` replaces a measure that is at hand."""
    m = {
        "n_words": F.size(tokens), "word_chars": word_chars(tokens), "n_symbols": n_symbols(text), "n_dup_lines": n_dup_lines(text),
        "n_repeat_words": n_repeat_words(tokens),
    } | (measures or {})
    n = m["n_words"]
    return [
        Rule("short", n < MIN_WORDS),
        Rule("repeated_windows", 100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * n),
        Rule("symbols", 100 * m["n_symbols"] > MAX_SYMBOL_PERCENT * n),
        Rule("exclamations", 100 * n_exclaims(text) > MAX_EXCLAIM_PERCENT * n),
        Rule("echoed_words", 100 * n_echoed_words(tokens) > MAX_ECHO_PERCENT * n),
        Rule("repeated_lines", 100 * m["n_dup_lines"] > MAX_DUP_LINE_PERCENT * F.size(lines_with_words(text))),
        Rule("word_length", (m["word_chars"] < MEAN_WORD_CHARS[0] * n) | (m["word_chars"] > MEAN_WORD_CHARS[1] * n)),
    ]


def plan_cascade(sample: DataFrame, rules: Sequence[Rule]) -> list[Rule]:
    """Order by rejections per second on ``sample``, measured rule by rule, the least of REPEATS times.

    An empty sample leaves the order as it is. Of rules with equal rates the one stated first comes first.
    """
    rows = sample.count()  # also makes the first timing a warm one
    measured = []
    for rule in rules:
        job, times = sample.agg(F.sum(F.coalesce(rule.rejects, F.lit(False)).cast("long"))), []
        for _ in range(REPEATS):
            start = time.perf_counter()
            rejected = job.first()[0] or 0
            times.append(time.perf_counter() - start)
        measured.append(replace(rule, cost=min(times), rejection=rejected / max(rows, 1)))
    return sorted(measured, key=lambda r: -r.rejection / max(r.cost, 1e-9))


def first_rejection(rules: Sequence[Rule]) -> Column:
    """Name of the first rule that rejects, null for a document that passes all. Later rules are then not evaluated."""
    out = None
    for rule in rules:
        out = F.when(rule.rejects, rule.name) if out is None else out.when(rule.rejects, rule.name)
    return F.lit(None).cast("string") if out is None else out


def _with_words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col), text.alias("_text"), words(text).alias("_words"))


def _sample(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Bounded: at most SAMPLE_ROWS rows, from all over the table by the hash of their id."""
    every = max(1, docs.count() // (2 * SAMPLE_ROWS))
    some = docs.where(F.coalesce(id_hash(F.col(id_col)) % every == 0, F.lit(True))).limit(SAMPLE_ROWS)
    return _with_words(some, id_col, text_col)


def run_cascade(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Callable[[Column, Column], list[Rule]] = production_rules) -> DataFrame:
    """Per row: id, kept. No measure beyond the first rejecting rule is computed."""
    made = rules(F.col("_text"), F.col("_words"))
    sample = _sample(docs, id_col, text_col).cache()
    order = plan_cascade(sample, made)
    sample.unpersist()
    return _with_words(docs, id_col, text_col).select(id_col, first_rejection(order).isNull().alias("kept"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base measures of every document, whether the base rules reject it, and the verdict of the cascade.

    A null or empty text has no words: all measures are 0 and it fails the base rule on length. Repeated
    rows are judged once each. Other columns are not read, so their names cannot clash.
    """
    text, tokens = F.col("_text"), F.col("_words")
    counts = {c: F.col(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}

    def measured(rows: DataFrame) -> DataFrame:
        return rows.select(
            id_col, "_text", "_words", F.size(tokens).cast("long").alias("n_words"), word_chars(tokens).alias("word_chars"), n_symbols(text).alias("n_symbols"),
            n_dup_lines(text).alias("n_dup_lines"), n_repeat_words(tokens).alias("n_repeat_words"),
        )

    # Every document gets the base measures, so a rule costs what it takes beyond them.
    sample = measured(_sample(docs, id_col, text_col)).cache()
    rules = plan_cascade(sample, production_rules(text, tokens, counts))
    sample.unpersist()
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return measured(_with_words(docs, id_col, text_col)).select(id_col, *counts, base_failed.alias("base_failed"), first_rejection(rules).isNull().alias("kept"))
