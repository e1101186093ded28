"""Quality rules as a short-circuit cascade, in DataFrame functions alone.

The base statistics are computed for every text. Of the further rules, cost (seconds over a sample, which each
rule goes through many times, less those of a rule that does nothing) and selectivity (the share of the sample
that it rejects) are estimated first, and rules are tried in the order of rejection per cost; a text that one rejects isn't shown to the next. The order changes the time only: a text
is kept if no rule rejects it.

A null or empty text has no words and fails the base. Texts are read in full, however long. Every row has a
verdict, repeated rows the same one; an empty table gives an empty result; columns beyond the two named ones are
not read.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, materialise

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Bound of the sample on which cost and selectivity are estimated.
MAX_SAMPLE = 2000
#: Times that a rule goes through the sample, in each of two runs.
REPEATS = 10


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value worked out once: as the variable of a lambda over an array of one."""
    return F.get(F.transform(F.array(value), body), 0)


def _repeated_words(words: Column) -> Column:
    """Words in three-word windows that the array holds twice or more."""

    def covered(windows: Column) -> Column:
        # equal windows are neighbours once sorted; each covers the three words from its place on
        twice = F.filter(windows, lambda x, j: F.coalesce(x.h == F.get(windows, j - 1).h, F.lit(False)) | F.coalesce(x.h == F.get(windows, j + 1).h, F.lit(False)))
        return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x.i, x.i + 1, x.i + 2)))))

    def count(w: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))
        return F.when(F.size(w) < 3, F.lit(0)).otherwise(_let(F.sort_array(windows), covered))

    return _let(words, lambda w: F.struct(F.size(w).alias("n"), count(w).alias("repeat")))


def statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words of every row."""
    t = F.coalesce(F.col(text), F.lit(""))
    solid = F.char_length(F.translate(t, SPACE, ""))
    words = F.when(solid == 0, F.array().cast("array<string>")).otherwise(F.split(F.btrim(t, F.lit(SPACE)), r"[\x20\x09-\x0D]+"))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.length(F.translate(x, SPACE, "")) > 0)
    found = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        t.alias("text"),
        solid.cast("long").alias("word_chars"),
        _repeated_words(words).alias("w"),
        _let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))).alias("l"),
    )
    return found.select(
        "doc_id",
        "text",
        F.col("w.n").cast("long").alias("n_words"),
        "word_chars",
        (F.char_length("text") - F.char_length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.col("l.n").cast("long").alias("n_lines"),
        F.col("l.dup").cast("long").alias("n_dup_lines"),
        F.col("w.repeat").cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rules() -> dict[str, Column]:
    """Each rule as the condition on which it rejects."""
    words = F.col("n_words")
    return {
        "symbols": 100 * F.col("n_symbols") > 30 * words,
        "word_length": (F.col("word_chars") < 2 * words) | (F.col("word_chars") > 14 * words),
        "repeated_lines": 100 * F.col("n_dup_lines") > 50 * F.col("n_lines"),
        "shouting": 100 * F.regexp_count("text", F.lit("[A-Z]")) > 40 * F.col("word_chars"),
        "exclamations": 100 * F.regexp_count("text", F.lit("!")) > 50 * words,
        "no_sentences": 400 * F.regexp_count("text", F.lit("[.!?:;,]")) < words,
    }


def ordered(stats: DataFrame, given: dict[str, Column], most: int = MAX_SAMPLE) -> list[str]:
    """Names of the rules, the one with the most rejections per second first."""
    sample = materialise(bounded(stats.where(~base_failed()), "doc_id", most), "sample")
    n = max(1, sample.count())
    again = sample.withColumn("turn", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))))

    def seconds(rule: Column) -> tuple[float, int]:
        """The faster of two runs, and the rows rejected in a turn."""
        found = []
        for _ in range(2):
            began = time.monotonic()
            # the turn is part of the condition, so that every turn works it out
            rejected = again.where(F.when(F.col("turn") > 0, rule)).count()
            found.append((time.monotonic() - began, rejected // REPEATS))
        return min(found)

    idle, worth = seconds(F.col("n_words") < 0)[0], {}
    for name, rule in given.items():
        took, rejected = seconds(rule)
        worth[name] = (rejected / n) / max(took - idle, 1e-3)
    return sorted(given, key=lambda name: (-worth[name], name))


def verdicts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: list[str] | None = None) -> DataFrame:
    """The statistics of every row, base_failed and kept."""
    stats, given = statistics(docs, doc_id, text), rules()
    if order is None:
        # written first: else the filters merge, and the statistics of all rows are worked out for it
        sample = materialise(bounded(docs.select(doc_id, text), doc_id, 2 * MAX_SAMPLE), "texts")
        order = ordered(statistics(sample, doc_id, text), given)
    kept = F.when(base_failed(), F.lit(False))
    for name in order:  # CASE stops at the first rule that rejects
        kept = kept.when(given[name], F.lit(False))
    return stats.withColumn("base_failed", base_failed()).withColumn("kept", kept.otherwise(F.lit(True)))
