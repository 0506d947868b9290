"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Every rule is a named condition that rejects a document. What a rule costs and how many
documents it rejects are estimated on a bounded sample; the rules are then tried in the order
of rejection per cost, and a document that one rule rejects is not looked at by the later ones.
The order changes the work, never the verdict: a document is kept if no rule rejects it.

Edge cases: a null text has no words and is rejected like an empty one; documents are judged one
by one, so repeated rows get the same verdict, and no column but the text is read. An empty
table gives an empty result. Columns that are already there keep their values: the rules work
on columns with a leading ``_q_`` which are dropped at the end.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthmill.llm.common import with_plain_names, word_array

SYMBOLS = "[#*$%&|<>]"
SAMPLE_ROWS = 500
HELPERS = ("_q_text", "_q_words", "_q_windows")


@dataclass(frozen=True)
class Rule:
    """``rejects`` is a condition over the features of ``features()``, never null."""

    name: str
    rejects: Column


def window_hashes(words: Column) -> Column:
    """A 64-bit hash of each three-word window of a text, in order."""
    starts = F.sequence(F.lit(0), F.size(words) - 3)
    hashes = F.transform(
        starts, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    )
    return F.when(F.size(words) >= 3, hashes).otherwise(F.array().cast("array<bigint>"))


def repeated_words(windows: Column) -> Column:
    """Words that lie in a three-word window found twice or more in the text.

    Windows are compared by their hashes within one text. Only texts whose hashes are not all
    distinct are sorted; the sort brings equal windows together, whatever their number.
    """
    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(values: Column) -> Column:
        def equal(x: Column, i: Column) -> Column:
            before = F.get(values, i - 1)["h"] == x["h"]
            after = F.get(values, i + 1)["h"] == x["h"]
            return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

        return F.filter(values, equal)

    # the pairs are bound once as the only element of an array, else each use would sort again
    found = F.get(F.transform(F.array(pairs), twice), 0)
    covered = F.flatten(F.transform(found, lambda x: F.sequence(x["i"], x["i"] + 2)))
    all_distinct = F.size(F.array_distinct(windows)) == F.size(windows)
    count = F.size(F.array_distinct(covered))
    return F.when(all_distinct, F.lit(0)).otherwise(count).cast("bigint")


def prepared(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with the text, its words and its windows as helper columns."""
    return (
        docs.withColumn("_q_text", F.coalesce(F.col(text), F.lit("")))
        .withColumn("_q_words", word_array(F.col("_q_text")))
        .withColumn("_q_windows", window_hashes(F.col("_q_words")))
    )


def features() -> dict[str, Column]:
    """The measured values of a prepared document by name."""
    text, words = F.col("_q_text"), F.col("_q_words")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(words).cast("bigint"),
        "word_chars": F.length(F.array_join(words, "")).cast("bigint"),
        "n_symbols": (F.size(F.split(text, SYMBOLS)) - 1).cast("bigint"),
        "n_lines": F.size(lines).cast("bigint"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"),
        "n_repeat_words": repeated_words(F.col("_q_windows")),
    }


def base_rules(f: dict[str, Column]) -> list[Rule]:
    """Too short, or more than half of the words in repeated windows."""
    return [
        Rule("short", f["n_words"] < 50),
        Rule("repeated", 100 * f["n_repeat_words"] > 50 * f["n_words"]),
    ]


def style_rules(f: dict[str, Column]) -> list[Rule]:
    """Symbol noise, repeated lines, words of unnatural mean length."""
    return [
        Rule("symbols", 10 * f["n_symbols"] > f["n_words"]),
        Rule("lines", (2 * f["n_dup_lines"] > f["n_lines"]) & (f["n_dup_lines"] >= 4)),
        Rule("word_length", (f["word_chars"] < 2 * f["n_words"]) | (f["word_chars"] > 14 * f["n_words"])),
    ]


def ordered_rules(sample: DataFrame, rules: Sequence[Rule]) -> list[Rule]:
    """The rules by rejection per cost on ``sample``, a small table that is already computed."""
    rows = sample.count()
    if not rows:
        return list(rules)
    rates = sample.agg(*[F.avg(rule.rejects.cast("double")).alias(rule.name) for rule in rules]).first()
    value = {}
    for rule in rules:
        query = sample.agg(F.sum(rule.rejects.cast("int")))
        query.collect()  # compiles the expression, so that only its work is timed
        started = time.perf_counter()
        query.collect()
        value[rule.name] = rates[rule.name] / max(1e-9, time.perf_counter() - started)
    return sorted(rules, key=lambda rule: -value[rule.name])


def cascade(rules: Sequence[Rule]) -> Column:
    """True if no rule rejects; a later rule is only evaluated where the earlier ones pass."""
    verdict = F.lit(True)
    for rule in reversed(rules):
        verdict = F.when(rule.rejects, F.lit(False)).otherwise(verdict)
    return verdict


def keep_good(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that no rule rejects, with their columns as they are, whatever the names of those."""
    return with_plain_names(docs, (text,), lambda plain: _keep_good(plain, text, sample_rows))


def _keep_good(docs: DataFrame, text: str, sample_rows: int) -> DataFrame:
    ready = prepared(docs, text)
    measured = features()
    sample = ready.select(*HELPERS).limit(sample_rows).cache()
    rules = ordered_rules(sample, [*base_rules(measured), *style_rules(measured)])
    sample.unpersist()
    # a condition on columns is moved below them, where it would split every text again for each
    # use of its words; not so on a column that depends on the row's place
    verdict = F.when(F.monotonically_increasing_id() >= 0, cascade(rules))
    return ready.withColumn("_q_keep", verdict).filter("_q_keep").drop(*HELPERS, "_q_keep")


def judged(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Every document with its measured values, the verdict of the base rules and of all rules."""
    ready = prepared(docs.select("doc_id", "text"), "text")
    values = ready.select("doc_id", *[value.alias(name) for name, value in features().items()])
    measured = {name: F.col(name) for name in features()}
    base = base_rules(measured)
    sample = values.limit(sample_rows).cache()
    rules = ordered_rules(sample, [*base, *style_rules(measured)])
    sample.unpersist()
    failed = F.lit(False)
    for rule in base:
        failed = failed | rule.rejects
    # place-dependent, so that a later condition on the result is not moved below the words
    verdict = F.when(F.monotonically_increasing_id() >= 0, cascade(rules))
    return values.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), verdict.alias("kept"),
    )
