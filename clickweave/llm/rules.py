"""Quality rules as a short-circuit cascade, built from SQL functions alone.

Base measures of a text come from one projection. The rules read them, or the text
itself, inside nested CASE branches, so a rule runs only on rows that all rules before
it have passed. The order comes from a sample: each rule's seconds per row and its
rejected share are measured there, and rules go by rejections per second. The order
changes the cost of a run and never a verdict: a document is kept when no rule rejects it.

Defined cases: a null or empty text has no words and fails the base; equal texts get
equal rows; rows with equal or null ids stay separate rows; an empty table gives an
empty result and the rules in their written order.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import SPACE, WORD, fresh
from clickweave.scratch import pin

WINDOW = 8
# fixed values of the contract
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEATED_PERCENT = 20, 30
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
BLANKS = " \t\n\x0b\f\r"

#: A word that the same word follows.
AGAIN = rf"(?<!{WORD[:-1]})({WORD}+)(?={SPACE}++\1(?!{WORD[:-1]}))"

#: The sample that orders the rules: it sets the cost of a run, not its result.
SAMPLE_ROWS = 2000


@dataclass(frozen=True)
class Rule:
    """``rejects`` takes the text and a getter of base measures and says whether the rule rejects."""

    name: str
    rejects: Callable[[Column, Callable[[str], Column]], Column]


def _without(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _upper_share(text: Column, base: Callable[[str], Column]) -> Column:
    return _without(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ") * 100 > base("word_chars") * 40


#: The rules of production; limits in percent so that all comparisons are whole numbers.
RULES = [
    Rule("symbols", lambda t, b: b("n_symbols") * 100 > b("n_words") * 10),
    Rule("exclamations", lambda t, b: _without(t, "!") * 100 > b("n_words") * 25),
    Rule("word_length", lambda t, b: (b("word_chars") < b("n_words") * 2) | (b("word_chars") > b("n_words") * 14)),
    Rule("duplicate_lines", lambda t, b: (b("n_dup_lines") >= 3) & (b("n_dup_lines") * 100 > F.size(F.split(t, "\n")) * 30)),
    Rule("word_runs", lambda t, b: F.regexp_count(t, F.lit(AGAIN)) * 100 > b("n_words") * 25),
    Rule("shouting", _upper_share),
    Rule("digits", lambda t, b: _without(t, "0123456789") * 100 > b("word_chars") * 30),
    Rule("ellipses", lambda t, b: F.size(F.split(t, r"(\.\.\.|…)[\x20\x09-\x0D]*(\n|$)")) * 100 > F.size(F.split(t, "\n")) * 50 + 100),
]


def measured(docs: DataFrame, text: str, into: str) -> DataFrame:
    """Adds the struct column ``into`` with the base measures of column ``text``.

    Repeated words: the hashes of all 8-word windows, their distinct number, and only where
    that is smaller the sorted (hash, place) list, whose equal neighbours mark the windows.
    Each array is used twice where it is read in a lambda, which keeps the optimizer from
    moving its construction into the lambda. The struct's last field is not deterministic, so a
    filter on the measures stays above them instead of repeating them all in its condition.
    """
    names = {}
    for n in ("t", "w", "h", "g", "s", "p"):
        names[n] = fresh(docs, f"_rules_{n}")
    t, w, h, g, s, p = (names[n] for n in ("t", "w", "h", "g", "s", "p"))
    keep = docs.columns
    one = docs.withColumn(t, F.coalesce(F.col(text), F.lit("")))
    one = one.withColumn(w, F.array_remove(F.split(t, SPACE + "+"), ""))
    one = one.withColumn(h, F.when(F.size(w) >= WINDOW, F.transform(w, lambda x: F.xxhash64(x))))
    windows = F.transform(F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(F.col(h), i, WINDOW)))
    one = one.withColumn(g, F.when(F.col(h).isNotNull(), windows))
    order = F.array_sort(F.transform(g, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    one = one.withColumn(s, F.when(F.size(F.array_distinct(g)) < F.size(g), order))
    twin = lambda e, j: (
        (e["h"] == F.get(F.col(s), j - 1)["h"]) | (e["h"] == F.get(F.col(s), j + 1)["h"])
    )
    places = F.array_sort(F.transform(F.filter(s, lambda e, j: F.coalesce(twin(e, j), F.lit(False))), lambda e: e["i"]))
    one = one.withColumn(p, places)
    steps = F.transform(p, lambda x, j: F.coalesce(F.least(F.lit(WINDOW), F.get(F.col(p), j + 1) - x), F.lit(WINDOW)))
    covered = F.aggregate(steps, F.lit(0), lambda a, x: a + x)
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    struct = F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.translate(t, BLANKS, "")).cast("long").alias("word_chars"),
        _without(F.col(t), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.monotonically_increasing_id().alias("guard"),
    )
    return one.select(*keep, struct.alias(into))


def base_failed(base: Callable[[str], Column]) -> Column:
    return (base("n_words") < MIN_WORDS) | (base("n_repeat_words") * 100 > base("n_words") * MAX_REPEATED_PERCENT)


def rule_order(docs: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """(rule, seconds per row, rejected share) on a sample, best rejection per cost first."""
    sample = pin(docs.select("text").sample(0.2, seed=11).limit(sample_rows), "rules-sample")
    into = fresh(sample, "_base")
    sample = pin(measured(sample, "text", into).where(~base_failed(lambda n: F.col(into)[n])), "rules-sample")
    text = F.coalesce(F.col("text"), F.lit(""))

    def run(rejects: Column) -> tuple[float, int, int]:
        began = time.perf_counter()
        hit, rows = sample.agg(F.count_if(rejects), F.count(F.lit(1))).first()
        return time.perf_counter() - began, hit, rows

    idle = min(run(text == F.lit("-"))[0] for _ in range(2))
    found = []
    for rule in rules:
        rejects = rule.rejects(text, lambda n: F.col(into)[n])
        took, hit, rows = min(run(rejects) for _ in range(2))
        found.append((rule, max(took - idle, 1e-4) / max(rows, 1), hit / max(rows, 1)))
    return sorted(found, key=lambda x: -x[2] / x[1])


def judged(docs: DataFrame, rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """All columns of ``docs`` and a struct column named by ``verdict_column(docs)``.

    Its fields: the base measures, ``base_failed``, ``kept`` and ``rejected_by`` (null when kept;
    "base", or the rule that stopped the cascade: where several would, the first of this run's order).
    """
    into, out = fresh(docs, "_rules_base"), verdict_column(docs)
    ordered = [r for r, _, _ in rule_order(docs, rules or RULES, sample_rows)]
    text, base = F.coalesce(F.col("text"), F.lit("")), lambda n: F.col(into)[n]
    reason = F.when(base_failed(base), F.lit("base"))
    for rule in ordered:
        reason = reason.when(rule.rejects(text, base), F.lit(rule.name))
    why = fresh(docs, "_rules_why")
    rows = measured(docs, "text", into).withColumn(why, reason)
    verdict = F.struct(
        *[base(n).alias(n) for n in BASE],
        base_failed(base).alias("base_failed"),
        F.col(why).isNull().alias("kept"),
        F.col(why).alias("rejected_by"),
    )
    return rows.select(*docs.columns, verdict.alias(out))


def verdict_column(docs: DataFrame) -> str:
    return fresh(docs, "_rules")


def quality_report(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """One row per document: id, base measures, base verdict, verdict and the rejecting rule."""
    rows = docs.select("doc_id", "text")
    out = verdict_column(rows)
    return judged(rows, rules).select("doc_id", f"{out}.*")


def keep_good(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """The rows of ``docs`` that pass, all columns as they were."""
    out = verdict_column(docs)
    return judged(docs, rules).where(F.col(out)["kept"]).select(*docs.columns)
