"""Quality rules as a short-circuit cascade.

``measures`` computes the base counts of a text with DataFrame functions only.
``estimate`` runs every rule by itself on a bounded sample of rows and records
which share of the rows it rejects and what it costs; ``order`` puts the rules
in the order of rejections per cost; ``cascade`` evaluates them as one CASE
expression, so a row that a rule rejects never reaches the rules behind it.
The order changes the work, never the verdict: a row is kept iff no rule
rejects it.

Defined results: a null text counts as a text without words (all counts 0, so
the base rule rejects it); an empty text likewise; a rule that gives NULL does
not reject; rows with equal texts or repeated ids get one result each; an empty
table gives an empty table; extra columns are left out of the result unless
named in ``keep``.
"""

from __future__ import annotations

import functools
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.session import materialize

WORD_GAP = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
#: ASCII digits and punctuation; the other characters of words count as letters.
MARK = r"[!-@\[-`{-~]"
CAPITAL = r"[A-Z\xC0-\xD6\xD8-\xDE]"
WINDOW = 5
#: Rows that ``estimate`` looks at (on average; a seeded Bernoulli sample).
SAMPLE_ROWS = 2000


@dataclass(frozen=True)
class Rule:
    """``reject`` is built from the columns of ``measures``; true rejects the row."""

    name: str
    reject: Callable[[], Column]


def default_rules() -> list[Rule]:
    """Rules on whole texts, in integer arithmetic. They look for the marks of
    machine-made or broken text and hold for any language."""
    c = F.col
    count = lambda pattern: F.regexp_count("text", F.lit(pattern))
    has = lambda *parts: functools.reduce(lambda a, b: a | b, [F.contains("text", F.lit(x)) for x in parts])
    stutters = lambda: F.size(F.filter("words", lambda x, i: (i > 0) & (F.get("words", i - 1) == x)))
    # "has" skips the pattern where no match is possible; short lists count as three lines
    lines = lambda: F.greatest(c("n_lines"), F.lit(3))
    return [
        Rule("word_length", lambda: (c("word_chars") < 2 * c("n_words")) | (c("word_chars") > 15 * c("n_words"))),
        Rule("symbols", lambda: 10 * c("n_symbols") > c("n_words")),
        Rule("repeated_lines", lambda: 10 * c("n_dup_lines") > 4 * c("n_lines")),
        Rule("few_letters", lambda: 10 * count(MARK) > 6 * c("word_chars")),
        Rule("stutter", lambda: 10 * stutters() > 3 * c("n_words")),
        Rule("upper_case", lambda: 2 * count(CAPITAL) > c("word_chars")),
        Rule("exclamations", lambda: has("!") & (10 * count("!") > 3 * c("n_words"))),
        Rule("ellipsis_lines", lambda: has("...", "\u2026") & (10 * count(r"(?:\.\.\.|\x{2026})(?=\n|$)") > 3 * lines())),
        Rule("bullet_lines", lambda: has("- ", "* ", "\u2022 ") & (10 * count(r"(?:^|\n)[*\x{2022}-]\x20") > 9 * lines())),
        Rule("markup", lambda: has("<", "{", "}") & (20 * count(r"</?[A-Za-z][^<>\n]{0,200}>|[{}]") > c("n_words"))),
    ]


def _repeat_words(words: Column, keys: Column) -> Column:
    """Words inside 5-word windows that occur at least twice in the row.

    ``keys`` are hashes of the windows; only rows with two equal hashes go on
    to compare the windows' words themselves. Windows are sorted by their words, equal neighbours give
    the repeated start positions, and sorted positions give the union of the
    covered words: n log n for a row, however often a window repeats.
    """
    at = F.sequence(F.lit(0), F.size(words) - WINDOW)
    window = lambda i: F.concat_ws(" ", *[F.get(words, i + k) for k in range(WINDOW)])
    ordered = F.sort_array(F.transform(at, lambda i: F.struct(window(i).alias("w"), i.alias("i"))))

    def repeated(s: Column) -> Column:
        same = lambda x, j: (j >= 0) & F.coalesce(F.get(s, F.greatest(j, F.lit(0)))["w"] == x["w"], F.lit(False))
        marked = F.transform(s, lambda x, j: F.when(same(x, j - 1) | same(x, j + 1), x["i"]))
        return F.sort_array(F.filter(marked, lambda i: i.isNotNull()))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    # one-element arrays: transform binds its element once, so each step is computed once
    once = lambda value, f: F.get(F.transform(F.array(value), f), F.lit(0))
    exact = once(ordered, lambda s: once(repeated(s), covered))
    return F.when(F.size(F.array_distinct(keys)) < F.size(keys), exact).otherwise(F.lit(0))


def measures(docs: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, text, words, and the base counts n_words, word_chars,
    n_symbols, n_lines, n_dup_lines, n_repeat_words (long), base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select(*keep, text.alias("text"))
    words = F.array_remove(F.split("text", WORD_GAP, -1), "")
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD_CHAR))
    df = df.select(*keep, "text", words.alias("words"), lines.alias("lines"))
    w = F.col("words")
    windows = F.when(
        F.size(w) >= WINDOW,
        F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])),
    ).otherwise(F.array().cast("array<bigint>"))
    df = df.select(*keep, "text", "words", "lines", windows.alias("windows"))
    df = df.select(
        *keep,
        "text",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("words"), F.col("windows")).cast("long").alias("n_repeat_words"),
    )
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return df.withColumn("base_failed", base)


def _rejects(rule: Rule) -> Column:
    return F.coalesce(rule.reject(), F.lit(False))


def estimate(measured: DataFrame, rules: Sequence[Rule]) -> list[tuple[str, float, float]]:
    """(rule, share of rejected rows, cost in seconds) over a stored sample.

    The cost is the time of a pass that evaluates only this rule, less that of
    a pass that evaluates none, the better of two runs; never below 0.1 ms.
    """

    def run(e: Column) -> tuple[int, int, float]:
        best, row = float("inf"), None
        for _ in range(2):
            began = time.perf_counter()
            row = measured.agg(F.count(F.lit(1)).alias("n"), F.count_if(e).alias("hit")).first()
            best = min(best, time.perf_counter() - began)
        return row["n"], row["hit"], best

    idle = run(F.length("text") < 0)[2]
    found = []
    for rule in rules:
        n, hit, took = run(_rejects(rule))
        found.append((rule.name, hit / n if n else 0.0, max(took - idle, 1e-4)))
    return found


def order(rules: Sequence[Rule], estimates: Sequence[tuple[str, float, float]]) -> list[Rule]:
    """Rules by rejections per cost, highest first; ties by cost, then by name."""
    by = {name: (-share / cost, cost, name) for name, share, cost in estimates}
    return sorted(rules, key=lambda r: by[r.name])


def cascade(measured: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds ``rejected_by``: the first rule, in the given order, that rejects
    the row (NULL: none). CASE stops at the first true branch."""
    verdict = F.when(F.col("base_failed"), F.lit("base"))
    for rule in rules:
        verdict = verdict.when(_rejects(rule), F.lit(rule.name))
    return measured.withColumn("rejected_by", verdict)


def ordered_rules(docs: DataFrame, rules: Sequence[Rule] | None = None, sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> list[Rule]:
    """The rules in the order that a sample of about ``sample_rows`` rows suggests."""
    rules = list(rules if rules is not None else default_rules())
    n = docs.count()  # row counts of the files, no column is read
    share = min(1.0, sample_rows / max(n, 1))
    sample = docs.select("text") if share == 1.0 else docs.select("text").sample(share, seed)
    return order(rules, estimate(materialize(measures(sample, keep=()), "quality_sample"), rules))


def filter_quality(docs: DataFrame, rules: Sequence[Rule] | None = None, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Base counts, ``base_failed``, ``rejected_by`` and ``kept`` for every row."""
    out = cascade(measures(docs, keep), ordered_rules(docs, rules))
    return out.withColumn("kept", F.col("rejected_by").isNull()).drop("text", "words")
