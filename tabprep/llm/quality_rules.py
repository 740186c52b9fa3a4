"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule rejects a document by an expression over its text. On a sample, the cost of every rule and
the share of documents that it rejects are measured; the rules then run in the order of rejection per
cost, and a rule is only evaluated for documents that none before it rejected. The order changes the
work, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.llm.staging import Scratch

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"
WINDOW = 5
#: Rows of the sample on which rules are timed and their rejections counted.
SAMPLE_ROWS = 2000


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _count(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(_without(text, characters))).cast("long")


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, r"\n"), lambda x: F.length(_without(x, SPACES)) > 0)


def with_measures(docs: DataFrame) -> DataFrame:
    """``docs`` with the base measures of its text, each computed once: ``n_words``, ``word_chars``,
    ``n_symbols``, ``n_lines``, ``n_dup_lines``, ``n_repeat_words`` (long), and the arrays ``_words``, ``_text``.

    A null text counts as empty. Repeated words are found without comparing windows pairwise: window
    hashes are sorted with their places only where a text has equal ones.
    """
    rows = docs.withColumn("_text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = rows.withColumns({"_words": words(F.col("_text")), "_lines": lines(F.col("_text"))})
    size = F.size("_words")
    places = F.when(size >= WINDOW, F.sequence(F.lit(0), size - WINDOW)).otherwise(F.array().cast("array<int>"))
    windows = F.transform(places, lambda i: F.xxhash64(*(F.get("_words", i + k) for k in range(WINDOW))))
    rows = rows.withColumns(
        {
            "n_words": size.cast("long"),
            "word_chars": F.length(_without(F.col("_text"), SPACES)).cast("long"),
            "n_symbols": _count(F.col("_text"), SYMBOLS),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_windows": windows,
        }
    )
    rows = rows.withColumn("_equal", F.size(F.array_distinct("_windows")) < F.size("_windows"))
    sorted_windows = F.when(F.col("_equal"), F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    rows = rows.withColumn("_sorted", sorted_windows)
    at = lambda i: F.get("_sorted", i)["h"]
    again = F.transform("_sorted", lambda w, j: F.when((w["h"] == at(j + 1)) | (w["h"] == at(j - 1)), w["i"]))
    rows = rows.withColumn("_again", F.sort_array(F.filter(again, lambda i: i.isNotNull())))
    reach = F.transform("_again", lambda i, j: F.least(F.lit(WINDOW), F.coalesce(F.get("_again", j + 1) - i, F.lit(WINDOW))))
    covered = F.aggregate(reach, F.lit(0), lambda n, k: n + k)
    rows = rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    # an explode of one struct: filters on a measure are not pushed below it, where each use would compute it anew
    made = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "_text", "_words"]
    rows = rows.select(*(c for c in docs.columns if c not in made), F.explode(F.array(F.struct(*made))).alias("_made"))
    return rows.select("*", "_made.*").drop("_made")


@dataclass(frozen=True)
class Rule:
    """``rejects`` is a boolean expression over the columns of ``with_measures``."""

    name: str
    rejects: Column


def base_rules() -> list[Rule]:
    return [
        Rule("few_words", F.col("n_words") < 10),
        Rule("repeated_words", 100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
    ]


def further_rules() -> list[Rule]:
    text, n = F.col("_text"), F.col("n_words")
    letterless = F.size(F.filter("_words", lambda w: ~w.rlike(r"\p{L}")))
    return [
        Rule("symbols", 10 * F.col("n_symbols") > n),
        Rule("repeated_lines", 10 * F.col("n_dup_lines") > 3 * F.col("n_lines")),
        Rule("word_length", (2 * F.col("word_chars") < 5 * n) | (F.col("word_chars") > 14 * n)),
        Rule("capitals", 10 * _count(text, CAPITALS) > 3 * F.col("word_chars")),
        Rule("exclamations", 2 * _count(text, "!") > n),
        Rule("letterless_words", 10 * letterless > 4 * n),
    ]


def ordered(docs: DataFrame, rules: Sequence[Rule], sample_rows: int = SAMPLE_ROWS, repeats: int = 2) -> list[Rule]:
    """The rules by rejected share per second, measured on at most ``sample_rows`` rows with their measures."""
    total = docs.count()
    if not total or len(rules) < 2:
        return list(rules)
    scratch = Scratch(docs.sparkSession, "rules")
    part = docs.select("text").sample(fraction=min(1.0, 1.5 * sample_rows / total), seed=11).limit(sample_rows)
    sample = scratch.write(with_measures(part))

    def run(condition: Column) -> tuple[float, int]:
        best, hits = float("inf"), 0
        for _ in range(repeats):
            start = time.perf_counter()
            hits = sample.agg(F.count_if(condition)).first()[0]
            best = min(best, time.perf_counter() - start)
        return best, hits

    idle, _ = run(F.lit(False))
    worth = {}
    for rule in rules:
        seconds, hits = run(rule.rejects)
        worth[rule.name] = hits / max(seconds - idle, 1e-3)
    scratch.drop(sample)
    return sorted(rules, key=lambda r: -worth[r.name])


def cascade(rules: Sequence[Rule]) -> Column:
    """True for documents that no rule rejects; a rule is skipped once one before it has rejected."""
    verdict = None
    for rule in rules:
        met = F.coalesce(rule.rejects, F.lit(False))
        verdict = F.when(met, False) if verdict is None else verdict.when(met, False)
    return F.lit(True) if verdict is None else verdict.otherwise(True)


def judged(docs: DataFrame, rules: Sequence[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with its base measures, ``base_failed`` and ``kept`` (the verdict of all rules).

    Columns of ``docs`` with these names are replaced. Null, empty and wordless texts fail the base
    rules; repeated rows are judged alike; an empty table stays empty. Texts are measured whole.
    """
    taken = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "_text", "_words")
    docs = docs.select(*(c for c in docs.columns if c not in taken))
    chosen = ordered(docs, further_rules() if rules is None else rules, sample_rows)
    failed = F.lit(False)
    for rule in base_rules():
        failed = failed | rule.rejects
    rows = with_measures(docs).withColumn("base_failed", failed)
    return rows.withColumn("kept", ~F.col("base_failed") & cascade(chosen)).drop("_text", "_words")


def kept(docs: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their own columns, whatever those are called."""
    own = [F.col(c).alias(f"_own{i}") for i, c in enumerate(docs.columns)]
    rows = judged(docs.select(*own, docs["text"]), rules).where("kept")
    return rows.select(*(F.col(f"_own{i}").alias(c) for i, c in enumerate(docs.columns)))
