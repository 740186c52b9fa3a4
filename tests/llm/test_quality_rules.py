import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tabprep.llm import quality_rules as Q

from .conftest import EDGE

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = ["a b c d e a b c d e f", "one two " * 40, "line here\nline here\n\nother\nline here", "$$$ ### word", "LOUD!! WORDS!! " * 8, "12 34 56 78 90 " * 3, "fine words in a row that say something new each time"]


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    count = Counter(windows)
    hit = {i + k for i, x in enumerate(windows) if count[x] > 1 for k in range(5)}
    filled = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(filled) - len(set(filled)), len(hit)


def test_measures_and_verdict(frame):
    rows = [*enumerate(TEXTS, 100), *EDGE]
    for r in Q.judged(frame(rows)).collect():
        n = brute(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 10 or 100 * n[4] > 20 * n[0])
        assert not (r.base_failed and r.kept)
    kept = {r.doc_id for r in Q.judged(frame(rows)).where("kept").collect()}
    assert kept == {106}


def test_order_changes_no_verdict(frame):
    docs = frame([*enumerate(TEXTS * 3, 100), *EDGE])
    rules = Q.further_rules()
    rows = Q.with_measures(docs)
    verdicts = [[r[0] for r in rows.select(Q.cascade(x).alias("v"), "doc_id", "text").orderBy("doc_id", "text").collect()] for x in (rules, rules[::-1])]
    assert verdicts[0] == verdicts[1]
    assert {r.name for r in Q.ordered(docs, rules, sample_rows=20)} == {r.name for r in rules}


def test_rules_after_a_rejection_are_skipped(frame):
    boom = Q.Rule("boom", F.raise_error("evaluated").cast("boolean"))
    first = Q.Rule("all", F.lit(True) & (F.col("n_words") >= 0))
    rows = Q.with_measures(frame(EDGE)).select(Q.cascade([first, boom]).alias("v"))
    assert {r.v for r in rows.collect()} == {False}


def test_order_follows_rejection_per_cost(frame):
    docs = frame([(i, "plain words " * 6) for i in range(200)])
    rules = [Q.Rule("none", F.col("n_words") < 0), Q.Rule("all", F.col("n_words") > 0)]
    assert [r.name for r in Q.ordered(docs, rules)] == ["all", "none"]


@pytest.mark.parametrize("rows", [[], EDGE])
def test_clashing_columns_and_empty_tables(frame, rows):
    docs = frame(rows).withColumnRenamed("lang", "kept").withColumnRenamed("source", "n_words")
    assert Q.judged(docs).count() == len(rows)
    assert Q.kept(docs).columns == docs.columns


def test_kept_rows_keep_their_columns(frame):
    rows = [*enumerate(TEXTS, 100)]
    out = Q.kept(frame(rows).withColumnRenamed("source", "base_failed"))
    assert [(r.doc_id, r.text) for r in out.collect()] == [rows[6]]
