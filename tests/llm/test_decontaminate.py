import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabprep.llm import decontaminate
from tabprep.llm.wu_manber import PatternSet

from .conftest import EDGE

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, size):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1) if n else ():
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        out.append((doc, len(w), sorted(hit), sorted(str(x) for x in found if x is not None)))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.doc_id, r.n_words, [i for s in r.hit_spans for i in range(s.start, s.end)], r.hit_items) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block_bytes", [1 << 24, 3000])
def test_same_as_all_windows(spark, frame, prose, block_bytes):
    r = random.Random(3)
    items = [*enumerate(prose(1, 25, 1, 40)), (None, "no id but words that are long enough to be found anywhere"), (90, None), (91, "?!"), (3, "a second text of item three, eleven words long all in all")]
    docs = []
    for i, text in enumerate(prose(2, 80, 0, 120)):
        w = text.split()
        if i % 3 == 0:
            source = words(items[r.randrange(25)][1])
            at = r.randrange(len(source))
            w[len(w) // 2 : len(w) // 2] = source[at : at + r.randint(5, 15)]
        docs.append((i, (", " if i % 2 else " ").join(w).upper() if i % 5 == 0 else "-".join(w)))
    docs += [(500, "No id, but WORDS that are long enough to be found anywhere!"), *EDGE]
    out = decontaminate.contamination(frame(docs), spark.createDataFrame(items, "item_id long, text string"), window=10, block_bytes=block_bytes)
    assert rows_of(out) == brute(docs, items, 10)


def test_own_columns_stay_and_clashing_ones_go(spark, frame):
    docs = frame([(1, "alpha beta gamma")]).withColumnRenamed("lang", "hit_items")
    out = decontaminate.contamination(docs, spark.createDataFrame([("i", "beta")], "item_id string, text string"))
    assert out.columns == ["doc_id", "text", "source", "n_chars", "n_words", "hit_spans", "hit_items"]
    assert out.first().hit_items == ["i"]


@pytest.mark.parametrize("docs,items", [([], [(1, "a b")]), ([(1, "a b")], []), ([], [])])
def test_empty_tables(spark, frame, docs, items):
    out = decontaminate.contamination(frame(docs), spark.createDataFrame(items, "item_id long, text string"))
    assert [r.hit_items for r in out.collect()] == [[]] * len(docs)


@settings(max_examples=100, deadline=None)
@given(st.text("ab c", max_size=300), st.lists(st.text("ab c", min_size=1, max_size=40), min_size=1, max_size=8, unique=True))
def test_search_finds_every_occurrence(text, patterns):
    import numpy as np

    data, wanted = text.encode(), [p.encode() for p in patterns]
    found = sorted(PatternSet(wanted).search(np.frombuffer(data, np.uint8)))
    assert found == sorted((i, k) for k, p in enumerate(wanted) for i in range(len(data)) if data.startswith(p, i))
