import random
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabprep.llm import jaccard_join, rtree
from tabprep.llm.graph import components

from .conftest import EDGE

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, size):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                label[root(i)] = root(j)
    groups = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        groups[root(i)].append(doc)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in groups.items()}
    return sorted(((d, len(s), least[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def copies(prose, seed, families=12, members=12):
    """Families of texts that differ in a few places, so that similarities fall on both sides of the limit."""
    r = random.Random(seed)
    rows, doc = [], 0
    for text in prose(seed, families, 20, 120):
        for _ in range(members):
            words = text.split()
            for _ in range(r.choice([0, 0, 1, 1, 2, 4, 8])):
                words[r.randrange(len(words))] = "".join(r.choice("xyz") for _ in range(4))
            if r.random() < 0.2:
                words = words[: -r.randint(1, 5)]
            rows.append((doc, " ".join(words).upper() if r.random() < 0.1 else "  ".join(words)))
            doc += 1
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("size,percent,chunk", [(3, 90, 2000), (5, 80, 2000), (5, 80, 4), (3, 90, 3)])
def test_same_components_as_all_pairs(frame, prose, size, percent, chunk):
    rows = copies(prose, seed=size * percent + chunk)
    out = jaccard_join.near_duplicates(frame(rows), shingle=size, percent=percent, chunk=chunk)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute(rows, size, percent)


def test_edge_rows_and_other_columns(frame):
    docs = frame(EDGE).withColumnRenamed("lang", "component_id").withColumnRenamed("source", "set_id")
    out = jaccard_join.near_duplicates(docs, shingle=3, percent=90).collect()
    assert sorted((tuple(r) for r in out), key=repr) == brute(EDGE, 3, 90)


def test_empty_table(frame):
    assert jaccard_join.near_duplicates(frame([])).collect() == []


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_linked_sets_share_a_page(percent):
    """Whatever a linked pair differs in, some slice of enough content is the same in both."""
    r = np.random.default_rng(percent)
    table = jaccard_join.bands(percent, 1 << 32)
    least = np.array([b[0] for b in table])

    def pages(s):
        return set(jaccard_join.page_keys(s, percent, table, least).tolist())

    for _ in range(300):
        n = int(r.integers(1, 400))
        a = np.unique(r.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        b = a.copy()
        while True:  # as unlike as may be
            c = b[r.random(len(b)) > 1 / max(2, len(b))] if r.random() < 0.5 else np.unique(np.r_[b, r.integers(0, 1 << 63, 1).astype(np.uint64)])
            if not rtree.linked(a, c, percent):
                break
            b = c
        assert np.array_equal(a, b) or pages(a) & pages(b)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 40), max_size=25), min_size=1, max_size=40), st.sampled_from([50, 80, 90]))
def test_tree_finds_every_linked_set(sets, percent):
    arrays = [np.array(sorted(s), np.uint64) * np.uint64(0x9E3779B97F4A7C15 % (1 << 58)) for s in sets]
    arrays = [np.sort(a) for a in arrays]
    points = rtree.count_vectors(arrays, 16)
    sizes = np.array([len(a) for a in arrays])
    tree = rtree.CountTree(points, sizes, percent)
    for i, a in enumerate(arrays):
        near = set(tree.search(points[i], sizes[i]).tolist())
        for j, b in enumerate(arrays):
            if rtree.linked(a, b, percent):
                assert j in near


@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80)])
def test_near_copies_of_very_long_texts(frame, size, percent):
    """Groups of such sets count some hundred shingles; a pair near the limit links, one beyond it does not."""
    base = [f"w{i}" for i in range(160_000)]

    def changed(tag, every):
        return " ".join(f"{tag}{i}" if i % every == 0 else w for i, w in enumerate(base))

    linked, beyond = {90: (60, 50), 80: (48, 40)}[percent]  # a change costs ``size`` shingles of each text
    more = [f"v{i}" for i in range(190_000)]
    rows = [(1, " ".join(base)), (2, changed("x", 160_001)), (3, changed("y", linked)), (4, changed("z", beyond)), (5, " ".join(more)), (6, " ".join([*more[:-1], "end"]))]
    out = jaccard_join.near_duplicates(frame(rows), shingle=size, percent=percent)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute(rows, size, percent)
    assert {r.doc_id: r.component_id for r in out.collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 5}


def test_counts_above_a_byte_are_kept():
    for n in (5, 3000, 200_000, 40_000_000):
        s = np.arange(n, dtype=np.uint64) << np.uint64(20)  # all in few groups
        groups = jaccard_join.groups_of(n)
        assert np.array_equal(jaccard_join._folded(jaccard_join.packed_counts(s), n, groups), rtree.count_vectors([s], groups)[0])
        assert jaccard_join._folded(jaccard_join.packed_counts(s), n, 16).sum() == n


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, j) for j in range(8, 60)] + [(5, 5), (1000, 999), (999, 1000), (-3, 7)]
    found = {r.node: r.label for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(found[i] == 100 for i in range(100, 141))
    assert all(found[j] == -3 for j in [7, *range(8, 60)]) and found[1000] == 999 and 5 not in found
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
