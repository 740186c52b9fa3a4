import random

import numpy as np
import pytest

from tabprep.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, rounds=6):
    """Every distance by itself: codes, errors, codebooks."""
    usable = [r for r in rows if r[1] and all(x is not None and np.isfinite(x) for x in r[1])]
    x = np.array([[int(np.floor(4096 * float(np.float32(c)))) for c in r[1]] for r in usable], np.int64)
    ids = sorted({r[0] for r in usable if r[0] is not None}) + [None] * any(r[0] is None for r in usable)
    first = [min(tuple(v) for v, r in zip(x.tolist(), usable) if r[0] == i) for i in ids[:16]]
    parts, books = np.split(x, 8, axis=1), [b.copy() for b in np.split(np.array(first, np.int64), 8, axis=1)]
    for _ in range(rounds + 1):
        square = [((p[:, None] - b[None]) ** 2).sum(-1) for p, b in zip(parts, books)]
        owner, last = [s.argmin(1) for s in square], [b.copy() for b in books]
        for p, b, o in zip(parts, books, owner):
            for e in range(len(b)):
                if (o == e).any():
                    b[e] = p[o == e].sum(0) // (o == e).sum()
    codes = ["".join(f"{o[i]:02x}" for o in owner) for i in range(len(usable))]
    errors = [int(sum(s[i, o[i]] for s, o in zip(square, owner))) for i in range(len(usable))]
    labels = {}
    for r, e in zip(usable, errors):
        labels[r[2]] = labels.get(r[2], 0) + e
    return sorted(repr((r[0], c, e, labels[r[2]])) for r, c, e in zip(usable, codes, errors)), last


def random_rows(seed, n, width=2, values=None):
    r = random.Random(seed)
    draw = (lambda: r.choice(values)) if values else (lambda: r.gauss(0, 0.3))
    return [(i, [draw() for _ in range(8 * width)], r.choice([0, 1, None])) for i in range(n)]


def coded(frame, rows, **how):
    codes, books = vc.coded(frame(rows, SCHEMA), **how)
    out = vc.with_label_errors(codes)
    return sorted(repr((r.vec_id, r.code, r.error, r.label_error)) for r in out.collect()), books


CASES = {
    "spread": random_rows(1, 700, 3),
    "ties": random_rows(2, 400, 2, [-1.0, -0.5, 0.0, 0.5, 1.0, 1e-4, -1e-4]),
    "copies": random_rows(3, 20, 1) + [(100 + i, [0.25] * 8, None) for i in range(600)] + [(5, [0.1] * 8, 1)] * 3,
    "few": random_rows(4, 5, 1),
    "bad": random_rows(5, 60, 1) + [(70, None, 1), (71, [], 1), (72, [None] + [0.5] * 7, 0), (73, [float("nan")] * 8, 0), (74, [float("inf")] * 8, None), (None, [0.5] * 8, None), (None, [0.125] * 8, 0)],
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_against_all_distances(frame, case):
    rows = CASES[case]
    want, books = plain(rows)
    got, found = coded(frame, rows, chunk=150)
    assert [b.tolist() for b in found] == [b.tolist() for b in books]
    assert got == want


def test_other_lengths_and_sizes_are_left_out(frame):
    rows = random_rows(6, 40, 2)
    assert coded(frame, [*rows, (90, [0.5] * 8, 1), (91, [0.5] * 7, 1), (-1, [0.5] * 9, 1), (92, [1e30] * 16, 1)])[0] == plain(rows)[0]


def test_nothing_and_clashing_names(frame):
    for rows in ([], [(1, None, 1)]):
        codes, books = vc.coded(frame(rows, SCHEMA))
        assert vc.with_label_errors(codes).collect() == [] and books == []
    clash = frame([(1, [0.5] * 8, "a", "x", 3)], "vec_id int, embedding array<double>, label string, code string, error int")
    (row,) = vc.with_label_errors(vc.coded(clash)[0]).collect()
    assert (row.vec_id, row.label, row.code, row.error, row.label_error) == (1, "a", "00" * 8, 0, 0)


@pytest.mark.parametrize("seed", range(3))
def test_balls_hold_what_they_cache(seed):
    r = np.random.default_rng(seed)
    points = np.unique(np.concatenate([r.integers(-50, 50, (400, 3)), [[10**6, 0, 0], [10**7, 1, 1]]]), axis=0)
    tree = vc.Tree(points, r.integers(1, 5, len(points)))
    assert sorted(tree.order.tolist()) == list(range(len(points)))
    for k in range(len(tree.start)):
        rows = tree.order[tree.start[k] : tree.end[k]]
        assert tree.counts[k] == tree.weights[rows].sum()
        assert (tree.sums[k] == (points[rows] * tree.weights[rows, None]).sum(0)).all()
        assert (np.sqrt(((points[rows] - tree.centres[k]) ** 2).sum(1)) <= tree.radius[k]).all()
        if tree.left[k] >= 0:
            assert tree.start[tree.left[k]] == tree.start[k] and tree.end[tree.left[k]] == tree.start[tree.right[k]] and tree.end[tree.right[k]] == tree.end[k]
        else:
            assert len(rows) <= vc.LEAF


def test_lists_shrink():
    """Far fewer distances than parts times entries, where parts lie in clusters; the same owners."""
    r = np.random.default_rng(4)
    centres = r.integers(-20_000, 20_000, (16, 4))
    points = np.unique(centres[r.integers(0, 16, 4000)] + r.integers(-300, 300, (4000, 4)), axis=0)
    tree = vc.Tree(points, np.ones(len(points), np.int64))
    entries, square = tree.assigned(centres)
    want = ((points[:, None] - centres[None]) ** 2).sum(-1)
    assert (entries == want.argmin(1)).all() and (square == want.min(1)).all()
    assert tree.seen < len(points) * 16 / 10
