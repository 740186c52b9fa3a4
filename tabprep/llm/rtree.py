"""A bulk-loaded R-tree over count vectors, searched by an upper bound of the overlap.

A point counts a set's elements per group. Two sets share at most the sum over the groups of the
smaller count, and a set shares with any point of a node at most the sum of the smaller of its count
and the node's largest. A node is skipped when that bound is below the overlap that a link needs.
"""

from __future__ import annotations

import numpy as np

FANOUT = 16


def count_vectors(sets: list[np.ndarray], groups: int) -> np.ndarray:
    """One row per set: how many of its 64-bit elements fall into each of ``groups`` (a power of two)."""
    shift = np.uint64(64 - (groups.bit_length() - 1))
    sizes = np.array([len(s) for s in sets], np.int64)
    rows = np.repeat(np.arange(len(sets)), sizes)
    flat = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    cells = (flat >> shift).astype(np.int64) if groups > 1 else np.zeros(len(flat), np.int64)
    return np.bincount(rows * groups + cells, minlength=len(sets) * groups).reshape(len(sets), groups).astype(np.int32)


def needed(a, b, percent: int):
    """The least overlap of sets of sizes ``a`` and ``b`` whose Jaccard similarity reaches ``percent``."""
    return -((-percent * (a + b)) // (100 + percent))


class CountTree:
    """R-tree of points; ``search`` yields every point whose overlap bound allows a link."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, percent: int) -> None:
        self.percent = percent
        spread = np.argsort(-points.var(axis=0), kind="stable")[:4] if len(points) else np.zeros(0, np.int64)
        keys = [points[:, g] for g in spread[::-1]] + [np.asarray(sizes)]
        self.order = np.lexsort(keys) if len(points) else np.zeros(0, np.int64)
        self.points, self.sizes = points[self.order], np.asarray(sizes)[self.order]
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # per node: largest counts, least size
        high, least = self.points, self.sizes
        while len(high) > 1:
            cuts = np.arange(0, len(high), FANOUT)
            high, least = np.maximum.reduceat(high, cuts, axis=0), np.minimum.reduceat(least, cuts)
            self.levels.append((high, least))

    def search(self, vector: np.ndarray, size: int) -> np.ndarray:
        """Indices (of the points given) that may link with a set of this count vector and size."""
        if not len(self.points):
            return self.order
        nodes = np.arange(len(self.levels[-1][0])) if self.levels else np.zeros(1, np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            high, least = self.levels[depth]
            bound = np.minimum(vector, high[nodes]).sum(axis=1)
            nodes = nodes[bound >= needed(size, least[nodes], self.percent)]
            below = len(self.levels[depth - 1][0]) if depth else len(self.points)
            nodes = (nodes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            nodes = nodes[nodes < below]
        bound = np.minimum(vector, self.points[nodes]).sum(axis=1)
        return self.order[nodes[bound >= needed(size, self.sizes[nodes], self.percent)]]


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the similarity; exact."""
    if not len(a) or not len(b):
        return False
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    shared = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def spanning_links(sets: list[np.ndarray], percent: int, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect whatever all links connect; with ``side``, only pairs of unlike sides count.

    Every set queries the tree. Candidates already connected are skipped, as another link between
    them changes no component; all others are verified on the sets themselves.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    if n < 2:
        return []
    groups = 1 << max(4, min(9, int(np.ceil(np.log2(max(1.0, np.median(sizes)))))))
    points = count_vectors(sets, groups)
    tree = CountTree(points, sizes, percent)
    label = np.arange(n)
    members: dict[int, list[int]] = {i: [i] for i in range(n)}
    links = []
    for i in range(n):
        near = tree.search(points[i], sizes[i])
        near = near[near > i] if side is None else near[(side[near] != side[i]) & (near > i)]
        near = near[label[near] != label[i]]
        if len(near) > 1:
            near = near[np.argsort(-np.minimum(points[i], points[near]).sum(axis=1), kind="stable")]
        while len(near):
            j = int(near[0])
            if linked(sets[i], sets[j], percent):
                links.append((i, j))
                keep, gone = label[i], label[j]
                if len(members[keep]) < len(members[gone]):
                    keep, gone = gone, keep
                label[members[gone]] = keep
                members[keep] += members.pop(gone)
                near = near[label[near] != label[i]]
            else:
                near = near[1:]
    return links
