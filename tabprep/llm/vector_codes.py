"""Product codes of vectors, with exact rounds of k-means over metric trees of their parts.

Vectors become integers and are cut into equal parts; each part position has a codebook of its own,
whose entries move to the floored means of the parts they are nearest to. Sums are integers, so
results are the same however the rows are dealt out.

Each task turns its vectors, some thousand at a time, into one metric tree for each part position, by
the anchors hierarchy: about as many anchors as the square root of the parts, each new one the part
farthest from its own anchor, take the parts that are nearer to them, are merged from the middle
out by the smallest ball that holds two of them, and are cut up in the same way below. A ball
caches the number and the sum of its parts. The trees are written once. In each round balls are
walked from the root with the list of entries that may own parts of them: entries that lose the
whole ball to another one leave the list, balls below inherit what is left, and a ball with one
entry left gives its cached sums without a look at its parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.staging import Scratch

PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Components are counted in steps of one such share.
SCALE = 4096
#: Vectors under one set of trees, as far as they hold so many components at most.
CHUNK = 4096
CHUNK_COMPONENTS = 1 << 20
#: Parts in a ball that is not divided further.
LEAF = 16


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return np.sqrt((d * d).sum(-1))


def _anchors(points: np.ndarray, inside: np.ndarray, count: int) -> list[np.ndarray]:
    """``inside`` (row numbers of ``points``) dealt to at most ``count`` anchors, none without parts."""
    own = np.zeros(len(inside), np.int64)
    at = points[inside]
    far = _distances(at, at[0])
    anchors = [at[0]]
    while len(anchors) < count:
        k = int(np.argmax(far))
        if far[k] == 0:
            break
        new = at[k]
        between = _distances(np.array(anchors), new)
        # a part nearer to its anchor than half the way to the new one cannot be nearer to that
        near = np.flatnonzero(far > between[own] / 2)
        to_new = _distances(at[near], new)
        stolen = to_new < far[near]
        own[near[stolen]] = len(anchors)
        far[near[stolen]] = to_new[stolen]
        anchors.append(new)
    groups = [inside[own == k] for k in range(len(anchors))]
    return [g for g in groups if len(g)]


class Tree:
    """Balls over the unlike rows of ``points``; ``weights`` tells how often each one occurs.

    Balls are numbered from the root down: ``left``/``right`` are the balls below (-1 for none) and
    ``start``/``end`` the range of ``order`` that a ball holds.
    """

    def __init__(self, points: np.ndarray, weights: np.ndarray) -> None:
        self.points, self.weights = points, weights
        real = points.astype(np.float64)
        children: list[tuple[int, int]] = []
        leaves: list[np.ndarray | None] = []

        def leaf(rows: np.ndarray) -> int:
            children.append((-1, -1))
            leaves.append(rows)
            return len(children) - 1

        def merged(nodes: list[int], centres: np.ndarray, radii: np.ndarray, sizes: np.ndarray) -> int:
            """The pair with the smallest common ball becomes one, until one is left."""
            n = len(nodes)
            gap = _distances(centres[:, None], centres[None])
            cost = np.maximum(np.maximum(radii[:, None], radii[None]), (radii[:, None] + radii[None] + gap) / 2)
            np.fill_diagonal(cost, np.inf)
            for _ in range(n - 1):
                i, j = divmod(int(np.argmin(cost)), n)
                radius = cost[i, j]
                children.append((nodes[i], nodes[j]))
                leaves.append(None)
                nodes[i] = len(children) - 1
                total = sizes[i] + sizes[j]
                centres[i] = (centres[i] * sizes[i] + centres[j] * sizes[j]) / total
                sizes[i], radii[i] = total, radius
                cost[j] = cost[:, j] = np.inf
                live = np.isfinite(cost[i])
                live[i] = False
                gap = _distances(centres[live], centres[i])
                cost[i, live] = cost[live, i] = np.maximum(np.maximum(radii[live], radius), (radii[live] + radius + gap) / 2)
                nodes[j] = -1
            return next(x for x in nodes if x >= 0)

        # subsets wait until their parts are built; a stack instead of recursion, as outliers can nest deeply
        results: list[int] = []
        work: list[tuple] = [("cut", np.arange(len(points)))]
        while work:
            task = work.pop()
            if task[0] == "cut":
                rows = task[1]
                if len(rows) <= LEAF:
                    results.append(leaf(rows))
                    continue
                groups = _anchors(real, rows, max(2, int(np.sqrt(len(rows)))))
                work.append(("join", groups))
                work += [("cut", g) for g in groups]
            else:
                groups = task[1]
                nodes = results[-len(groups) :][::-1]
                del results[-len(groups) :]
                centres = np.array([real[g].mean(0) for g in groups])
                radii = np.array([_distances(real[g], c).max() for g, c in zip(groups, centres)])
                results.append(merged(nodes, centres, radii, np.array([float(len(g)) for g in groups])))
        self._laid_out(results[0], children, leaves, real)

    def _laid_out(self, root: int, children: list, leaves: list, real: np.ndarray) -> None:
        number, order, spans = {}, [], {}
        stack = [(root, False)]
        at = 0
        while stack:
            node, closed = stack.pop()
            if closed:
                spans[node][1] = at
                continue
            number[node] = len(number)
            spans[node] = [at, at]
            if leaves[node] is not None:
                order.append(leaves[node])
                at += len(leaves[node])
                spans[node][1] = at
            else:
                stack += [(node, True), (children[node][1], False), (children[node][0], False)]
        nodes = sorted(number, key=number.get)
        self.order = np.concatenate(order)
        self.start = np.array([spans[n][0] for n in nodes])
        self.end = np.array([spans[n][1] for n in nodes])
        self.left = np.array([number.get(children[n][0], -1) for n in nodes])
        self.right = np.array([number.get(children[n][1], -1) for n in nodes])
        held = self.weights[self.order]
        running = np.zeros((len(held) + 1, real.shape[1]), np.int64)
        np.cumsum(self.points[self.order] * held[:, None], axis=0, out=running[1:])
        self.sums = running[self.end] - running[self.start]
        total = np.concatenate([[0], np.cumsum(held)])
        self.counts = total[self.end] - total[self.start]
        self.centres = self.sums / self.counts[:, None]
        placed = real[self.order]
        radius = [_distances(placed[a:b], c).max() for a, b, c in zip(self.start.tolist(), self.end.tolist(), self.centres)]
        self.radius = np.array(radius) * (1 + 1e-9) + 1e-9

    ARRAYS = ("points", "weights", "order", "start", "end", "left", "right", "sums", "counts", "centres", "radius")

    def packed(self) -> dict[str, bytes]:
        return {name: np.ascontiguousarray(getattr(self, name)).tobytes() for name in self.ARRAYS}

    @classmethod
    def unpacked(cls, row: dict, width: int) -> Tree:
        tree = object.__new__(cls)
        for name in cls.ARRAYS:
            flat = np.frombuffer(row[name], np.float64 if name in ("centres", "radius") else np.int64)
            setattr(tree, name, flat.reshape(-1, width) if name in ("points", "sums", "centres") else flat)
        return tree

    def nearest(self, book: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Balls and parts with their entry, level by level: whole balls, then (row numbers, entry of each).

        Yields (balls, their owner, no rows) and (rows, their entry, squared distance) in turn. An
        entry leaves a ball's list if another one is nearer to every point of it: if the ball lies
        beyond the plane half-way between the two. Ties never make an entry leave, but for equal
        entries, of which the first is nearest to all.
        """
        real = book.astype(np.float64)
        listed = np.ones(len(book), bool)
        listed[[k for k in range(1, len(book)) if (book[:k] == book[k]).all(1).any()]] = False
        apart = _distances(real[:, None], real[None])
        balls, lists = np.array([0]), listed[None]
        self.seen = 0  # distances from entries to balls and parts
        while len(balls):
            ball, entry = np.nonzero(lists)
            self.seen += len(ball)
            square = np.full(lists.shape, np.inf)
            gap = real[entry] - self.centres[balls[ball]]
            square[ball, entry] = (gap * gap).sum(1)
            first = square.argmin(1)
            least = square[np.arange(len(balls)), first][:, None]
            reach = 2 * (self.radius[balls][:, None] * (1 + 1e-9) + 1e-6) * apart[first]
            kept = lists & (square - least <= reach + 1e-9 * (square + least))
            kept[np.arange(len(balls)), first] = True
            owned = kept.sum(1) == 1
            yield balls[owned], first[owned], None
            balls, lists = balls[~owned], kept[~owned]
            ends = self.left[balls] < 0
            if ends.any():
                sizes = (self.end - self.start)[balls[ends]]
                rows = np.concatenate([np.arange(a, b) for a, b in zip(self.start[balls[ends]], self.end[balls[ends]])])
                allowed = np.repeat(lists[ends], sizes, axis=0)
                row, entry = np.nonzero(allowed)
                self.seen += len(row)
                exact = np.full(allowed.shape, np.iinfo(np.int64).max)
                gap = self.points[self.order[rows[row]]] - book[entry]
                exact[row, entry] = (gap * gap).sum(1)
                best = exact.argmin(1)
                yield self.order[rows], best, exact[np.arange(len(rows)), best]
            balls, lists = balls[~ends], lists[~ends]
            balls, lists = np.concatenate([self.left[balls], self.right[balls]]), np.concatenate([lists, lists])

    def totals(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum and number of the parts that are nearest to each entry."""
        sums, counts = np.zeros_like(book), np.zeros(len(book), np.int64)
        for which, entry, square in self.nearest(book):
            if square is None:
                np.add.at(sums, entry, self.sums[which])
                np.add.at(counts, entry, self.counts[which])
            else:
                np.add.at(sums, entry, self.points[which] * self.weights[which, None])
                np.add.at(counts, entry, self.weights[which])
        return sums, counts

    def assigned(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of each row of ``points``."""
        entries = np.zeros(len(self.points), np.int64)
        for which, entry, square in self.nearest(book):
            if square is None:
                for ball, e in zip(which.tolist(), entry.tolist()):
                    entries[self.order[self.start[ball] : self.end[ball]]] = e
            else:
                entries[which] = entry
        gap = self.points - book[entries]
        return entries, (gap * gap).sum(1)


_TREE = ", ".join(f"{name}: binary" for name in (*Tree.ARRAYS, "member"))
_ROW = f"rows array<struct<vec_id: long, label: string>>, trees array<struct<{_TREE}>>"
_ROW_TYPE = pa.schema([
    ("rows", pa.list_(pa.struct([("vec_id", pa.int64()), ("label", pa.string())]))),
    ("trees", pa.list_(pa.struct([(name, pa.binary()) for name in (*Tree.ARRAYS, "member")]))),
])


def _grow(width: int, chunk: int):
    """Sets of trees over the vectors of a task; ``member`` is the row of ``points`` that each vector's part is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                part = batch.slice(at, chunk)
                flat = part.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                vectors = flat.reshape(part.num_rows, PARTS, width)
                trees = []
                for k in range(PARTS):
                    points, member, weights = np.unique(vectors[:, k], axis=0, return_inverse=True, return_counts=True)
                    trees.append(Tree(points, weights.astype(np.int64)).packed() | {"member": member.reshape(-1).astype(np.int64).tobytes()})
                rows = [{"vec_id": i, "label": x} for i, x in zip(part.column("vec_id").to_pylist(), part.column("label").to_pylist())]
                yield pa.RecordBatch.from_pylist([{"rows": rows, "trees": trees}], schema=_ROW_TYPE)

    return run


def _sum_up(books: list[np.ndarray], width: int):
    """What one task's trees give to each entry; one row for each entry and component."""
    schema = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("place", pa.int32()), ("total", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((PARTS, len(books[0]), width), np.int64)
        counts = np.zeros((PARTS, len(books[0])), np.int64)
        for batch in batches:
            for row in batch.column("trees"):
                for k, tree in enumerate(row.as_py()):
                    s, c = Tree.unpacked(tree, width).totals(books[k])
                    sums[k] += s
                    counts[k] += c
        part, entry, place = np.nonzero(np.broadcast_to(counts[:, :, None], sums.shape))
        yield pa.RecordBatch.from_arrays([*(pa.array(x.astype(np.int32)) for x in (part, entry, place)), pa.array(sums[part, entry, place]), pa.array(counts[part, entry])], schema=schema)

    return run


def _label(books: list[np.ndarray], width: int):
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("code", pa.string()), ("error", pa.int64())])
    digits = np.array([f"{k:02x}" for k in range(256)], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, trees in zip(batch.column("rows"), batch.column("trees")):
                rows, code, error = rows.as_py(), "", np.int64(0)
                for k, row in enumerate(trees.as_py()):
                    member = np.frombuffer(row["member"], np.int64)
                    entries, square = Tree.unpacked(row, width).assigned(books[k])
                    code = code + digits[entries[member]]
                    error = error + square[member]
                yield pa.RecordBatch.from_arrays([pa.array([r["vec_id"] for r in rows], pa.int64()), pa.array([r["label"] for r in rows], pa.string()), pa.array(code, pa.string()), pa.array(error)], schema=schema)

    return run


def whole(embeddings: DataFrame) -> DataFrame:
    """``vec_id``, ``label`` (as text), ``vector`` of integers, for the rows that can be coded.

    Left out: null vectors, vectors with a null or non-finite component or with one that is too
    large for distances to be whole 64-bit numbers (32,768 and more at 64 components), and vectors
    of another length than that of the smallest remaining id whose length is a multiple of ``PARTS``.
    """
    v = F.col("embedding")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), v.cast("array<double>").alias("v"))
    fit = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit((1 << 30) / SCALE) / F.sqrt(F.size("v"))))
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & (F.size("v") % PARTS == 0) & F.coalesce(fit, F.lit(False)))
    first = rows.agg(F.min_by(F.size("v"), F.struct(F.col("vec_id").isNull(), "vec_id", "v"))).first()[0]
    return rows.where(F.size("v") == (first or 0)).select("vec_id", "label", F.transform("v", lambda x: F.floor(x * SCALE).cast("long")).alias("vector"))


def first_books(vectors: DataFrame) -> list[np.ndarray]:
    """The codebooks that the ``ENTRIES`` smallest ids begin; of rows that share an id, the least vector."""
    ids = [r["vec_id"] for r in vectors.select("vec_id").distinct().orderBy(F.col("vec_id").asc_nulls_last()).limit(ENTRIES).collect()]
    among = F.col("vec_id").isin([i for i in ids if i is not None])
    chosen = vectors.where(among | F.col("vec_id").isNull() if None in ids else among).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    start = np.array([r["vector"] for r in chosen.orderBy(F.col("vec_id").asc_nulls_last()).collect()], np.int64)
    return [np.ascontiguousarray(p) for p in np.split(start, PARTS, axis=1)]


def coded(embeddings: DataFrame, rounds: int = ROUNDS, chunk: int = CHUNK) -> tuple[DataFrame, list[np.ndarray]]:
    """``vec_id``, ``label``, ``code``, ``error`` of every row that can be coded, and the codebooks by part.

    Rows may repeat; null ids and null labels stay. Without a row that can be coded the result is
    empty and there are no codebooks. Fewer ids than ``ENTRIES`` make smaller codebooks. Only sums,
    of the size of the codebooks, come to the driver.
    """
    scratch = Scratch(embeddings.sparkSession, "codes")
    vectors = scratch.write(whole(embeddings))
    some = vectors.select(F.size("vector").alias("n")).first()
    if some is None:
        return embeddings.sparkSession.createDataFrame([], "vec_id long, label string, code string, error long"), []
    width = some["n"] // PARTS
    books = first_books(vectors)
    chunk = max(1, min(chunk, CHUNK_COMPONENTS // some["n"]))
    trees = scratch.write(vectors.mapInArrow(_grow(width, chunk), _ROW))
    for _ in range(rounds):
        sums = trees.select("trees").mapInArrow(_sum_up(books, width), "part int, entry int, place int, total long, n long")
        sums = sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        for r in sums.collect():
            books[r["part"]][r["entry"], r["place"]] = r["total"] // r["n"]
    return trees.mapInArrow(_label(books, width), "vec_id long, label string, code string, error long"), books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components by part, entry and place, in decimal, joined by commas."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.reshape(-1).tolist()).encode()).hexdigest()


def with_label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` with ``label_error``: the error of all rows with the same label; null labels are one."""
    scratch = Scratch(codes.sparkSession, "labels")
    codes = scratch.write(codes)
    sums = scratch.write(codes.groupBy("label").agg(F.sum("error").alias("label_error")))
    sums = sums.withColumnRenamed("label", "_label")
    return codes.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
