"""Best-fit packing by a grouping genetic algorithm on islands.

Documents are encoded, cut where they are too long, and their pieces put into sequences of a fixed
number of tokens. Pieces are dealt out in shards of some thousand; on each shard several islands
evolve groupings. Crossover injects whole well-filled sequences of one parent into another, removes
the sequences that hold pieces twice, and best-fits the displaced pieces. The elites of a shard's
islands then migrate to one island, which goes on from all of them. Pieces of sequences that stayed
ill-filled go to the next, smaller set of shards, where they meet others.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from tabprep.llm import scan
from tabprep.llm.staging import Scratch
from tabprep.llm.tokens import default_tokenizer, encoder

#: Pieces of one shard, islands on it, and rounds of shards.
SHARD = 4096
ISLANDS = 2
LEVELS = 3
#: Size of an island's population, and its generations in each epoch.
POPULATION = 4
GENERATIONS = 8


def best_fit(lengths: list[int], room: dict[int, list[int]], capacity: int, new: int) -> list[int]:
    """Bin of each length, the fullest bin that has room for it; ``room`` lists open bins by free space.

    Bins from ``new`` on are opened as needed. Free spaces are kept as bits of one number, so the
    tightest fit is found without a search. ``room`` is used up.
    """
    mask = 0
    for free in room:
        mask |= 1 << free
    out = []
    for n in lengths:
        fits = mask >> n
        if fits:
            free = n + (fits & -fits).bit_length() - 1
            stack = room[free]
            b = stack.pop()
            if not stack:
                mask ^= 1 << free
                del room[free]
        else:
            free, b, new = capacity, new, new + 1
        left = free - n
        if left:
            if left in room:
                room[left].append(b)
            else:
                room[left] = [b]
                mask |= 1 << left
        out.append(b)
    return out


class Island:
    """A population of groupings of the same pieces; fewer bins are better, then fuller ones."""

    def __init__(self, lengths: np.ndarray, capacity: int, seed: int) -> None:
        self.lengths, self.capacity = lengths, capacity
        self.random = np.random.default_rng(seed)
        self.least = -(-int(lengths.sum()) // capacity)

    def fills(self, bins: np.ndarray) -> np.ndarray:
        return np.bincount(bins, weights=self.lengths).astype(np.int64)

    def fitness(self, bins: np.ndarray) -> tuple[int, float]:
        fill = self.fills(bins)
        fill = fill[fill > 0]
        return -len(fill), float(((fill / self.capacity) ** 2).mean())

    def packed(self, order: np.ndarray) -> np.ndarray:
        bins = np.empty(len(self.lengths), np.int64)
        bins[order] = best_fit(self.lengths[order].tolist(), {}, self.capacity, 0)
        return bins

    def first(self, noise: float) -> np.ndarray:
        """Best fit by falling length, the lengths blurred by ``noise``."""
        blurred = self.lengths * (1 + noise * self.random.random(len(self.lengths)))
        return self.packed(np.argsort(-blurred, kind="stable"))

    def mended(self, bins: np.ndarray, out: np.ndarray) -> np.ndarray:
        """``bins`` with the pieces at ``out`` taken from it and best-fitted again, longest first."""
        rest = np.ones(len(bins), bool)
        rest[out] = False
        fill = np.bincount(bins[rest], weights=self.lengths[rest], minlength=int(bins.max()) + 1).astype(np.int64)
        room: dict[int, list[int]] = {}
        for b in np.flatnonzero((fill > 0) & (fill < self.capacity)).tolist():
            room.setdefault(int(self.capacity - fill[b]), []).append(b)
        out = out[np.argsort(-self.lengths[out], kind="stable")]
        child = bins.copy()
        child[out] = best_fit(self.lengths[out].tolist(), room, self.capacity, len(fill))
        return np.unique(child, return_inverse=True)[1]

    def crossed(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """``one`` with a share of the best-filled bins of ``other`` injected whole."""
        fill = self.fills(other)
        best = np.argsort(-(fill + self.random.random(len(fill))), kind="stable")
        count = max(1, int(len(fill) * self.random.uniform(0.05, 0.25)))
        chosen = np.zeros(len(fill), bool)
        chosen[self.random.permutation(best[: max(1, len(best) // 2)])[:count]] = True
        injected = chosen[other]
        broken = np.zeros(int(one.max()) + 1, bool)
        broken[one[injected]] = True
        child = one.copy()
        child[injected] = other[injected] + len(broken)
        return self.mended(child, np.flatnonzero(broken[one] & ~injected))

    def shaken(self, bins: np.ndarray) -> np.ndarray:
        """The emptiest bins and some others dissolved and their pieces best-fitted."""
        fill = self.fills(bins)
        broken = self.random.random(len(fill)) < 0.02
        broken[np.argsort(fill, kind="stable")[: max(2, len(fill) // 50)]] = True
        return self.mended(bins, np.flatnonzero(broken[bins]))

    def evolved(self, migrants: list[np.ndarray], population: int, generations: int) -> np.ndarray:
        living = [*migrants, self.first(0.0)]
        scored = sorted(((self.fitness(b), i, b) for i, b in enumerate(living)), reverse=True)
        made = len(living)
        while len(scored) < population and -scored[0][0][0] > self.least:
            b = self.first(0.1 * len(scored))
            scored = sorted([*scored, (self.fitness(b), made, b)], reverse=True)
            made += 1
        for _ in range(generations):
            if -scored[0][0][0] <= self.least or len(scored) < 2:
                break  # no grouping has fewer bins
            children = []
            for k in range(len(scored)):
                i, j = sorted(self.random.choice(len(scored), 2, replace=False))
                child = self.crossed(scored[i][2], scored[j][2])
                if k % 2:
                    child = self.shaken(child)
                children.append((self.fitness(child), made, child))
                made += 1
            scored = sorted([*scored, *children], reverse=True)[: max(2, population)]
        return scored[0][2]


_PIECES = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.list_(pa.int32())), ("ids_crc32", pa.int64())])
PIECES = "uid long, doc_id long, piece int, start long, length long, ids array<int>, ids_crc32 long"


def _cut(path: str, capacity: int, ending: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).ids
        uid = TaskContext.get().partitionId() << 33
        for rows, _, _ in scan.slices(batches, "text"):
            out: list[tuple] = []
            for doc_id, text in zip(rows.column("doc_id").to_pylist(), rows.column("text").to_pylist()):
                ids = np.array([*encode(text or ""), ending], "<u4")
                first = (len(ids) - 1) % capacity + 1
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                for piece, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                    part = ids[a:b]
                    out.append((uid, doc_id, piece, a, b - a, part.astype(np.int32) if with_ids else None, zlib.crc32(part.tobytes())))
                    uid += 1
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], _PIECES.field(i).type) for i in range(len(_PIECES))], schema=_PIECES)

    return run


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = 1024, ending: int = 2, with_ids: bool = True) -> DataFrame:
    """The encoded documents in pieces of at most ``capacity`` tokens, each document ended by id ``ending``.

    Only longer documents are cut, into full pieces after a first that may be shorter. ``uid`` tells
    pieces apart; write the result before using it twice.
    """
    docs = docs.select(docs.doc_id.cast("long").alias("doc_id"), docs.text.cast("string").alias("text"))
    return docs.mapInArrow(_cut(tokenizer or default_tokenizer(), capacity, ending, with_ids), PIECES)


PLACED = "uid long, length long, shard long, island int, bin long, fill long, offset long"


def _isle(capacity: int, merge: bool):
    def run(key, rows):
        shard, island = int(key[0]), int(key[1])
        rows = rows.sort_values(["island", "uid"], kind="stable")
        parts = [p for _, p in rows.groupby("island", sort=True)] if merge else [rows]
        base = parts[0]
        lengths = base["length"].to_numpy(np.int64)
        grown = Island(lengths, capacity, (shard * 31 + island) * 2 + merge)
        migrants = [np.unique(p["bin"].to_numpy(), return_inverse=True)[1] for p in parts] if merge else []
        bins = grown.evolved(migrants, POPULATION + island, GENERATIONS)
        out = pd.DataFrame({"uid": base["uid"].to_numpy(), "length": lengths, "shard": shard, "island": island, "bin": bins})
        out["fill"] = grown.fills(bins)[bins]
        out["offset"] = out.groupby("bin")["length"].cumsum() - out["length"]
        return out

    return run


def grouped(items: DataFrame, capacity: int, shard: int = SHARD, levels: int = LEVELS) -> DataFrame:
    """``uid``, ``sequence_id``, ``offset`` for items (``uid``, ``length`` up to ``capacity``).

    Full items are sequences of their own. The rest is packed level by level; sequences filled to
    the last hundredth are final, the pieces of others meet anew until a level is one shard.
    """
    scratch = Scratch(items.sparkSession, "packing")
    items = items.select("uid", "length")
    done = [items.where(F.col("length") >= capacity).select("uid", (F.lit(1 << 62) + F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    rest = items.where(F.col("length") < capacity)
    for level in range(levels):
        count = rest.count()
        if not count:
            break
        shards = max(1, -(-count // shard))
        placed = rest.withColumn("shard", F.pmod(F.xxhash64(F.lit(level), "uid"), F.lit(shards)))
        placed = placed.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))))
        placed = placed.groupBy("shard", "island").applyInPandas(_isle(capacity, False), PLACED)
        merged = placed.withColumn("target", F.lit(0)).groupBy("shard", "target").applyInPandas(_isle(capacity, True), PLACED)
        merged = scratch.write(merged)
        last = level == levels - 1 or shards == 1
        final = F.lit(True) if last else F.col("fill") * 100 >= capacity * 99
        number = F.lit(level << 58) + F.shiftleft(F.col("shard"), 20) + F.col("bin")
        done.append(merged.where(final).select("uid", number.alias("sequence_id"), "offset"))
        if last:
            break
        rest = merged.where(~final).select("uid", "length")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def packed(docs: DataFrame, tokenizer: str | None = None, capacity: int = 1024, ending: int = 2, with_ids: bool = True) -> DataFrame:
    """Every piece with its place: ``doc_id``, ``piece``, ``start``, ``length``, ``ids``, ``ids_crc32``, ``sequence_id``, ``offset``.

    A sequence is its pieces in the order of ``offset``, gapless from 0, at most ``capacity`` tokens.
    A null or empty text is one piece that holds the ending alone. Repeated rows are packed each for
    itself; null ids are kept; an empty table gives no pieces; further columns are ignored.
    Without ``with_ids``, ``ids`` is null and only its checksum is kept.
    """
    scratch = Scratch(docs.sparkSession, "pieces")
    cut = scratch.write(pieces(docs, tokenizer, capacity, ending, with_ids))
    places = grouped(cut, capacity)
    return cut.join(places, "uid").drop("uid")
