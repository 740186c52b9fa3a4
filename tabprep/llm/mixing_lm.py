"""Language-model scoring by online logistic mixing of hashed-context bit predictors.

Bytes are coded by a binary tree that depends on the byte before; each step down the tree is one bit
to predict. Several predictors look at that bit in different contexts: the node hashed with the last
four bytes, with the last five, and with the word so far. Each has counted its bits over all training
documents. Their log odds are combined by weights that a gate picks; the weights start
from a fit over all training documents and are refined online within each document, block by block, so that
every bit is predicted from what came before it. A score is the log probability of all bits, with an
end mark after each text, hence a proper probability.

Tables have a slot for so many training bytes. Counts are summed by Spark in blocks of slots; where
tables are too large for arrays, tasks send only the slots that they saw.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from tabprep.llm import scan
from tabprep.llm.staging import Scratch, even_keys

END = 256
SYMBOLS = 257
#: Least slots of each hashed predictor, as a power of two, and the bits of a hash.
SLOT_BITS, MOST_BITS = 20, 32
#: Training symbols for each slot where the least slots are too few.
SYMBOLS_A_SLOT = 512
#: Bytes of a document between two refinements of its weights, and the size of a refinement.
BLOCK = 512
RATE = 0.001
GATES = 4
CONTEXTS = 3
#: Weights before any fit; the fit holds to them about as much as to one bit.
PRIOR = 0.3
#: Added to both counts of a slot; its log odds are kept in eighths.
BLUR = 0.1
EIGHTHS = 8
#: Steps of the table that turns log odds into costs and probabilities.
FINE, MOST = 64, 24 * 64


@dataclass
class Tree:
    """Codes of every symbol after every byte: where each begins, how long it is, and its nodes and bits."""

    start: np.ndarray
    length: np.ndarray
    node: np.ndarray
    bit: np.ndarray

    def steps(self) -> np.ndarray:
        """Twice the node, and the bit."""
        return 2 * self.node.astype(np.int64) + self.bit

    def gates(self) -> np.ndarray:
        """Each bit's gate: how far down its code it is, up to the last gate."""
        return np.minimum(np.arange(len(self.node)) - np.repeat(self.start, self.length), GATES - 1)


def tree(pairs: np.ndarray) -> Tree:
    """Huffman codes from counts of (byte before, symbol); every symbol has a code."""
    start, length = np.zeros(256 * SYMBOLS, np.int32), np.zeros(256 * SYMBOLS, np.int32)
    nodes, bits = [], []
    for before, counts in enumerate(pairs.reshape(256, SYMBOLS).tolist()):
        heap = [(8 * c + 1, s) for s, c in enumerate(counts)]
        heapq.heapify(heap)
        parent = [0] * (2 * SYMBOLS - 1)
        side = [0] * (2 * SYMBOLS - 1)
        new = SYMBOLS
        while len(heap) > 1:
            (a, x), (b, y) = heapq.heappop(heap), heapq.heappop(heap)
            parent[x] = parent[y] = new
            side[y] = 1
            heapq.heappush(heap, (a + b, new))
            new += 1
        root = new - 1
        for s in range(SYMBOLS):
            path = []
            x = s
            while x != root:
                path.append((parent[x] - SYMBOLS, side[x]))
                x = parent[x]
            k = before * SYMBOLS + s
            start[k], length[k] = len(nodes), len(path)
            for n, b in reversed(path):
                nodes.append(n)
                bits.append(b)
    return Tree(start, length, np.array(nodes, np.int32), np.array(bits, np.int8))


@dataclass
class Symbols:
    """Symbols of some documents, each ended, with the byte before and the hashed contexts of each."""

    pair: np.ndarray  # byte before and symbol, as one number
    contexts: list[np.ndarray]
    begin: np.ndarray  # first symbol of each document, and the end


_SALTS = np.array([0x9E3779B1, 0x85EBCA6B, 0x165667B1], np.uint32)


def slot_bits(trained: int) -> int:
    """Slots of each predictor, as a power of two, for so many symbols of training documents."""
    return min(MOST_BITS, max(SLOT_BITS, (trained // SYMBOLS_A_SLOT - 1).bit_length()))


def symbols(raw: np.ndarray, offsets: np.ndarray, hashed: bool = True, bits: int = SLOT_BITS) -> Symbols:
    docs = len(offsets) - 1
    sym = np.insert(raw.astype(np.int32), offsets[1:], END)
    begin = offsets + np.arange(docs + 1)
    byte = (sym & 0xFF).astype(np.uint32)
    first = begin[:-1]
    # an end mark reads as nought, and nothing before it is seen
    back = np.concatenate([np.zeros(1, np.uint32), byte[:-1]])
    back[first] = 0
    pair = back.astype(np.int64) * SYMBOLS + sym
    if not hashed:
        return Symbols(pair, [], begin)
    with np.errstate(over="ignore"):
        heads = [at[at < begin[1:]] for at in (first + k for k in range(5))]

        def before(k: int) -> np.ndarray:
            seen = np.zeros(len(sym), np.uint32)
            seen[k:] = byte[:-k]
            for head in heads[:k]:
                seen[head] = 0
            return seen

        four = back | before(2) << np.uint32(8) | before(3) << np.uint32(16) | before(4) << np.uint32(24)
        fifth = before(5)
        up, down = scan._POWERS.upto(len(sym) + 1)
        total = np.zeros(len(sym) + 1, np.uint64)
        np.cumsum(scan._VALUES.take(byte) * up[:-1], out=total[1:])
        gap = scan.SPACE.take(back)
        gap[first] = True
        since = np.flatnonzero(gap)
        runs = np.diff(since, append=len(sym))
        word = ((total[:-1] - np.repeat(total[since], runs)) * np.repeat(down[since], runs) >> np.uint64(32)).astype(np.uint32)
        five = (four * _SALTS[0] ^ fifth * _SALTS[2]) * _SALTS[1]
        last = np.uint32(32 - bits)
        # twice a slot and a bit more must fit
        return Symbols(pair, [(c >> last).astype(np.int32 if bits < 30 else np.int64) for c in (four * _SALTS[1], five, word * _SALTS[0])], begin)


def _levels(codes: Tree, pair: np.ndarray, contexts: list[np.ndarray], owner: np.ndarray, last: int | None = None):
    """The bits of some symbols, level by level down the trees: depth, owners, bits, and slots in each predictor.

    A symbol's slots lie side by side: its context, hashed, and the number of the node. Levels from
    ``last`` on come together, one symbol after the other.
    """
    left, at = codes.length.take(pair), codes.start.take(pair)
    depth = 0
    while len(at):
        if depth == last:
            left -= depth
            owner, contexts = np.repeat(owner, left), [np.repeat(c, left) for c in contexts]
            at = np.repeat(at - (np.cumsum(left, dtype=np.int32) - left), left)
            at += np.arange(len(at), dtype=np.int32)
            left = np.full(len(at), depth + 1, np.int32)
        node = codes.node.take(at)
        yield depth, owner, codes.bit.take(at), [c + node for c in contexts]
        depth += 1
        keep = np.flatnonzero(left > depth)
        left, at, owner = left.take(keep), at.take(keep), owner.take(keep)
        at += 1
        contexts = [c.take(keep) for c in contexts]


#: Symbols whose bits are spread out together.
_SPREAD = 1 << 17


def _spread(codes: Tree, step: np.ndarray, s: Symbols) -> Iterator[tuple[np.ndarray, Iterator[np.ndarray]]]:
    """All bits of some symbols, one symbol after the other: their places in the codes, and twice the slot, and the bit, in each predictor."""
    for a in range(0, len(s.pair), _SPREAD):
        b = a + _SPREAD
        length = codes.length.take(s.pair[a:b]).astype(np.int64)
        at = np.repeat(codes.start.take(s.pair[a:b]) - (np.cumsum(length) - length), length)
        at += np.arange(len(at))
        own = step.take(at)
        yield at, (np.repeat(2 * c[a:b].astype(np.int64), length) + own for c in s.contexts)


#: Nodes of one tree; the last contexts' slots reach beyond the rest by as many.
_NODES = 256
_SIZES = [(1 << SLOT_BITS) + _NODES] * CONTEXTS
#: Counts are summed in blocks of this many slots.
_COUNT_BLOCK = 1 << 16


#: Parts of one predictor are numbered below this.
_PARTS = 1 << 20
#: Tables of so many slots, as a power of two, are counted in whole arrays; of larger ones, what was seen.
_WHOLE_BITS = 22
#: Distinct slots and bits that a task holds before it sends them on.
_HELD = 1 << 22


def _counted(codes: Tree, bits: int):
    """Of one partition: how often each predictor saw each bit in each slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        counts = None
        step = codes.steps()
        held: list[list] = [[] for _ in range(CONTEXTS)]
        for _, raw, offsets in scan.slices(batches, "text", 1 << 20):
            if bits <= _WHOLE_BITS:
                counts = counts or [np.zeros(2 * ((1 << bits) + _NODES), np.int64) for _ in range(CONTEXTS)]
            s = symbols(raw, offsets, bits=bits)
            for _, spread in _spread(codes, step, s):
                for k, places in enumerate(spread):
                    if counts:
                        np.add.at(counts[k], places, 1)
                        continue
                    held[k].append(np.unique(places, return_counts=True))
                    if sum(len(x) for x, _ in held[k]) >= _HELD:
                        yield from _sparse_rows(k, number, held[k])
                        held[k] = []
        for k, total in enumerate(counts or []):
            for part, at in enumerate(range(0, len(total), 2 * _COUNT_BLOCK)):
                block = total[at : at + 2 * _COUNT_BLOCK]
                if block.any():
                    yield _count_row(k * _PARTS + part, number, block)
        for k, rest in enumerate(held):
            if rest:
                yield from _sparse_rows(k, number, rest)

    return run


def _sparse_rows(k: int, number: int, held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Counts by place of one predictor, added up, as rows of the blocks that they touch."""
    places, local = np.unique(np.concatenate([x for x, _ in held]), return_inverse=True)
    counts = np.bincount(local, np.concatenate([c for _, c in held]), len(places)).astype(np.int64)
    part = places // (2 * _COUNT_BLOCK)
    cuts = np.r_[0, np.flatnonzero(part[1:] != part[:-1]) + 1, len(part)]
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        yield _count_row(k * _PARTS + int(part[a]), number, counts[a:b], places[a:b] % (2 * _COUNT_BLOCK))


def _count_row(part: int, source: int, block: np.ndarray, places: np.ndarray | None = None) -> pa.RecordBatch:
    small = block.max() < 1 << 31
    at = None if places is None else places.astype("<u4").tobytes()
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([source], pa.int64()), pa.array([small]), pa.array([at], pa.binary()), pa.array([block.astype("<i4" if small else "<i8").tobytes()], pa.binary())], names=["part", "source", "small", "places", "counts"])


#: ``places`` of the block that ``counts`` belong to; null where all are given.
COUNTS = "part int, source long, small boolean, places binary, counts binary"
#: Arrays that one sum takes in; sums of sums follow.
_FAN = 64


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of counts as part, source, places (all where null) and counts."""
    for batch in batches:
        for part, source, small, places, data in zip(*(batch.column(c) for c in ("part", "source", "small", "places", "counts"))):
            at = np.frombuffer(places.as_buffer(), "<u4") if places.is_valid else slice(None)
            yield part.as_py(), source.as_py(), at, np.frombuffer(data.as_buffer(), "<i4" if small.as_py() else "<i8")


def _summed(fan: int, bits: int):
    """Rows sorted by part and source: the sum of each ``fan`` neighbouring sources, one array at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None
        for part, source, at, counts in _blocks(batches):
            if (part, source // fan) != key:
                if key is not None:
                    yield _count_row(*key, total)
                key = part, source // fan
                total = np.zeros(2 * min(_COUNT_BLOCK, (1 << bits) + _NODES - part % _PARTS * _COUNT_BLOCK), np.int64)
            total[at] += counts
        if key is not None:
            yield _count_row(*key, total)

    return run


def _odds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Summed blocks to the log odds of their slots, in eighths."""
    for part, _, _, c in _blocks(batches):
        odds = np.clip(np.rint(EIGHTHS * np.log((c[1::2] + BLUR) / (c[0::2] + BLUR))), -127, 127).astype(np.int8)
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([odds.tobytes()], pa.binary())], names=["part", "table"])


#: Bins of log odds, for the fit of the starting weights: their edges, and the odds that stand for each.
_EDGES = np.array([0.25, 0.5, 0.75, 1, 1.5, 2, 2.5, 3, 3.5, 4, 5, 6, 7, 8.5, 10.5])
_EDGES = np.r_[-_EDGES[::-1], 0, _EDGES]
_MIDDLES = (np.r_[-12, _EDGES] + np.r_[_EDGES, 12]) / 2
_BIN_BITS = 5
_GATE_AT = CONTEXTS * _BIN_BITS + 1


def _left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Summed blocks to the bins of the log odds that each slot has without one of its noughts, and without one of its ones."""
    for part, _, _, c in _blocks(batches):
        zero, one = c[0::2], c[1::2]
        odds = np.stack([np.log((one + BLUR) / (np.maximum(zero - 1, 0) + BLUR)), np.log((np.maximum(one - 1, 0) + BLUR) / (zero + BLUR))], axis=1)
        bins = np.searchsorted(_EDGES, odds.ravel(), "right").astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([bins.tobytes()], pa.binary())], names=["part", "table"])


def _joint(codes: Tree, bins: list[np.ndarray], bits: int):
    """Of one partition: how many bits have which gate, bins and value; each is left out of its own odds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, marks = codes.steps(), codes.gates() << _GATE_AT | codes.bit
        counts = np.zeros(GATES << _GATE_AT, np.int64)
        for _, raw, offsets in scan.slices(batches, "text", 1 << 20):
            for at, spread in _spread(codes, step, symbols(raw, offsets, bits=bits)):
                joint = np.zeros(len(at), np.uint16)
                for table, places in zip(bins, spread):
                    joint <<= _BIN_BITS
                    joint |= table.take(places)
                cells = joint.astype(np.int64)
                cells <<= 1
                cells |= marks.take(at)
                np.add.at(counts, cells, 1)
        cells = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(counts[cells])], names=["cell", "n"])

    return run


def _first_weights(cells: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Starting weights, gate by gate: those of least cost over all counted bits, by Newton's method."""
    weights = np.full((GATES, CONTEXTS), PRIOR)
    odds = _MIDDLES[cells[:, None] >> 1 + _BIN_BITS * np.arange(CONTEXTS - 1, -1, -1) & (1 << _BIN_BITS) - 1]
    for gate in range(GATES):
        here = cells >> _GATE_AT == gate
        x, count, sign = odds[here], n[here].astype(np.float64), 2 * (cells[here] & 1) - 1

        def cost(w):
            return count @ np.logaddexp(0, -sign * (x @ w)) + ((w - PRIOR) ** 2).sum() / 2

        w = weights[gate].copy()
        for _ in range(50):
            wrong = np.exp(-np.logaddexp(0, sign * (x @ w)))
            slope = (count * sign * wrong) @ x - (w - PRIOR)
            move = np.linalg.solve((x * (count * wrong * (1 - wrong))[:, None]).T @ x + np.eye(CONTEXTS), slope)
            now = cost(w)
            while np.abs(move).max() > 1e-9 and cost(w + move) > now:
                move = move / 2
            if np.abs(move).max() <= 1e-9:
                break
            w = w + move
        weights[gate] = w
    return weights


@dataclass
class Mixer:
    codes: Tree
    odds: list[np.ndarray]  # of each predictor: log odds by slot, in eighths
    weights: np.ndarray  # starting weights: gates by predictors

    def __post_init__(self) -> None:
        self.bits = (len(self.odds[0]) - _NODES).bit_length() - 1
        z = np.arange(-MOST, MOST + 1) / FINE
        self.cost = np.stack([np.logaddexp(0, z), np.logaddexp(0, -z)], axis=1).ravel() / np.log(10)
        chance = (1 / (1 + np.exp(-z))).astype(np.float32)
        self.error = np.stack([np.float32(0) - chance, np.float32(1) - chance], axis=1).ravel()

    def scores(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Log10 probability of each document, its end included."""
        s = symbols(raw, offsets, bits=self.bits)
        sizes = np.diff(s.begin)
        docs = len(sizes)
        # longest first: those that go on after a block come before those that end in it
        ranked = np.argsort(-sizes, kind="stable")
        begin, sizes = s.begin[ranked], sizes[ranked]
        weights = np.repeat(self.weights[None].astype(np.float32), docs, axis=0)
        total = np.zeros(docs)
        for at in range(0, int(sizes[0]) if docs else 0, BLOCK):
            here, more = (int(np.searchsorted(-sizes, -x)) for x in (at, at + BLOCK))
            lengths = np.minimum(sizes[:here] - at, BLOCK)
            own = np.repeat(np.arange(here, dtype=np.int32), lengths)
            place = np.arange(len(own)) + np.repeat(begin[:here] + at - np.cumsum(lengths) + lengths, lengths)
            cost, slope = self._step(s.pair.take(place), [c.take(place) for c in s.contexts], own, weights[:here], learn=more)
            total[:here] -= cost
            weights[:more] += RATE * slope
        out = np.empty(docs)
        out[ranked] = total
        return out

    def _step(self, pair, contexts, own, weights, learn=None):
        """Cost of each document's symbols, and the slope of the weights of the first ``learn`` documents (all, if not given).

        ``weights`` are document by gate by predictor.
        """
        docs = len(weights)
        learn = docs if learn is None else learn
        total, slope = np.zeros(docs), np.zeros((learn, GATES, CONTEXTS))
        scaled = weights.astype(np.float32) * np.float32(FINE / EIGHTHS)
        for gate, owner, bit, slots in _levels(self.codes, pair, contexts, own.astype(np.int32), last=GATES - 1):
            edges = np.searchsorted(owner, np.arange(docs + 1, dtype=np.int32))
            runs = np.diff(edges)
            here = np.flatnonzero(runs)
            inputs = [o.take(slot).astype(np.float32) for o, slot in zip(self.odds, slots)]
            z = np.repeat(scaled[:, gate, 0], runs) * inputs[0]
            for k in range(1, CONTEXTS):
                z += np.repeat(scaled[:, gate, k], runs) * inputs[k]
            np.rint(z, out=z)
            np.clip(z, -MOST, MOST, out=z)
            q = z.astype(np.int32)
            q += MOST
            q *= 2
            q += bit
            first = edges[here]
            total[here] += np.add.reduceat(self.cost.take(q), first)
            grown = here[here < learn]
            if len(grown):
                seen = int(edges[learn])
                error = self.error.take(q[:seen])
                for k, x in enumerate(inputs):
                    slope[grown, gate, k] += np.add.reduceat(error * x[:seen], first[: len(grown)])
        slope /= EIGHTHS
        return total, slope


def fitted(docs: DataFrame, pairs: np.ndarray) -> Mixer:
    """The mixer from all rows of ``docs`` (``text``) and their counts of byte pairs."""
    codes, bits = tree(pairs), slot_bits(int(pairs.sum()))
    scratch = Scratch(docs.sparkSession, "mixer")
    rows = docs.select(F.col("text").cast("string").alias("text"))
    parts = rows.mapInArrow(_counted(codes, bits), COUNTS)
    for fan in (_FAN, _FAN, 1 << 40):
        number = F.floor(F.col("source") / fan)
        parts = parts.repartition("part", number).sortWithinPartitions("part", "source").mapInArrow(_summed(fan, bits), COUNTS)
    summed = scratch.write(parts)
    left_out = _tables(summed, _left_out, bits, 2, np.uint8)
    joint = rows.mapInArrow(_joint(codes, left_out, bits), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    joint = joint.toArrow().sort_by("cell")  # no more rows than gates, bins and values make together
    del left_out
    weights = _first_weights(*(joint.column(c).to_numpy() for c in ("cell", "n")))
    mixer = Mixer(codes, _tables(summed, _odds, bits, 1, np.int8), weights)
    scratch.drop(summed)
    return mixer


def _tables(summed: DataFrame, read, bits: int, each: int, kind: type) -> list[np.ndarray]:
    """A table for each predictor, ``each`` bytes a slot, put together from summed blocks."""
    tables = [np.zeros(each * ((1 << bits) + _NODES), kind) for _ in range(CONTEXTS)]
    for r in summed.mapInArrow(read, "part int, table binary").collect():
        k, part = divmod(r["part"], _PARTS)
        found = np.frombuffer(r["table"], kind)
        at = part * each * _COUNT_BLOCK
        tables[k][at : at + len(found)] = found
    return tables


def _scored(mixer: Mixer, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, offsets in scan.slices(batches, "text", 1 << 21):
            score = mixer.scores(raw, offsets)
            size = pa.array(np.diff(offsets).astype(np.int64))
            mark = pa.array(text_marks(raw, offsets).view(np.int64))
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in keep), pa.array(score), size, mark], names=[*keep, "score", "n_bytes", "text_mark"])

    return run


def text_marks(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each whole text."""
    return scan.word_hashes(raw, offsets[:-1], offsets[1:], fold=False) if len(raw) else np.zeros(len(offsets) - 1, np.uint64)


def scored(docs: DataFrame, mixer: Mixer, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``score`` (log10 probability of the whole text), ``n_bytes`` and ``text_mark``.

    A null text is empty: its score is that of the end mark alone. Columns of these names are
    replaced; repeated rows score alike; an empty table stays empty.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "n_bytes", "text_mark")]
    needed = list(dict.fromkeys([*keep, "text"]))
    rows = docs.select(*(docs[c].cast("string").alias(c) if c == "text" else docs[c] for c in needed))
    zero = F.lit(0).cast("long")
    return rows.mapInArrow(_scored(mixer, keep), rows.select(*keep, F.lit(0.0).alias("score"), zero.alias("n_bytes"), zero.alias("text_mark")).schema)


def bits_per_byte(score, n_bytes):
    """From a log10 probability; null for an empty text."""
    return F.when(n_bytes > 0, -score * float(np.log2(10)) / n_bytes)


# The unigram baseline, and the counts of byte pairs, from one pass over the words.

#: Text of one batch, whose distinct words are looked up together.
BATCH_BYTES = 8 << 20
_END_WORD = np.uint64(0x5EED5EED5EED5EED)

_PASS = pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), ("batch", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
PASS = "kind int, bucket long, batch long, keys binary, counts binary"
_WORDS, _DOCS, _PAIRS = 0, 1, 2


def _words_pass(bucket_keys: list[int]):
    """Batches of documents to: their distinct words with training counts, by bucket; the documents as
    numbers of those words; and the partition's counts of byte pairs in training documents."""
    buckets = len(bucket_keys)

    def flush(held, batch: int) -> Iterator[pa.RecordBatch]:
        words, docs, train = (np.concatenate(x) for x in zip(*[(h[0], h[1], h[2]) for h in held]))
        ids = pa.concat_arrays([h[3] for h in held])
        known, local = np.unique(words, return_inverse=True)
        counts = np.bincount(local[train], minlength=len(known)).astype("<i8")
        # numbers of words by bucket: the bucket's words follow one another
        bucket = (known % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            part = order[cuts[b] : cuts[b + 1]]
            yield _row(_WORDS, bucket_keys[b], batch, known[part].tobytes(), counts[part].tobytes())
        numbers = np.sort(place[local] + docs.astype(np.int64) * len(known))
        cut = np.searchsorted(numbers, np.arange(len(ids) + 1) * len(known))
        numbers %= len(known)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("numbers", pa.large_list(pa.uint32()))]), options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            lists = pa.LargeListArray.from_arrays(pa.array(cut), pa.array(_deltas(numbers, cut)))
            marks = pa.array(np.concatenate([h[4] for h in held]).view(np.int64))
            out.write_batch(pa.RecordBatch.from_arrays([ids, marks, lists], names=["doc_id", "mark", "numbers"]))
        yield _row(_DOCS, 0, batch, sink.getvalue().to_pybytes(), b"")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        pairs = np.zeros(256 * SYMBOLS, np.int64)
        held, size, seen = [], 0, 0
        for rows, raw, offsets in scan.slices(batches, "text"):
            train = rows.column("train").to_numpy(zero_copy_only=False).astype(bool)
            starts, ends, first = scan.word_bounds(~scan.SPACE[raw], offsets)
            words = scan.word_hashes(raw, starts, ends)
            docs = len(train)
            words = np.insert(words, first[1:], _END_WORD)
            owner = np.repeat(np.arange(docs), np.diff(first) + 1)
            held.append((words, owner + seen, train[owner], rows.column("doc_id").cast(pa.int64()), text_marks(raw, offsets)))
            s = symbols(raw, offsets, hashed=False)
            pairs += np.bincount(s.pair[np.repeat(train, np.diff(s.begin))], minlength=len(pairs))
            seen += docs
            size += len(raw)
            if size >= BATCH_BYTES:
                yield from flush(held, number)
                held, size, seen, number = [], 0, 0, number + 1
        if held:
            yield from flush(held, number)
        if pairs.any():
            yield _row(_PAIRS, 0, 0, b"", pairs.astype("<i8").tobytes())

    return run


def _deltas(numbers: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Rising numbers of each document as steps from the one before, which pack better."""
    out = np.diff(numbers, prepend=0)
    heads = cut[:-1][cut[:-1] < len(numbers)]
    out[heads] = numbers[heads]
    return out.astype(np.uint32)


def _row(kind: int, bucket: int, batch: int, keys: bytes, counts: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([bucket], pa.int64()), pa.array([batch], pa.int64()), pa.array([keys], pa.binary()), pa.array([counts], pa.binary())], schema=_PASS)


def _global(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a partition's buckets: every batch's words with their counts in all batches; and the totals, as kind 3."""
    rows = [(b, n, np.frombuffer(k, "<u8"), np.frombuffer(c, "<i8")) for batch in batches for b, n, k, c in zip(*(batch.column(x).to_pylist() for x in ("bucket", "batch", "keys", "counts")))]
    if not rows:
        return
    keys, counts = np.concatenate([r[2] for r in rows]), np.concatenate([r[3] for r in rows])
    known, local = np.unique(keys, return_inverse=True)
    total = np.bincount(local, counts, len(known)).astype("<i8")
    at = 0
    for b, n, k, _ in rows:
        yield _row(_WORDS, b, n, b"", total[local[at : at + len(k)]].tobytes())
        at += len(k)
    yield _row(3, 0, 0, b"", np.array([total.sum(), (total > 0).sum()], "<i8").tobytes())


def _looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches, sorted: the counts of their words by bucket, then the documents; to each document's sums."""
    batch, counts = None, []
    for rows in batches:
        for kind, number, keys, data in zip(*(rows.column(x).to_pylist() for x in ("kind", "batch", "keys", "counts"))):
            if number != batch:
                batch, counts = number, []
            if kind == _WORDS:
                counts.append(np.frombuffer(data, "<i8"))
                continue
            c = np.concatenate(counts)
            with pa.ipc.open_stream(keys) as source:
                docs = source.read_all().combine_chunks().to_batches()[0]
            lists = docs.column("numbers")
            steps = lists.values.to_numpy().astype(np.int64)
            cut = lists.offsets.to_numpy()
            total = np.r_[0, np.cumsum(steps)]
            numbers = total[1:] - np.repeat(total[cut[:-1]], np.diff(cut))
            value = c[numbers]
            sums = np.add.reduceat(np.log10(value + 1.0), cut[:-1])
            known = np.add.reduceat((value > 0).astype(np.int64), cut[:-1])
            yield pa.RecordBatch.from_arrays([docs.column("doc_id"), docs.column("mark"), pa.array(np.diff(cut).astype(np.int64)), pa.array(known), pa.array(sums)], names=["doc_id", "text_mark", "n_tokens", "n_known", "log_counts"])


@dataclass
class Unigrams:
    tokens: int
    distinct: int
    sums: DataFrame  # doc_id, text_mark, n_tokens, n_known, log_counts
    pairs: np.ndarray


def unigrams(docs: DataFrame) -> Unigrams:
    """Counts of all words of the rows of ``docs`` (``doc_id``, ``text``) with ``train``, looked up for every row.

    Words are lower-cased (A-Z) and cut at ASCII white space; each text ends with an end token. A
    64-bit hash stands for a word. Each batch of documents asks once for each of its distinct words.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "unigrams")
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce("train", F.lit(False)).alias("train"))
    first = scratch.write(rows.mapInArrow(_words_pass(even_keys(spark, buckets)), PASS), by="kind")
    words = first.where(f"kind = {_WORDS}").select(*_PASS.names).repartition(buckets, "bucket")
    counted = scratch.write(words.mapInArrow(_global, PASS), by="kind")
    totals = np.zeros(2, np.int64)
    for r in counted.where("kind = 3").select("counts").collect():  # two numbers for each partition
        totals += np.frombuffer(r["counts"], "<i8")
    merged = first.where(f"kind = {_PAIRS}").select(F.lit(0).alias("part"), "counts").groupBy("part").applyInArrow(_added, "part int, counts binary").collect()
    pairs = np.frombuffer(merged[0]["counts"], "<i8") if merged else np.zeros(256 * SYMBOLS, np.int64)
    back = counted.where(f"kind = {_WORDS}").select(*_PASS.names).unionByName(first.where(f"kind = {_DOCS}").select(*_PASS.names))
    back = back.repartition(buckets, "batch").sortWithinPartitions("batch", "kind", "bucket")
    sums = back.mapInArrow(_looked_up, "doc_id long, text_mark long, n_tokens long, n_known long, log_counts double")
    return Unigrams(int(totals[0]), int(totals[1]), sums, pairs)


def _added(table: pa.Table) -> pa.Table:
    total = np.zeros(256 * SYMBOLS, np.int64)
    for data in table.column("counts"):
        total += np.frombuffer(data.as_buffer(), "<i8")
    return pa.table({"part": pa.array([0], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})


def language_model(docs: DataFrame) -> DataFrame:
    """Scores of all rows of ``docs`` (``doc_id``, ``text``, ``train``), learned from those with ``train``.

    Returns ``doc_id``, ``train``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (unigrams
    with one added to every count), ``score`` (the mixer's) and ``bits_per_byte``. A null text is
    empty: one end token. Rows with the same id and text share their counts; a null id is kept; a
    null ``train`` is false. Without training rows, all words are unknown and the mixer untrained.
    """
    words = unigrams(docs)
    mixer = fitted(docs.where("train"), words.pairs)
    known = words.sums.dropDuplicates(["doc_id", "text_mark"])
    rows = scored(docs.select("doc_id", "text", F.coalesce("train", F.lit(False)).alias("train")), mixer, keep=["doc_id", "train"])
    rows = rows.withColumnRenamed("doc_id", "_id").withColumnRenamed("text_mark", "_mark")
    joined = rows.join(known, F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_mark") == F.col("text_mark")), "left")
    base = F.col("log_counts") - F.col("n_tokens") * float(np.log10(words.tokens + words.distinct + 1))
    return joined.select(
        F.col("_id").alias("doc_id"), "train", "n_tokens", "n_known", F.lit(words.tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"), "score", bits_per_byte(F.col("score"), F.col("n_bytes")).alias("bits_per_byte"),
    )
