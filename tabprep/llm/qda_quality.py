"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each document becomes a short vector of statistics of its words, lines and characters, transformed so
that shares and counts are closer to normal. Class means and covariances come from sums over all
labelled training rows; covariances are shrunk towards the pooled one and a round one. A score is the
logistic of the difference of log densities, from Mahalanobis distances by cached Cholesky factors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm import scan

#: Weight of the pooled covariance in each class's, and of a round one in the result.
POOLED, ROUND = 0.3, 0.05
#: Log-density differences are divided by this before the logistic: statistics of one text depend on one another.
TEMPERATURE = 4.0

STATISTICS = (
    "log_words", "word_length", "word_length_spread", "symbols", "stops", "marks", "capitals", "digits",
    "other_signs", "distinct_words", "top_word", "same_as_last", "repeated_pairs", "lines_per_word", "repeated_lines",
)


def _class(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


_SYMBOL, _STOP, _MARK, _DIGIT = _class(b"#*$%&|<>"), _class(b".,;:"), _class(b"!?"), _class(b"0123456789")
_CAPITAL = _class(bytes(range(0x41, 0x5B)))
_SIGN = np.zeros(256, bool)
_SIGN[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
_START = np.ones(256, bool)  # bytes that begin a code point
_START[0x80:0xC0] = False


def _sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(values)]
    return (total[cuts[1:]] - total[cuts[:-1]]).astype(float)


def _repeats(keys: np.ndarray, owner: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of each document, and how often its most frequent key occurs."""
    order = np.lexsort((keys, owner))
    k, o = keys[order], owner[order]
    heads = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (o[1:] != o[:-1])]) if len(k) else np.zeros(0, np.int64)
    runs = np.diff(np.r_[heads, len(k)])
    most = np.zeros(docs)
    np.maximum.at(most, o[heads], runs)
    return np.bincount(o[heads], minlength=docs).astype(float), most


def statistics(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``STATISTICS`` for each document; an empty one has all counts nought."""
    docs = len(offsets) - 1
    starts, ends, first = scan.word_bounds(~scan.SPACE[raw], offsets)
    words = np.diff(first).astype(float)
    owner = np.repeat(np.arange(docs), np.diff(first))
    hashes = scan.word_hashes(raw, starts, ends)
    points = np.r_[0, np.cumsum(_START[raw])]
    length = (points[ends] - points[starts]).astype(float)
    chars = np.bincount(owner, length, docs)
    squares = np.bincount(owner, length * length, docs)
    n = np.maximum(words, 1)
    mean = chars / n
    spread = np.sqrt(np.maximum(squares / n - mean * mean, 0))
    distinct, top = _repeats(hashes, owner, docs)
    inner = np.ones(len(starts), bool)
    inner[first[:-1][first[:-1] < len(starts)]] = False
    same = np.zeros(len(starts), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same &= inner
    with np.errstate(over="ignore"):
        pairs = scan.mix(hashes[1:] + scan.mix(hashes[:-1])) if len(hashes) > 1 else np.zeros(0, np.uint64)
    pairs, pair_owner = pairs[inner[1:]], owner[1:][inner[1:]]
    pair_kinds, _ = _repeats(pairs, pair_owner, docs)
    pair_count = np.bincount(pair_owner, minlength=docs)
    capital = _CAPITAL[raw]
    capital[1:] |= (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E)
    line_starts, line_ends, line_first = scan.word_bounds(raw != 0x0A, offsets)
    filled = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_owner = np.repeat(np.arange(docs), np.diff(line_first))[filled]
    line_hash = scan.word_hashes(raw, line_starts[filled], line_ends[filled], fold=False)
    line_kinds, _ = _repeats(line_hash, line_owner, docs)
    lines = np.bincount(line_owner, minlength=docs).astype(float)
    share = lambda part, whole: np.log((part + 0.5) / (whole + 1.0))
    per = lambda table: _sums(table[raw], offsets)
    return np.stack(
        [
            np.log1p(words), np.log1p(mean), np.log1p(spread), share(per(_SYMBOL), words), share(per(_STOP), words), share(per(_MARK), words),
            share(_sums(capital, offsets), chars), share(per(_DIGIT), chars), share(per(_SIGN), chars),
            share(distinct, words), share(top, words), share(_sums(same, first), words), share(pair_count - pair_kinds, pair_count),
            share(lines, words), share(lines - line_kinds, lines),
        ],
        axis=1,
    )


_VECTOR = pa.list_(pa.float64())


def _vectors(keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, offsets in scan.slices(batches, "text"):
            x = statistics(raw, offsets)
            cuts = pa.array(np.arange(0, x.size + 1, x.shape[1]).astype(np.int32))
            vectors = pa.ListArray.from_arrays(cuts, pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in keep), vectors], names=[*keep, "statistics"])

    return run


def with_statistics(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``statistics``, an array of doubles; a column of that name is replaced."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != "statistics"]
    needed = list(dict.fromkeys([*keep, "text"]))
    rows = docs.select(*(docs[c].cast("string").alias(c) if c == "text" else docs[c] for c in needed))
    schema = rows.select(*keep, F.array(F.lit(0.0)).alias("statistics")).schema
    return rows.mapInArrow(_vectors(keep), schema)


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors and log determinants of the classes 0 and 1; ``prior`` is their log odds."""

    prior: float
    means: np.ndarray | None = None
    factors: np.ndarray | None = None
    logs: np.ndarray | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        difference = np.full(len(x), self.prior)
        if self.means is not None:
            density = []
            for mean, factor, log in zip(self.means, self.factors, self.logs):
                z = (x - mean) @ factor.T
                density.append(-0.5 * (z * z).sum(axis=1) - log)
            difference = difference + (density[1] - density[0]) / TEMPERATURE
        return 1 / (1 + np.exp(-np.clip(difference, -700, 700)))


def discriminant(counts: np.ndarray, sums: np.ndarray, squares: np.ndarray, pooled: float = POOLED, round_: float = ROUND) -> Discriminant:
    """The classifier from each class's row count, sum of vectors and sum of their outer products.

    With rows of one class or none, there are no densities and the prior alone speaks.
    """
    prior = float(np.log((counts[1] + 0.5) / (counts[0] + 0.5)))
    if min(counts) < 2:
        return Discriminant(prior)
    means = sums / counts[:, None]
    own = squares / counts[:, None, None] - means[:, :, None] * means[:, None, :]
    own = (own + own.transpose(0, 2, 1)) / 2
    shared = (own * (counts / counts.sum())[:, None, None]).sum(axis=0)
    size = len(shared)
    scale = np.diag(shared).copy()
    scale[scale <= 0] = 1e-6
    factors, logs = [], []
    for s in own:
        s = (1 - pooled) * s + pooled * shared
        s = (1 - round_) * s + round_ * np.diag(scale)
        lower = np.linalg.cholesky(s + 1e-9 * np.eye(size))
        factors.append(np.linalg.inv(lower))
        logs.append(np.log(np.diag(lower)).sum())
    return Discriminant(prior, means, np.array(factors), np.array(logs))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one partition: for each class, the row count, sums and sums of products, one number a row."""
    size = len(STATISTICS)
    total = np.zeros((2, 1 + size + size * size))
    for batch in batches:
        if not batch.num_rows:
            continue
        y = batch.column("quality").to_numpy()
        x = batch.column("statistics").flatten().to_numpy().reshape(-1, size)
        for k in (0, 1):
            part = x[y == k]
            total[k] += np.concatenate([[len(part)], part.sum(axis=0), (part.T @ part).ravel()])
    place = np.arange(total.size)
    yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int64)), pa.array(total.ravel())], names=["place", "value"])


def learned(vectors: DataFrame, labels: DataFrame) -> Discriminant:
    """The classifier from ``vectors`` (``doc_id``, ``statistics``) and ``labels`` (``doc_id``, ``quality`` 0 or 1).

    Every labelled row counts. Ids with unlike labels, other labels and null ids are left out.
    """
    size = len(STATISTICS)
    clear = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"), F.max("quality").cast("int").alias("_max"))
    clear = clear.where("quality = _max").select("doc_id", "quality")
    sums = vectors.join(clear, "doc_id").select("quality", "statistics").mapInArrow(_moments, "place long, value double")
    found = sums.groupBy("place").agg(F.sum("value").alias("value")).collect()  # of a fixed size
    total = np.zeros(2 * (1 + size + size * size))
    for r in found:
        total[r["place"]] = r["value"]
    total = total.reshape(2, -1)
    return discriminant(total[:, 0], total[:, 1 : 1 + size], total[:, 1 + size :].reshape(2, size, size))


def _scored(model: Discriminant, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("statistics").flatten().to_numpy().reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(model.scores(x))], names=[*keep, "score"])

    return run


def scored(vectors: DataFrame, model: Discriminant) -> DataFrame:
    """``vectors`` with ``score`` (0 to 1, higher: class 1 likelier) in place of ``statistics``.

    Null and empty texts have statistics like any other and get a score. Repeated rows score alike;
    an empty table stays empty; a column named ``score`` is replaced.
    """
    keep = [c for c in vectors.columns if c not in ("statistics", "score")]
    rows = vectors.select(*keep, "statistics")
    return rows.mapInArrow(_scored(model, keep), rows.select(*keep, F.lit(0.0).alias("score")).schema)
