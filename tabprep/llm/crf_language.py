"""Language identification of every word by a linear-chain conditional random field.

Words are labelled jointly: features of a word (its affixes, the trigrams of its letters, and the
languages whose lexicon lists it) give a score for each language, learned transitions couple
neighbours, and forward-backward gives each word's posterior, so that text which switches language
is labelled piece by piece. A document's language is the one with the largest mean posterior.

The field is fitted on a bounded sample of labelled rows; scoring covers every word of every text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.llm import scan

#: The fitted sample: documents in all, the longest of them in characters, and the most languages.
SAMPLE_DOCUMENTS = 1200
SAMPLE_CHARACTERS = 30_000
MOST_LANGUAGES = 256
#: Words of one language's lexicon, and how often the sample must hold them.
LEXICON_WORDS, LEXICON_LEAST = 4000, 3
FEATURE_BITS = 17
#: Words that one lane of the forward-backward scan covers.
LANE = 64
UNDETERMINED = "und"

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@dataclass
class Words:
    """The words of a slice: where documents begin among them, and the features of each."""

    first: np.ndarray  # first word of each document, and the end
    cuts: np.ndarray  # first feature of each word
    codes: np.ndarray  # feature numbers, word by word
    hashes: np.ndarray


def _hashed(values: np.ndarray, kind: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((values.astype(np.uint64) + np.uint64(kind << 32)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def words_of(texts: pa.Array) -> Words:
    """Words are runs of letters (a-z after lower-casing, and bytes beyond ASCII)."""
    raw, offsets = scan.bytes_and_offsets(pc.utf8_lower(texts.cast(pa.large_string())))
    inside = _LETTER[raw]
    starts, ends, first = scan.word_bounds(inside, offsets)
    n = len(starts)
    size = ends - starts
    b = np.zeros(len(raw) + 4, np.uint32)
    b[2:-2] = np.where(inside, raw, 0)
    places = np.flatnonzero(inside) + 2
    owner = np.repeat(np.arange(n), size)
    heads, tails = np.zeros(len(places), bool), np.zeros(len(places), bool)
    total = np.cumsum(size)
    if n:
        heads[total - size] = True
        tails[total - 1] = True
    left, right = np.where(heads, 0, b[places - 1]), np.where(tails, 0, b[places + 1])
    grams = _hashed(left << 16 | b[places] << 8 | right, 1)
    at, end = starts + 2, ends + 2
    two, three = size > 1, size > 2
    head3 = b[at] << 16 | np.where(two, b[np.minimum(at + 1, len(b) - 1)], 0) << 8 | np.where(three, b[np.minimum(at + 2, len(b) - 1)], 0)
    tail3 = b[end - 1] << 16 | np.where(two, b[end - 2], 0) << 8 | np.where(three, b[end - 3], 0)
    affixes = np.stack([_hashed(head3, 2), _hashed(tail3, 3), _hashed(head3 >> 8, 4), _hashed(tail3 >> 8, 5)], axis=1) if n else np.zeros((0, 4), np.int64)
    cuts = total - size + 4 * np.arange(n)
    codes = np.empty(len(grams) + 4 * n, np.int64)
    codes[np.arange(len(grams)) + 4 * owner] = grams
    codes[(cuts + size)[:, None] + np.arange(4)] = affixes
    return Words(first, cuts, codes, scan.word_hashes(raw, starts, ends))


@dataclass
class Field:
    """A fitted field: weights of features, lexicon rows by word hash, transitions and starts."""

    languages: list[str]
    weights: np.ndarray
    lexicon: np.ndarray  # sorted word hashes
    listed: np.ndarray  # for each, the languages that list it; the last row is of words in no lexicon
    lexical: np.ndarray  # weight of being listed by a language, for each label
    steps: np.ndarray
    starts: np.ndarray

    def listing(self, hashes: np.ndarray) -> np.ndarray:
        """Row of ``listed`` of each word."""
        if not len(self.lexicon):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.lexicon, hashes), len(self.lexicon) - 1)
        return np.where(self.lexicon[at] == hashes, at, len(self.lexicon))

    def emissions(self, words: Words, rows: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.weights[words.codes], words.cuts, axis=0) + (self.listed @ self.lexical)[rows]


def posteriors(emissions: np.ndarray, heads: np.ndarray, steps: np.ndarray, starts: np.ndarray, pairs: bool = False):
    """Posterior of each label at each word by forward-backward; a chain begins where ``heads`` is true.

    All words form one sequence in which a chain's first word forgets what came before. It is cut
    into lanes that advance together: first the transfer matrix of every lane, then the messages at
    the lanes' ends, then the messages within. With ``pairs``, also the expected label pairs, summed.
    """
    n, labels = emissions.shape
    lanes = -(-n // LANE)
    total = lanes * LANE
    e = np.ones((total, labels))
    e[:n] = np.exp(emissions - emissions.max(axis=1, keepdims=True))
    new = np.zeros(total, bool)
    new[:n] = heads
    new[n:] = True
    e, new = e.reshape(lanes, LANE, labels), new.reshape(lanes, LANE, 1)
    a = np.exp(steps - steps.max(axis=1, keepdims=True))
    a /= a.sum(axis=1, keepdims=True)
    p = np.exp(starts - starts.max())
    p /= p.sum()

    transfer = np.broadcast_to(np.eye(labels), (lanes, labels, labels)).copy()
    for t in range(LANE):
        moved = np.where(new[:, t, None], transfer.sum(axis=2, keepdims=True) * p, (transfer.reshape(-1, labels) @ a).reshape(transfer.shape))
        transfer = moved * e[:, t, None, :]
        transfer /= transfer.sum(axis=(1, 2), keepdims=True)
    enter, leave = np.empty((lanes, labels)), np.empty((lanes, labels))
    message = np.full(labels, 1 / labels)
    for k in range(lanes):
        enter[k] = message
        message = message @ transfer[k]
        message /= message.sum()
    message = np.ones(labels)
    for k in range(lanes - 1, -1, -1):
        leave[k] = message
        message = transfer[k] @ message
        message /= message.sum()

    forward = np.empty_like(e)
    message = enter
    for t in range(LANE):
        message = np.where(new[:, t], message.sum(axis=1, keepdims=True) * p, message @ a) * e[:, t]
        message /= message.sum(axis=1, keepdims=True)
        forward[:, t] = message
    backward = np.empty_like(e)
    message = leave
    for t in range(LANE - 1, -1, -1):
        backward[:, t] = message
        seen = message * e[:, t]
        message = np.where(new[:, t], (seen @ p)[:, None], seen @ a.T)
        message /= message.sum(axis=1, keepdims=True)
    marginal = forward * backward
    marginal /= marginal.sum(axis=2, keepdims=True)
    marginal = marginal.reshape(total, labels)[:n]
    if not pairs:
        return marginal
    before, after = forward.reshape(total, labels)[: n - 1], (backward * e).reshape(total, labels)[1:n]
    joint = before[:, :, None] * a * after[:, None, :]
    joint /= joint.sum(axis=(1, 2), keepdims=True)
    return marginal, joint[~heads[1:]].sum(axis=0)


def fitted(texts: list[str], labels: list[str], seed: int = 5, passes: int = 3) -> Field | None:
    """A field from texts and their languages; chains are spliced from pieces of several texts, so that switches are learned."""
    known = [(t, y) for t, y in zip(texts, labels) if t]
    languages = sorted({y for _, y in known})
    if not languages:
        return None
    random = np.random.default_rng(seed)
    words = words_of(pa.array([t for t, _ in known], pa.large_string()))
    if not len(words.cuts):
        return None
    number = {y: i for i, y in enumerate(languages)}
    gold = np.repeat([number[y] for _, y in known], np.diff(words.first))
    counts = [Counter(words.hashes[gold == i].tolist()) for i in range(len(languages))]
    chosen = [{w for w, c in c.most_common(LEXICON_WORDS) if c >= LEXICON_LEAST} for c in counts]
    lexicon = np.array(sorted(set().union(*chosen)), np.uint64)
    listed = np.zeros((len(lexicon) + 1, len(languages)))
    for i, c in enumerate(chosen):
        listed[:-1, i] = np.isin(lexicon, np.array(sorted(c), np.uint64))
    size = len(languages)
    field = Field(languages, np.zeros((1 << FEATURE_BITS, size), np.float32), lexicon, listed, np.zeros((size, size)), np.zeros((size, size)), np.zeros(size))
    rows = field.listing(words.hashes)
    ends = np.r_[words.cuts[1:], len(words.codes)]

    pieces = []
    for a, b in zip(words.first[:-1], words.first[1:]):
        while a < b:
            c = min(b, a + int(random.integers(10, 200)))
            pieces.append((a, c))
            a = c
    rate, slack = 0.2, 1e-8
    seen = [np.full(x.shape, slack, np.float32) for x in (field.weights, field.lexical, field.steps, field.starts)]
    for _ in range(passes):
        order = random.permutation(len(pieces))
        at = 0
        while at < len(order):
            take, heads, held = [], [], 0
            while at < len(order) and held < 20_000:
                joined = order[at : at + int(random.integers(1, 4))]
                at += len(joined)
                for k, i in enumerate(joined):
                    a, b = pieces[i]
                    take.append(np.arange(a, b))
                    head = np.zeros(b - a, bool)
                    head[0] = k == 0
                    heads.append(head)
                    held += b - a
            w, head = np.concatenate(take), np.concatenate(heads)
            lengths = ends[w] - words.cuts[w]
            cuts = np.cumsum(lengths) - lengths
            codes = words.codes[np.repeat(words.cuts[w] - cuts, lengths) + np.arange(int(lengths.sum()))]
            part = Words(np.zeros(0, np.int64), cuts, codes, words.hashes[w])
            y = gold[w]
            marginal, joint = posteriors(field.emissions(part, rows[w]), head, field.steps, field.starts, pairs=True)
            error = marginal.copy()
            error[np.arange(len(y)), y] -= 1
            inner = ~head[1:]
            truth = np.zeros((size, size))
            np.add.at(truth, (y[:-1][inner], y[1:][inner]), 1)
            spread = np.repeat(error, lengths, axis=0)
            by_feature = np.stack([np.bincount(codes, spread[:, i], 1 << FEATURE_BITS) for i in range(size)], axis=1)
            # locally normalised rows: expected pairs follow the softmax of each row
            row = np.exp(field.steps - field.steps.max(axis=1, keepdims=True))
            row /= row.sum(axis=1, keepdims=True)
            step = (joint - truth) - row * (joint - truth).sum(axis=1, keepdims=True)
            start = error[head].sum(axis=0)
            slopes = (by_feature / len(w), field.listed[rows[w]].T @ error / len(w), step / len(w), start / max(1, int(head.sum())))
            for value, slope, past in zip((field.weights, field.lexical, field.steps, field.starts), slopes, seen):
                past += slope.astype(np.float32) ** 2
                value -= (rate * slope / np.sqrt(past)).astype(value.dtype)
    return field


_OUT = pa.schema([("lang_pred", pa.string()), ("score", pa.float64()), ("n_switches", pa.int64())])


def _labelled(field: Field | None, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, _ in scan.slices(batches, "text"):
            texts = rows.column("text").cast(pa.large_string()).fill_null("")
            n = rows.num_rows
            best, score, switches = np.full(n, -1), np.zeros(n), np.zeros(n, np.int64)
            lettered = pc.match_substring_regex(texts, r"\p{L}").to_numpy(zero_copy_only=False)
            words = words_of(texts) if field is not None else None
            if words is not None and len(words.cuts):
                heads = np.zeros(len(words.cuts), bool)
                counts = np.diff(words.first)
                full = counts > 0
                heads[words.first[:-1][full]] = True
                marginal = posteriors(field.emissions(words, field.listing(words.hashes)), heads, field.steps, field.starts)
                mean = np.add.reduceat(marginal, words.first[:-1][full], axis=0) / counts[full][:, None]
                best[full], score[full] = mean.argmax(axis=1), np.minimum(mean.max(axis=1), 1.0)
                label = marginal.argmax(axis=1)
                changed = np.r_[False, label[1:] != label[:-1]] & ~heads
                switches[full] = np.add.reduceat(changed.astype(np.int64), words.first[:-1][full])
            best[~lettered], score[~lettered], switches[~lettered] = -1, 0.0, 0
            names = [UNDETERMINED if b < 0 else field.languages[b] for b in best.tolist()]
            out = [pa.array(names, pa.string()), pa.array(score), pa.array(switches)]
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in keep), *out], names=[*keep, *_OUT.names])

    return run


def learned(docs: DataFrame, label: str = "lang", documents: int = SAMPLE_DOCUMENTS) -> Field | None:
    """A field fitted on at most about ``documents`` rows of ``docs`` (``text``, ``label``), alike many of each language."""
    rows = docs.select(F.col("text").cast("string").alias("text"), F.col(label).cast("string").alias("label"))
    rows = rows.where("text is not null and label is not null").where(F.length("text").between(1, SAMPLE_CHARACTERS))
    counts = rows.groupBy("label").count().orderBy(F.desc("count"), "label").limit(MOST_LANGUAGES).collect()
    if not counts:
        return None
    each = max(1, documents // len(counts))
    share = {r["label"]: min(1.0, 1.2 * each / r["count"]) for r in counts}
    picked = F.pmod(F.xxhash64(F.lit(17), "text"), F.lit(1_000_000)) < F.create_map(*(F.lit(x) for y, s in share.items() for x in (y, s * 1e6)))[F.col("label")]
    sample = rows.where(picked).limit(2 * documents).collect()
    sample.sort(key=lambda r: (r["text"], r["label"]))
    return fitted([r["text"] for r in sample], [r["label"] for r in sample])


def identified(docs: DataFrame, field: Field | None, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1, the mean posterior) and ``n_switches`` between words.

    ``und`` with score 0 where the text is null or has no letter, or if nothing was learned. ``keep``
    names the columns to return (all, if not given); columns named like the results are replaced.
    Repeated rows give equal answers; ties go to the first language by name; an empty table stays empty.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in _OUT.names]
    needed = list(dict.fromkeys([*keep, "text"]))
    rows = docs.select(*(docs[c].cast("string").alias(c) if c == "text" else docs[c] for c in needed))
    schema = rows.select(*keep, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("n_switches")).schema
    return rows.mapInArrow(_labelled(field, keep), schema)


def held_out(fold: int, of: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold`` modulo ``of``; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(of)) == fold, F.lit(False))
