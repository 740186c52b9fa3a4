"""Spelling variants by exact set signatures: letter multisets as binary vectors.

The words of all texts are counted; words that differ by one inserted, deleted or replaced letter are
found, and rare words are led to the most frequent of their neighbours.

A word's letters are a binary vector with a dimension for each letter and how often it occurred
before. One edit changes at most two dimensions. PartEnum cuts the dimensions into three parts, so at
least one part of two such words is the same: each word is listed under each of its parts. Between
words of like letters the places decide: the word is cut in three, one edit leaves two of the thirds
as they are, counted from the front before it and from the back after it. A signature is a part of
the dimensions, a third that is left open, the rest of the word and the shorter word's length. Words
that share a signature are joined, and verified by their edit distance.

A signature that very many words share would bring up all pairs of them. Words under such a signature
are compared among themselves by what is left of them without one letter, which leads to their
neighbours only; pairs with at most one such word share a signature that is not crowded.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprep.llm import scan
from tabprep.llm.staging import Scratch

#: Words of fewer letters, and words seen less often, are left out.
LEAST_LETTERS = 7
LEAST_COUNT = 2
#: How many times more frequent a form is than the word that is led to it.
RATIO = 10
#: Words that may share a signature before they are compared by their letters left out.
CROWD = 256
#: One occurrence in so many is read with one letter left out.
SLIPS = 31

PARTS, THIRDS = 3, 3
#: Words from this length on are compared letter by letter, in time linear in their length.
LONG = 64
#: Distinct words that a task holds before it passes their counts on.
HELD = 1 << 17


def _crc_table() -> np.ndarray:
    """Changes of the reflected CRC-32 register by one byte."""
    r = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        r = np.where(r & 1, (r >> np.uint32(1)) ^ np.uint32(0xEDB88320), r >> np.uint32(1))
    return r


_CRC = _crc_table()
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
#: The first UTF-8 byte of the letters U+00C0 to U+00FF, whose second byte is any continuation.
_LEAD = 0xC3


def letter_runs(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, and the first run of each document."""
    inside = _LETTER[raw] | (raw == _LEAD)
    inside[1:] |= raw[:-1] == _LEAD
    return scan.word_bounds(inside, offsets)


def crc32_of(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """CRC-32 of each span of ``data``, each continued from its seed; spans are read side by side, long ones alone."""
    state = ~seeds.astype(np.uint32)
    long = lengths > 64
    live = np.flatnonzero(~long & (lengths > 0))
    step = 0
    while len(live):
        at = state[live]
        state[live] = _CRC[(at ^ data[starts[live] + step]) & np.uint32(0xFF)] ^ (at >> np.uint32(8))
        step += 1
        live = live[lengths[live] > step]
    out = ~state
    for k in np.flatnonzero(long):
        out[k] = zlib.crc32(data[starts[k] : starts[k] + lengths[k]].tobytes(), int(seeds[k]))
    return out


def _read(raw: np.ndarray, offsets: np.ndarray, ids: list) -> pa.Array:
    """All words of a slice as they are read: lower-cased, some with one letter left out, the short ones gone."""
    starts, ends, first = letter_runs(raw, offsets)
    if not len(starts):
        return pa.array([], pa.string())
    inside = np.zeros(len(raw) + 1, np.int8)
    inside[starts] += 1
    np.add.at(inside, ends, -1)
    data = scan.LOWER[raw[np.cumsum(inside[:-1]).astype(bool)]]
    lengths = ends - starts
    begin = np.cumsum(lengths) - lengths
    seeds = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    hashes = crc32_of(data, begin, lengths, np.repeat(seeds, np.diff(first)))
    leads = (data & 0xC0) != 0x80
    letters = np.add.reduceat(leads.astype(np.int64), begin)
    slips = np.flatnonzero(hashes % SLIPS == 0)
    keep = np.ones(len(data), bool)
    if len(slips):
        places = np.flatnonzero(leads)
        gone = (np.cumsum(letters) - letters)[slips] + hashes[slips] % letters[slips]
        at = places[gone]
        wide = data[at] == _LEAD
        keep[at] = False
        keep[at[wide] + 1] = False
        lengths[slips] -= 1 + wide
        letters[slips] -= 1
    kept = letters >= LEAST_LETTERS
    keep &= np.repeat(kept, ends - starts)
    bounds = np.zeros(int(kept.sum()) + 1, np.int64)
    np.cumsum(lengths[kept], out=bounds[1:])
    return pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data[keep])])


_COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words, added up in the task until ``HELD`` unlike ones are held."""
    held: list[pa.Table] = []
    size = 0

    def added() -> pa.Table:
        return pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

    def passed(table: pa.Table) -> Iterator[pa.RecordBatch]:
        yield from table.cast(_COUNTS).combine_chunks().to_batches(max_chunksize=1 << 15)

    for rows, raw, offsets in scan.slices(batches, "text"):
        seen = _read(raw, offsets, rows.column("doc_id").to_pylist()).value_counts()
        held.append(pa.table([seen.field("values").cast(pa.large_string()), seen.field("counts")], ["word", "n"]))
        size += len(seen)
        if size > 4 * HELD:
            held = [added()]
            size = len(held[0])
            if size > HELD:
                yield from passed(held[0])
                held, size = [], 0
    if held:
        yield from passed(added())


def word_counts(docs: DataFrame) -> DataFrame:
    """``word``, ``n``: the words of at least ``LEAST_LETTERS`` letters that all texts hold, and how often."""
    texts = docs.select("doc_id", docs.text.cast("string").alias("text"))
    return texts.mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _latin(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words, one byte each, with starts and ends."""
    raw, offsets = scan.bytes_and_offsets(words)
    second = np.zeros(len(raw), bool)
    second[1:] = raw[:-1] == _LEAD
    points = np.where(second, raw + np.uint8(0x40), raw)[raw != _LEAD]
    place = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(raw != _LEAD, out=place[1:])
    bounds = place[offsets]
    return points, bounds[:-1], bounds[1:]


def part_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each of the ``PARTS`` parts of each word's letter dimensions, (words, parts)."""
    n = len(starts)
    word = np.repeat(np.arange(n), ends - starts)
    code = word * 256 + points
    order = np.argsort(code, kind="stable")
    ranked = code[order]
    fresh = np.ones(len(ranked), bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    heads = np.flatnonzero(fresh)
    copy = np.arange(len(ranked)) - np.repeat(heads, np.diff([*heads, len(ranked)]))
    dimension = scan.mix((ranked & 255).astype(np.uint64) << np.uint64(32) | copy.astype(np.uint64))
    out = np.zeros((n, PARTS), np.uint64)
    with np.errstate(over="ignore"):
        np.add.at(out, (ranked >> 8, (dimension >> np.uint64(40)) % np.uint64(PARTS)), scan.mix(dimension))
    return out


_KEYED = pa.schema([("word", pa.string()), ("n", pa.int64()), ("crowded", pa.bool_()), ("least", pa.int32()), ("key", pa.int64())])
KEYED = "word string, n long, crowded boolean, least int, key long"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1 << 11):
            part = batch.slice(at, 1 << 11)
            words = part.column("word")
            points, starts, ends = _latin(words)
            parts = part_hashes(points, starts, ends)
            lengths = ends - starts
            keys, leasts = [], []
            for shorter in (0, 1):  # the word is the shorter of two, or the longer
                least = lengths - shorter
                for third in range(THIRDS):
                    a, b = least * third // THIRDS, least * (third + 1) // THIRDS
                    sides = scan.word_hashes(points, np.concatenate([starts, ends - (least - b)]), np.concatenate([starts + a, ends]), fold=False)
                    with np.errstate(over="ignore"):
                        open_third = scan.mix(sides[: len(starts)] * np.uint64(3) + sides[len(starts) :]) + (least * THIRDS + third).astype(np.uint64)
                        for k in range(PARTS):
                            keys.append(scan.mix(open_third * np.uint64(PARTS) + np.uint64(k) + scan.mix(parts[:, k])).view(np.int64))
                            leasts.append(least.astype(np.int32))
            times = len(keys)
            index = pa.array(np.tile(np.arange(part.num_rows), times))
            columns = [part.column(c).take(index) for c in ("word", "n", "crowded")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate(leasts)), pa.array(np.concatenate(keys))], schema=_KEYED)


def signed(words: DataFrame) -> DataFrame:
    """Every word under each of its signatures; ``least`` is the length of the shorter word that a signature is for."""
    return words.select("word", "n", "crowded").mapInArrow(_sign, KEYED)


def _nearest(n: Column, other: Column) -> Column:
    """The least of these is the most frequent neighbour, and among those the first in code-point order."""
    return F.struct((-n).alias("less"), other.alias("other"))


def _one_edit(u: Column, v: Column) -> Column:
    """Whether unlike texts of like length differ by one edit, in time that grows with their length only."""
    unlike = F.zip_with(F.split(u, ""), F.split(v, ""), lambda x, y: ~x.eqNullSafe(y))
    p = F.array_position(unlike, True).cast("int")
    wider = F.char_length(u) - F.char_length(v)
    rest = lambda c, skip: F.substr(c, p + skip)
    whole = lambda b: F.when(b, 1).otherwise(0)
    return (F.abs(wider) <= 1) & (rest(u, whole(wider >= 0)) == rest(v, whole(wider <= 0)))


def _met(words: DataFrame, crowds: DataFrame) -> DataFrame:
    """Neighbours that meet under a signature with few words: ``word``, ``cnt``, ``best`` of each.

    Two words meet once for each part of the letters that they share, at most three times.
    """
    size = F.char_length("word")
    short = _pairs(words.where(size <= LONG), crowds, F.col("a.least") < LONG, F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1)
    long = _pairs(words.where(size >= LONG), crowds, F.col("a.least") >= LONG, _one_edit(F.col("a.word"), F.col("b.word")))
    return _both_ways(short.unionByName(long))


def _both_ways(pairs: DataFrame) -> DataFrame:
    """Each pair ``u``, ``un``, ``v``, ``vn`` as a neighbour of either word."""
    ways = F.array(F.struct(F.col("u").alias("word"), _nearest(F.col("vn"), F.col("v")).alias("best")), F.struct(F.col("v").alias("word"), _nearest(F.col("un"), F.col("u")).alias("best")))
    return pairs.select(F.explode(ways).alias("w")).select("w.word", F.lit(1).cast("long").alias("cnt"), "w.best")


def _pairs(words: DataFrame, crowds: DataFrame, reach: Column, near: Column) -> DataFrame:
    rows = signed(words).join(crowds, "key", "left_anti")
    a, b = rows.alias("a"), rows.alias("b")
    meet = (F.col("a.key") == F.col("b.key")) & (F.col("a.least") == F.col("b.least")) & (F.col("a.word") < F.col("b.word")) & ~(F.col("a.crowded") & F.col("b.crowded"))
    sizes = F.least(F.char_length("a.word"), F.char_length("b.word")) == F.col("a.least")
    return a.join(b, meet).where(reach & sizes & near).select(F.col("a.word").alias("u"), F.col("a.n").alias("un"), F.col("b.word").alias("v"), F.col("b.n").alias("vn")).distinct()


def _without_one(words: DataFrame) -> DataFrame:
    """Every word without each of its letters: ``word``, ``n``, ``place``, ``rest``."""
    places = F.explode(F.sequence(F.lit(1), F.char_length("word"))).alias("place")
    rest = F.concat(F.expr("substring(word, 1, place - 1)"), F.expr("substring(word, place + 1)"))
    return words.select("word", "n", places).withColumn("rest", rest)


def _left_out(words: DataFrame) -> DataFrame:
    """Neighbours among ``words``, by what is left without one letter: ``word``, ``cnt``, ``best`` of each.

    Words that are the same without the letter at one place differ in it alone: there are no more of
    them than letters, and each learns their number and the best two. A word that is another one's
    rest lacks one of its letters.
    """
    rest = _without_one(words)
    groups = rest.groupBy("place", "rest").agg(F.sort_array(F.collect_list(_nearest(F.col("n"), F.col("word")))).alias("members")).where(F.size("members") > 1)
    first, second = F.col("members")[0], F.col("members")[1]
    replaced = groups.select(F.explode(F.col("members.other")).alias("word"), (F.size("members") - 1).cast("long").alias("cnt"), first.alias("first"), second.alias("second"))
    replaced = replaced.select("word", "cnt", F.when(F.col("first.other") == F.col("word"), F.col("second")).otherwise(F.col("first")).alias("best"))
    longer = rest.select(F.col("word").alias("v"), F.col("n").alias("vn"), F.col("rest").alias("u")).distinct()
    inserted = _both_ways(longer.join(words.select(F.col("word").alias("u"), F.col("n").alias("un")), "u"))
    return replaced.unionByName(inserted)


def neighbours(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """For each of ``words`` (``word``, ``n``, no word twice) with a neighbour: ``n_near`` and the ``best`` of them."""
    scratch = Scratch(words.sparkSession, "variants")
    plain = words.withColumn("crowded", F.lit(False))
    crowds = scratch.write(signed(plain).groupBy("key").count().where(F.col("count") > crowd).select("key"))
    crowded = scratch.write(signed(plain).join(crowds, "key", "left_semi").select("word").distinct())
    flagged = scratch.write(words.join(crowded.withColumn("crowded", F.lit(True)), "word", "left").select("word", "n", F.coalesce("crowded", F.lit(False)).alias("crowded")))
    found = _met(flagged, crowds).unionByName(_left_out(flagged.where("crowded")))
    return found.groupBy("word").agg(F.sum("cnt").alias("n_near"), F.min("best").alias("best"))


def _rooted(forms: DataFrame) -> DataFrame:
    """``word``, ``root`` for the words that have a form (``word``, ``form``): the last of the forms that follow.

    Each step doubles the way; a form is ``RATIO`` times as frequent as its word, so ways are short.
    """
    scratch = Scratch(forms.sparkSession, "roots")
    now = scratch.write(forms.select("word", F.col("form").alias("root")))
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = scratch.write(now.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        moved = after.where("moved").limit(1).count()
        now = after.drop("moved")
        if not moved:
            return now


def variants(docs: DataFrame, crowd: int = CROWD, ratio: int = RATIO) -> DataFrame:
    """Every word with its form: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    Words are the runs of Latin letters in all texts, as ``doc_id`` (a null one is the empty text) and
    run decide whether they are read with a letter left out. Repeated rows count each for themselves.
    Null and empty texts have no words; an empty table has none; further columns are ignored.
    A word without a neighbour that is ``ratio`` times as frequent has no form and is its own root.
    """
    scratch = Scratch(docs.sparkSession, "words")
    words = scratch.write(word_counts(docs).where(F.col("n") >= LEAST_COUNT))
    near = scratch.write(neighbours(words, crowd))
    enough = -F.col("best.less") >= ratio * F.col("n")
    formed = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(enough, F.col("best.other")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"),
    )
    formed = scratch.write(formed)
    roots = _rooted(formed.where("form is not null"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
