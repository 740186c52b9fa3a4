"""Benchmark decontamination: which words of a document lie in a passage of a benchmark item.

Item windows are the patterns of a Wu-Manber search over the documents, whose words are first brought
to one form: lower case, one blank after each word. The windows travel to the tasks in blocks of a
bounded number of bytes; each block is one narrow pass over the documents, so nothing is shuffled
and a benchmark of any size can be searched.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabprep.llm import scan
from tabprep.llm.staging import Scratch
from tabprep.llm.wu_manber import PatternSet

#: Bytes of windows that one pass carries to every task.
BLOCK_BYTES = 16 << 20
SLICE_BYTES = 1 << 20

#: Letters and digits of ASCII in lower case, and everything beyond ASCII.
WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_END = 0x01


def plain(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The documents' words in lower case, a blank after each, an end mark after each document; and where each begins."""
    places = offsets[1:]
    low = np.insert(scan.LOWER[raw], np.repeat(places, 2), np.tile(np.array([0x20, _END], np.uint8), len(places)))
    ends = places + 2 * np.arange(1, len(places) + 1) - 1
    inside = WORD[low]
    low[~inside] = 0x20
    low[ends] = _END
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    keep[ends] = True
    out = low[keep]
    return out, np.r_[0, np.flatnonzero(out == _END) + 1]


_WINDOWS = pa.schema([("item_id", pa.string()), ("pattern", pa.binary()), ("n", pa.int32())])


def _windows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, offsets in scan.slices(batches, "text"):
            text, first = plain(raw, offsets)
            data = text.tobytes()
            out = []
            for item, a, b in zip(rows.column("item_id").to_pylist(), first[:-1].tolist(), first[1:].tolist()):
                starts = [a, *(a + np.flatnonzero(text[a : b - 1] == 0x20) + 1).tolist()]
                count = min(size, len(starts) - 1)
                if count:
                    out += [(item, data[starts[i] : starts[i + count]], count) for i in range(len(starts) - count)]
            for at in range(0, len(out), 50_000):
                part = out[at : at + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in part], _WINDOWS.field(i).type) for i in range(3)], schema=_WINDOWS)

    return run


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def _hits(patterns: list[bytes], counts: list[int], items: list[list[str]], keep: Sequence[str], known: bool):
    """One pass: documents to their word count, spans of hit words and items, joined to those of passes before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = PatternSet(patterns)
        for rows, raw, offsets in scan.slices(batches, "text", SLICE_BYTES):
            text, first = plain(raw, offsets)
            blank = text == 0x20
            before = np.r_[0, np.cumsum(blank)]
            word0 = before[first]
            cover = np.zeros(int(before[-1]) + 1, np.int64)
            named: dict[int, set] = defaultdict(set)
            for start, i in tree.search(text):
                if start and not (blank[start - 1] or text[start - 1] == _END):
                    continue
                word = int(before[start])
                cover[word] += 1
                cover[word + counts[i]] -= 1
                named[int(np.searchsorted(first, start, "right")) - 1].update(items[i])
            if known:
                for doc, spans in enumerate(rows.column("hit_spans").to_pylist()):
                    for span in spans:
                        cover[word0[doc] + span["start"]] += 1
                        cover[word0[doc] + span["end"]] -= 1
                for doc, old in enumerate(rows.column("hit_items").to_pylist()):
                    named[doc].update(old)
            hit = np.cumsum(cover[:-1]) > 0
            edge = hit.copy()
            edge[1:] &= ~hit[:-1]
            begins = word0[:-1][word0[:-1] < len(hit)]
            edge[begins] = hit[begins]
            close = hit.copy()
            close[:-1] &= ~hit[1:]
            lasts = word0[1:][word0[1:] > 0] - 1
            close[lasts] = hit[lasts]
            starts, ends = np.flatnonzero(edge), np.flatnonzero(close) + 1
            cuts = np.searchsorted(starts, word0).astype(np.int32)
            base = np.repeat(word0[:-1], np.diff(cuts))
            spans = pa.ListArray.from_arrays(pa.array(cuts), pa.StructArray.from_arrays([pa.array(starts - base), pa.array(ends - base)], fields=list(_SPAN)))
            lists = pa.array([sorted(named[i]) if i in named else [] for i in range(rows.num_rows)], pa.list_(pa.string()))
            names = [*keep, "n_words", "hit_spans", "hit_items"]
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in keep), pa.array(np.diff(word0)), spans, lists], names=names)

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, keep: Sequence[str] | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``n_words`` (long), ``hit_spans`` (word ranges, end exclusive) and ``hit_items`` (sorted ids as text).

    Words are runs of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased. A
    window is ``window`` consecutive words of an item (``item_id``, ``text``), or all of a shorter
    item. A word inside any occurrence of a window is hit. ``keep`` names the columns of ``docs`` to
    return (all, if not given); columns with the names of the results are replaced. A null or
    wordless text has no words and no hits; a null or wordless item has no windows; windows of an
    item whose id is null hit words but name no item. Repeated rows and ids each give their own row;
    an empty table on either side gives no hits.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontaminate")
    found = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    windows = scratch.write(found.mapInArrow(_windows(window), "item_id string, pattern binary, n int").distinct())
    size = windows.agg(F.sum(F.length("pattern") + 40)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("n_words", "hit_spans", "hit_items")]
    passed = list(dict.fromkeys([*keep, "text"]))
    rows = docs.select(*(F.col(c).cast("string").alias(c) if c == "text" else F.col(c) for c in passed))
    for b in range(blocks):
        last = b == blocks - 1
        part = windows.where(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == b)
        grouped = part.groupBy("pattern", "n").agg(F.sort_array(F.collect_set("item_id")).alias("items")).collect()
        columns = keep if last else passed
        fields = [rows.schema[c] for c in columns]
        fields.append(T.StructField("n_words", T.LongType()))
        fields.append(T.StructField("hit_spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))))
        fields.append(T.StructField("hit_items", T.ArrayType(T.StringType())))
        step = _hits([bytes(r.pattern) for r in grouped], [r.n for r in grouped], [list(r["items"]) for r in grouped], columns, b > 0)
        rows = rows.mapInArrow(step, T.StructType(fields))
    scratch.drop(windows)
    return rows
