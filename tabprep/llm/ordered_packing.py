"""Order-preserving packing: a dynamic program over document and sentence ends.

The encoded documents of a partition form one stream of tokens, in the order in which they are
read. The stream is cut into windows of at most ``capacity`` tokens, the sequences. A window costs
the tokens it is padded with (none if its length is a power of two), a cut costs nothing at the end
of a document, a little at the end of a sentence and more within one, and the cuts of least total cost
are found from left to right: the cheapest start of a full-sized window is the head of a monotone
queue, starts that make a power of two are looked up. Only long sentences have places to be cut at
inside, besides the last window of a partition, whose rest may be cut into powers of two.

A partition is solved in segments of some hundred windows. All but the last windows of a segment
are settled before the next one is read, so memory does not grow with the partition or with a text.
"""

from __future__ import annotations

import re
import zlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.taskcontext import TaskContext

from tabprep.llm import scan
from tabprep.llm.tokens import default_tokenizer, encoder

#: What a cut costs, in tokens of padding: after a sentence, and within one.
SENTENCE_CUT = 6
INSIDE_CUT = 20
#: Tokens of a sentence beyond which it may be cut inside, and between the places where it may be.
LONG_SENTENCE = 64
INSIDE_STEP = 16
#: Tokens that are solved at once, and the windows at their end that are solved again with what follows.
SEGMENT = 1 << 18
KEPT_WINDOWS = 16
#: Longer texts are encoded in pieces of about so many characters, cut where no token can span the cut.
PIECE_CHARS = 1 << 19

#: A blank between a visible character and a letter always begins a token of byte-level encoding.
_SEAM = re.compile(r"(?<=\S) (?=[^\W\d_])")


def padding(length: int, capacity: int) -> int:
    """Tokens that fill a sequence up; a power of two is left as it is."""
    return 0 if length & (length - 1) == 0 else capacity - length


def cheapest_cuts(places: np.ndarray, cost: np.ndarray, capacity: int) -> tuple[list[int], int]:
    """Indices of ``places`` at which to cut, first and last included, and their total cost.

    ``places`` rise by at most ``capacity`` each; ``cost`` is that of a cut at each place (the
    first and the last are free). With ``key = best + cost + place``, the window from i to j costs
    ``key[i] + capacity - places[j]``, so the best start is the least key within reach.
    """
    n = len(places)
    starts, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in range((capacity - 1).bit_length()):
        at = np.searchsorted(places, places - (1 << k))
        same = np.flatnonzero(places[at] == places - (1 << k))
        starts.append(at[same])
        ends.append(same)
    order = np.argsort(np.concatenate(ends), kind="stable")
    short_end = [*np.concatenate(ends)[order].tolist(), n]
    short_start = np.concatenate(starts)[order].tolist()
    place, charge = places.tolist(), cost.tolist()
    charge[0] = 0
    best, came, key = [0] * n, [0] * n, [0] * n
    key[0] = place[0]
    queue: deque[int] = deque([0])
    s = 0
    for j in range(1, n):
        here = place[j]
        least = here - capacity
        while place[queue[0]] < least:
            queue.popleft()
        i = queue[0]
        total = key[i] - least
        while short_end[s] == j:
            k = short_start[s]
            s += 1
            if best[k] + charge[k] < total:
                total, i = best[k] + charge[k], k
        best[j], came[j] = total, i
        key[j] = now = total + charge[j] + here
        while queue and key[queue[-1]] >= now:
            queue.pop()
        queue.append(j)
    path = [n - 1]
    while path[-1]:
        path.append(came[path[-1]])
    return path[::-1], best[-1]


@lru_cache(maxsize=2)
def _token_bytes(path: str) -> np.ndarray:
    """Bytes that each token id of a byte-level vocabulary stands for."""
    import json

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    vocabulary = model["vocab"] if isinstance(model["vocab"], dict) else {t: i for i, (t, *_) in enumerate(model["vocab"])}
    added = {x["id"]: len(x["content"].encode()) for x in spec.get("added_tokens") or []}
    sizes = np.zeros(max([*vocabulary.values(), *added, 0]) + 1, np.int64)
    for token, i in vocabulary.items():
        sizes[i] = len(token)
    for i, size in added.items():
        sizes[i] = size
    return sizes


_STOP, _BLANK = np.zeros(256, bool), np.zeros(256, bool)
_STOP[list(b".!?")] = True
_BLANK[list(b" \t\n\r")] = True
#: Full-width stops end a sentence without a blank.
_WIDE = tuple(c.encode() for c in "。！？")


def sentence_ends(raw: np.ndarray) -> np.ndarray:
    """Byte positions just after a sentence: after ``.``, ``!`` or ``?`` before white space, a full-width stop, or a line break."""
    after = np.zeros(len(raw), bool)
    after[:-1] = _STOP[raw[:-1]] & _BLANK[raw[1:]]
    after |= raw == 0x0A
    if len(raw) > 2 and (raw >= 0xE3).any():
        for a, b, c in _WIDE:
            after[2:] |= (raw[:-2] == a) & (raw[1:-1] == b) & (raw[2:] == c)
    return np.flatnonzero(after) + 1


def _in_pieces(text: str, splittable: bool) -> Iterator[str]:
    at = 0
    while splittable and len(text) - at > 2 * PIECE_CHARS:
        seam = _SEAM.search(text, at + PIECE_CHARS)
        if not seam:
            break
        yield text[at : seam.start()]
        at = seam.start()
    yield text[at:]


def _encoded(path: str, ending: int, rows: Iterator[tuple[int | None, str]]) -> Iterator[tuple[int | None, np.ndarray, np.ndarray, bool]]:
    """Document id, token ids, the token places after its sentences, and whether the document ends here; piece by piece."""
    encode = encoder(path)
    sizes = _token_bytes(path)
    for doc_id, text in rows:
        splittable = encode._ranks is not None and len(text) > 2 * PIECE_CHARS and not any(x in text for x in encode.added)
        pieces = deque(_in_pieces(text, splittable))
        while pieces:
            piece = pieces.popleft()
            ids = encode.ids(piece)
            raw = np.frombuffer(piece.encode("utf-8", "surrogatepass"), np.uint8)
            last = not pieces
            if last:
                ids = [*ids, ending]
            ids = np.array(ids, np.int32)
            reach = np.cumsum(sizes[ids[:-1] if last else ids])
            whole = not len(raw) or len(reach) and reach[-1] == len(raw)
            ends = sentence_ends(raw) if whole and len(raw) else np.zeros(0, np.int64)
            ends = np.unique(np.searchsorted(reach, ends) + 1)
            yield doc_id, ids, ends[ends < len(ids) - 1] if last else ends, last


class Windows:
    """The stream of one partition: documents go in, pieces of settled windows come out."""

    def __init__(self, capacity: int, first_id: int, segment: int = SEGMENT) -> None:
        self.capacity, self.segment = capacity, max(segment, 4 * capacity)
        self.sequence = first_id
        self.base = 0  # place of the first token that is not settled
        self.length = 0  # tokens from there on
        self.ids: list[np.ndarray] = []
        self.places: list[np.ndarray] = []
        self.costs: list[np.ndarray] = []
        self.documents: list[list] = []  # id, first place, end or None
        self.waiting: list[list] = []  # pieces of a document whose end is not read yet
        self.done: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray, ends: np.ndarray, last: bool) -> None:
        if not self.documents or self.documents[-1][2] is not None:
            self.documents.append([doc_id, self.base + self.length, None])
        at = self.base + self.length
        self.ids.append(ids)
        self.places.append(at + ends)
        self.costs.append(np.full(len(ends), SENTENCE_CUT, np.int64))
        self.length += len(ids)
        if last:
            self.documents[-1][2] = at + len(ids)
            self.places.append(np.array([at + len(ids)], np.int64))
            self.costs.append(np.zeros(1, np.int64))
        if self.length >= self.segment:
            self._settle(final=False)

    def finish(self) -> None:
        if self.length:
            self._settle(final=True)

    def _candidates(self, final: bool) -> tuple[np.ndarray, np.ndarray]:
        end = self.base + self.length
        places = np.concatenate([[self.base], *self.places, [end]])
        costs = np.concatenate([[0], *self.costs, [INSIDE_CUT]])
        extra = []
        around = np.unique(places)
        for k in np.flatnonzero(np.diff(around) > LONG_SENTENCE):
            extra.append(np.arange(around[k] + INSIDE_STEP, around[k + 1], INSIDE_STEP))
        if final:  # the rest after any of the last ends may be cut into powers of two
            for b in around[(around < end) & (around >= end - self.capacity)]:
                rest = int(end - b)
                bits = [1 << k for k in range(rest.bit_length())[::-1] if rest >> k & 1]
                extra.append(b + np.cumsum(bits)[:-1])
        if extra:
            inside = np.concatenate(extra)
            places = np.concatenate([places, inside])
            costs = np.concatenate([costs, np.full(len(inside), INSIDE_CUT, np.int64)])
        order = np.lexsort((costs, places))
        places, costs = places[order], costs[order]
        first = np.ones(len(places), bool)
        first[1:] = places[1:] != places[:-1]
        return places[first].astype(np.int64), costs[first].astype(np.int64)

    def _settle(self, final: bool) -> None:
        places, costs = self._candidates(final)
        path, _ = cheapest_cuts(places, costs, self.capacity)
        cuts = places[path]
        if not final:
            cuts = cuts[: max(2, len(cuts) - KEPT_WINDOWS)]
        ids = np.concatenate(self.ids)
        self._emit(cuts, ids)
        taken = int(cuts[-1]) - self.base
        self.ids = [ids[taken:].copy()]
        places, costs = np.concatenate([np.zeros(0, np.int64), *self.places]), np.concatenate([np.zeros(0, np.int64), *self.costs])
        self.places, self.costs = [places[places > cuts[-1]]], [costs[places > cuts[-1]]]
        self.base, self.length = int(cuts[-1]), self.length - taken
        self.documents = [d for d in self.documents if d[2] is None or d[2] > self.base]

    def _emit(self, cuts: np.ndarray, ids: np.ndarray) -> None:
        borders = np.unique(np.concatenate([cuts, [d[1] for d in self.documents if cuts[0] < d[1] < cuts[-1]]])).astype(np.int64)
        window = np.searchsorted(cuts, borders[:-1], "right") - 1
        document = np.searchsorted([d[1] for d in self.documents], borders[:-1], "right") - 1
        for a, b, w, k in zip(borders[:-1].tolist(), borders[1:].tolist(), window.tolist(), document.tolist()):
            doc_id, start, end = self.documents[k]
            part = ids[a - self.base : b - self.base].astype("<u4")
            piece = [doc_id, a - start, b - a, zlib.crc32(part.tobytes()), None, self.sequence + w, a - int(cuts[w])]
            self.waiting.append(piece)
            if end is not None:  # earlier pieces of the same document may wait
                for held in self.waiting:
                    held[4] = end - start
                self.done += map(tuple, self.waiting)
                self.waiting = []
        self.sequence += len(cuts) - 1

    def ready(self) -> list[tuple]:
        out, self.done = self.done, []
        return out


_OUT = pa.schema([(name, pa.int64()) for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])
PLACED = ", ".join(f"{name} long" for name in _OUT.names)


def _pack(path: str, capacity: int, ending: int, segment: int):
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(len(_OUT))], schema=_OUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(capacity, TaskContext.get().partitionId() << 40, segment)
        for rows, _, _ in scan.slices(batches, "text"):
            texts = (t or "" for t in rows.column("text").to_pylist())
            for doc_id, ids, ends, last in _encoded(path, ending, zip(rows.column("doc_id").to_pylist(), texts)):
                windows.add(doc_id, ids, ends, last)
            if len(windows.done) > 4096:
                yield batch(windows.ready())
        windows.finish()
        yield batch(windows.ready())

    return run


def packed(docs: DataFrame, tokenizer: str | None = None, capacity: int = 1024, ending: int = 0, segment: int = SEGMENT) -> DataFrame:
    """Every piece of every document with its place: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    Sequences hold the stream of a partition in the order of its rows: the pieces of a sequence
    follow one another, gapless from offset 0. A null or empty text is the ending alone. Repeated
    rows are packed each for itself, null ids are kept, an empty table gives no pieces, further
    columns are ignored. Where a tokenizer's ids do not tell how many bytes they stand for, only
    documents are taken for one sentence. Nothing is shuffled.
    """
    texts = docs.select(docs.doc_id.cast("long").alias("doc_id"), docs.text.cast("string").alias("text"))
    return texts.mapInArrow(_pack(tokenizer or default_tokenizer(), capacity, ending, segment), PLACED)
