"""Vectorised scanning of text columns inside Arrow tasks.

Texts are handled as bytes: a batch is cut into slices of bounded size, each slice is one byte
array with document offsets, and words and their hashes come from whole-array operations. A null
text counts as empty. UTF-8 bytes of 0x80 and above never equal an ASCII separator, so byte classes
decide the same words as code-point classes do.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19


def splitmix(n: int, seed: int) -> np.ndarray:
    """``n`` pseudo-random 64-bit values by the splitmix rule; the same everywhere."""
    with np.errstate(over="ignore"):
        z = np.uint64(seed) + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return mix(z)


def mix(z: np.ndarray) -> np.ndarray:
    """Finalising 64-bit mix."""
    with np.errstate(over="ignore"):
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


#: ASCII white space: blank and the controls tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes with A-Z replaced by a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_VALUES = splitmix(256, 7)
_FOLDED = _VALUES[LOWER]
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)


class _Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            with np.errstate(over="ignore"):
                step = np.full(size, _BASE, np.uint64)
                back = np.full(size, _INVERSE, np.uint64)
                step[0] = back[0] = 1
                self.up, self.down = np.multiply.accumulate(step), np.multiply.accumulate(back)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def bytes_and_offsets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A text column as one byte array and document offsets; null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = int(offsets[0]) if len(offsets) else 0
    last = int(offsets[-1]) if len(offsets) else 0
    return raw[first:last], offsets - first


def tidy() -> None:
    """Give freed memory back to the system: workers are kept from task to task, and wait beside others."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library keeps its own house


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Row slices of at most ``limit`` text bytes (a longer text stands alone), with bytes and offsets."""
    for batch in batches:
        if not batch.num_rows:
            continue
        raw, offsets = bytes_and_offsets(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            part = offsets[at : end + 1]
            yield batch.slice(at, end - at), raw[part[0] : part[-1]], part - part[0]
            at = end
    tidy()


def word_bounds(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of ``inside`` within documents, and the first word of each document."""
    n = len(inside)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < n]
    begins[edges] = inside[edges]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    ends[last] = inside[last]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """64-bit hash of each byte span, A-Z folded to a-z if ``fold``."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _POWERS.upto(len(raw) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((_FOLDED if fold else _VALUES)[raw] * up[:-1], out=total[1:])
        return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of ``size`` consecutive words; of the whole sequence if it is shorter; none of none."""
    size = min(size, len(words))
    if not size:
        return np.zeros(0, np.uint64)
    keys = splitmix(size, 1013)
    with np.errstate(over="ignore"):
        out = np.full(len(words) - size + 1, size, np.uint64)
        for i in range(size):
            out += mix(words[i : len(words) - size + 1 + i] + keys[i])
        return mix(out)
