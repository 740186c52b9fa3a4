"""Wu-Manber search for many patterns at once, over byte arrays.

A window of the length of the shortest pattern slides over the text. The block of bytes at its end
is looked up in a shift table: how far the window may move without passing an occurrence. Where the
shift is nought, a hash bucket of that block names the patterns whose own window ends with it, and
direct comparison decides. Many stretches of the text are advanced together, each at its own pace.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np

_TABLE_BITS = 18
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: End positions that one stretch covers.
STRETCH = 4096


class WuManber:
    """Patterns of like length; ``search`` yields (start, pattern index) of every occurrence."""

    def __init__(self, patterns: list[bytes]) -> None:
        self.patterns = patterns
        self.m = min(map(len, patterns))
        self.block = next(b for b in (8, 4, 2, 1) if b == 1 or self.m >= 2 * b)
        heads = np.frombuffer(b"".join(bytes(8) + p[: self.m] for p in patterns), np.uint8).reshape(len(patterns), self.m + 8)
        self.shift = np.full(1 << _TABLE_BITS, self.m - self.block + 1, np.int32)
        self.buckets: dict[int, list[int]] = defaultdict(list)
        for end in range(self.block, self.m + 1):
            code = self._code(np.ascontiguousarray(heads[:, end : end + 8]).view("<u8").ravel())
            np.minimum.at(self.shift, code, self.m - end)
            if end == self.m:
                for i, c in enumerate(code.tolist()):
                    self.buckets[c].append(i)

    def _code(self, last8: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (((last8 >> np.uint64(64 - 8 * self.block)) * _MULTIPLIER) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)

    def search(self, text: np.ndarray) -> list[tuple[int, int]]:
        n = len(text)
        if n < self.m:
            return []
        padded = np.concatenate([np.zeros(8, np.uint8), text])
        last8 = np.ndarray((n + 1,), "<u8", padded.data, strides=(1,))
        at = np.arange(self.m, n + 1, STRETCH)
        stop = np.minimum(at + STRETCH, n + 1)
        ends, codes = [], []
        while len(at):
            code = self._code(last8[at])
            step = self.shift[code]
            hit = step == 0
            if hit.any():
                ends.append(at[hit])
                codes.append(code[hit])
            at = at + np.maximum(step, 1)
            going = at < stop
            if not going.all():
                at, stop = at[going], stop[going]
        if not ends:
            return []
        data, found = text.tobytes(), []
        for end, code in zip(np.concatenate(ends).tolist(), np.concatenate(codes).tolist()):
            start = end - self.m
            for i in self.buckets.get(code, ()):
                if data.startswith(self.patterns[i], start):
                    found.append((start, i))
        return found


class PatternSet:
    """Patterns of any lengths, searched in classes of like length so that long ones keep long shifts."""

    def __init__(self, patterns: list[bytes]) -> None:
        classes: dict[int, list[int]] = defaultdict(list)
        for i, p in enumerate(patterns):
            if p:
                classes[min(len(p).bit_length(), 6)].append(i)
        self.parts = [(ids, WuManber([patterns[i] for i in ids])) for ids in classes.values()]

    def search(self, text: np.ndarray) -> list[tuple[int, int]]:
        return [(start, ids[i]) for ids, part in self.parts for start, i in part.search(text)]
