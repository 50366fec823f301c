"""Rolling hashes of byte and word sequences, and the windows that an anchor stands for."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

_BASES = (0x9E3779B97F4A7C15 | 1, 0xD1342543DE82EF95)


@lru_cache(maxsize=4)
def _powers(which: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    base = _BASES[which]
    inverse = pow(base, -1, 1 << 64)
    up = np.full(size, np.uint64(base), np.uint64)
    down = np.full(size, np.uint64(inverse), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


class Rolling:
    """Hash of any stretch of a sequence of 64-bit unit numbers, from one running sum."""

    def __init__(self, units: np.ndarray, which: int):
        size = 1 << max(16, int(len(units)).bit_length())
        up, self.down = _powers(which, size)
        self.sums = np.zeros(len(units) + 1, np.uint64)
        np.cumsum(units * up[: len(units)], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[begin]) * self.down[begin]

    def all(self, width: int) -> np.ndarray:
        """The hash of every stretch of `width` units."""
        if len(self.sums) <= width:
            return np.empty(0, np.uint64)
        return (self.sums[width:] - self.sums[:-width]) * self.down[: len(self.sums) - width]


def finished(values: np.ndarray) -> np.ndarray:
    """Mixed so that the upper bits depend on all bits."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


#: Two unit numbers for each byte.
BYTE_A, BYTE_B = finished(np.arange(1, 257, dtype=np.uint64)), finished(np.arange(1001, 1257, dtype=np.uint64))
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BLOCK = 1 << 20


def _names(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Name and first byte of each word, a run of bytes that are no blanks."""
    inside = ~_BLANK[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    begin, end = edge[::2], edge[1::2]
    a, b = Rolling(BYTE_A[data], 0).of(begin, end), Rolling(BYTE_B[data], 1).of(begin, end)
    return finished(finished(a) + b + (end - begin).astype(np.uint64)), begin


def word_names(values: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For blocks of texts: index of the first one, a 64-bit name for every word, and where each text
    begins among them. Equal words have equal names. A long text is named in parts, cut at a blank."""
    start = 0
    while start < len(values):
        stop, size = start, 0
        while stop < len(values) and (stop == start or size + len(values[stop]) < _BLOCK):
            size += len(values[stop])
            stop += 1
        if stop == start + 1 and size > 2 * _BLOCK:
            text, at, parts = values[start], 0, []
            while at < size:
                cut = next((k for k in range(min(at + _BLOCK, size), size) if _BLANK[text[k]]), size)
                parts.append(_names(np.frombuffer(text[at:cut], np.uint8))[0])
                at = cut
            names = np.concatenate(parts)
            yield start, names, np.array([0, len(names)])
        else:
            data = np.frombuffer(b" ".join([*values[start:stop], b""]), np.uint8)
            names, begin = _names(data)
            first = np.cumsum([0, *(len(v) + 1 for v in values[start:stop])])
            yield start, names, np.searchsorted(begin, first)
        start = stop


def least_at(keys: np.ndarray, width: int) -> np.ndarray:
    """For each i the place of the smallest of keys[i : i + width], the leftmost of several.

    The place stands in the low 24 bits while minima over doubled widths are taken, so a caller gives
    at most 2**24 keys; their upper 40 bits count.
    """
    if len(keys) < width:
        return np.empty(0, np.int64)
    best = (keys & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(keys), dtype=np.uint64)
    have = 1
    while 2 * have <= width:
        best = np.minimum(best[:-have], best[have:])
        have *= 2
    if have < width:
        best = np.minimum(best[: len(best) - (width - have)], best[width - have :])
    return (best & np.uint64(0xFFFFFF)).astype(np.int64)


def anchored(place: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window start of every run of valid windows that have the same anchor."""
    starts = np.flatnonzero(valid[: len(place)])
    if not len(starts):
        return starts, starts
    own = place[starts]
    cut = np.flatnonzero((own[1:] != own[:-1]) | (starts[1:] != starts[:-1] + 1)) + 1
    return starts[np.concatenate([[0], cut])], starts[np.concatenate([cut - 1, [len(starts) - 1]])]
