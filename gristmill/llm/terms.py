"""Words of many texts as byte ranges, taken in stretches so that no text has to fit in arrays whole."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes whose words are held as arrays at a time.
STRETCH_BYTES = 1 << 20

#: Bytes of terms: digits, letters and everything beyond ASCII.
TERM = np.zeros(256, bool)
TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Bytes of words: all but blanks and 09 to 0D (hex).
WORD = np.ones(256, bool)
WORD[[0x20, *range(0x09, 0x0E)]] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _cut(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, at: int) -> int:
    """The first place from ``at`` on where no word is cut."""
    border = int(offsets[np.searchsorted(offsets, at)]) if at < len(data) else len(data)
    step = 1 << 12
    while at < border:
        free = np.flatnonzero(~inside[data[at:min(border, at + step)]])
        if len(free):
            return at + int(free[0])
        at, step = at + step, step * 2
    return border


def stretches(
    data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, limit: int | None = None
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """``(begin, end, starts, ends, rows)`` of the words of each stretch of about ``limit`` bytes.

    A word is a run of ``inside`` bytes of one text; words are never cut, so a stretch
    is longer where one word is.
    """
    limit = limit or STRETCH_BYTES
    begin = 0
    while begin < len(data):
        end = _cut(data, offsets, inside, min(begin + limit, len(data)))
        edge = np.zeros(end - begin + 2, np.int8)
        edge[1:-1] = inside[data[begin:end]]
        full = edge
        edge = np.diff(edge)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        lo, hi = np.searchsorted(offsets, [begin, end], "right")
        borders = np.unique(offsets[lo:hi]) - begin
        borders = borders[(borders > 0) & (borders < end - begin)]
        borders = borders[(full[borders] == 1) & (full[borders + 1] == 1)]
        if len(borders):
            starts, ends = np.sort(np.r_[starts, borders]), np.sort(np.r_[ends, borders])
        starts, ends = starts + begin, ends + begin
        yield begin, end, starts, ends, np.searchsorted(offsets, starts, "right") - 1
        begin = end


def gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of all elements of the ranges, one range after the other."""
    first = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - first, sizes)


class Lanes:
    """Eight bytes from any place of a byte array as one little-endian integer."""

    def __init__(self, data: np.ndarray):
        self.padded = np.zeros(len(data) + 8, np.uint8)
        self.padded[:len(data)] = data
        self.wide = np.ndarray(len(data) + 1, "<u8", self.padded, 0, (1,))
        self.half = np.ndarray(len(data) + 5, "<u4", self.padded, 0, (1,))

    def masked(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The first ``size`` (0 to 8) bytes from each place."""
        drop = (8 * (8 - size)).astype(np.uint64)
        return np.where(size > 0, (self.wide[at] << drop) >> drop, np.uint64(0))


def same_bytes(
    a: Lanes, a_start: np.ndarray, b: Lanes, b_start: np.ndarray, size: np.ndarray
) -> np.ndarray:
    """Whether the ranges of equal sizes hold equal bytes."""
    out = a.masked(a_start, np.minimum(size, 8)) == b.masked(b_start, np.minimum(size, 8))
    left, step = np.flatnonzero(size > 8), 8
    while len(left):
        rest = np.minimum(size[left] - step, 8)
        out[left] &= a.masked(a_start[left] + step, rest) == b.masked(b_start[left] + step, rest)
        step += 8
        left = left[(size[left] > step) & out[left]]
    return out
