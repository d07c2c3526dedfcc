"""Sets of word shingles as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np

from gristmill.llm.blocks import RangeHash, mix

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words; a word is a run of bytes other than 20 and 09 to 0D (hex).

    Words end at the end of their text.
    """
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SEPARATOR[data]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    cuts = np.unique(cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)])
    if len(cuts):
        starts, ends = np.sort(np.r_[starts, cuts]), np.sort(np.r_[ends, cuts])
    return starts, ends


def shingle_sets(
    data: np.ndarray, offsets: np.ndarray, words: int
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, in one flat array, and its offsets.

    A-Z are lower-cased. A text of fewer words is one shingle of all its words; a text
    without words has no shingle.
    """
    rows = len(offsets) - 1
    starts, ends = word_spans(data, offsets)
    hashes = RangeHash(_LOWER[data]).of(starts, ends)
    first = np.searchsorted(starts, offsets)
    counts = np.diff(first)
    # The k-th word of a shingle is multiplied by the k-th of these odd numbers.
    odd = mix(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    n = np.maximum(counts - words + 1, (counts > 0).astype(np.int64))
    out = np.zeros(rows + 1, np.int64)
    np.cumsum(n, out=out[1:])
    row = np.repeat(np.arange(rows), n)
    at = first[:-1][row] + np.arange(out[-1]) - out[:-1][row]
    size = np.minimum(counts[row], words)
    values = mix(size.astype(np.uint64))
    padded = np.r_[hashes, np.zeros(words, np.uint64)]
    for k in range(words):
        values += np.where(k < size, padded[at + k], np.uint64(0)) * odd[k]
    values = mix(values)
    for a, b in zip(out[:-1].tolist(), out[1:].tolist()):
        values[a:b].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    sizes = np.bincount(row[keep], minlength=rows)
    final = np.zeros(rows + 1, np.int64)
    np.cumsum(sizes, out=final[1:])
    return values[keep], final
