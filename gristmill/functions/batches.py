"""Arrow batches in parts of bounded size.

A batch has a fixed number of rows, whatever their length. Python objects take many times
the room of the Arrow data, so they are made for one part of the rows at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that are Python objects at a time, about.
PART = 1 << 20


def _bytes(column: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def parts(column: pa.Array, most: int = PART) -> Iterator[pa.Array]:
    """The rows of a column of strings, or arrays of strings, in order, in parts of at most ``most`` bytes.

    Every string of an array counts one byte more. A longer row is a part of its own. A
    column without rows has no part.
    """
    if pa.types.is_list(column.type) or pa.types.is_large_list(column.type):
        offsets = column.offsets.to_numpy(zero_copy_only=False)
        ends = np.r_[0, np.cumsum(_bytes(column.values) + 1)][offsets]
        ends = ends[1:] - ends[0]
    else:
        ends = np.cumsum(_bytes(column))
    first, before = 0, 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(ends, before + most, "right")))
        yield column.slice(first, last - first)
        first, before = last, int(ends[last - 1])


def joined(pieces: list[pa.Array], kind: pa.DataType) -> pa.Array:
    """One array of the parts' results."""
    return pa.concat_arrays(pieces) if pieces else pa.array([], kind)
