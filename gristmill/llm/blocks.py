"""Arrow batches as numpy arrays, hashes over bytes, and size-checked broadcasts.

All hashes are polynomials over uint64 (wrapping), computed from one prefix sum per
block, so that the hash of any byte range costs two lookups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that are turned into arrays at a time; one longer text is taken alone.
BLOCK_BYTES = 1 << 20
#: A table that is joined by id is broadcast up to this size.
MAX_BROADCAST_BYTES = 64 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every input bit (murmur3's finalizer)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64))


def powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class RangeHash:
    """``of(start, end)``: 64-bit hashes of byte ranges of one block; equal bytes, equal hash."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data] * powers(n, _BASE), out=self._sums[1:])
        self._inverse = powers(n + 1, _BASE_INVERSE)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._inverse[start])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all strings and ``offsets`` (one more than rows); null is empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(ends, kind)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, text: int, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about ``limit`` bytes; a longer text is alone."""
    _, offsets = utf8(batch.column(text))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def packed(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """One binary value per row from a flat array and row offsets (in elements)."""
    data = np.ascontiguousarray(values)
    ends = pa.py_buffer((np.asarray(offsets, np.int64) * data.itemsize).tobytes())
    wide = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, ends, pa.py_buffer(data)])
    return wide.cast(pa.binary())


def lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """One int64 list per row from a flat array and row offsets."""
    return pa.ListArray.from_arrays(
        pa.array(np.asarray(offsets, np.int32)), pa.array(values.view(np.int64)))


def hash_bound(share: float) -> int:
    """The 64-bit integer up to which the lowest ``share`` of all signed 64-bit hashes go."""
    return min(int(min(1.0, share) * 2**64) - 2**63, 2**63 - 1)


def hash_below(share: float, *columns: Column) -> Column:
    """Whether the 64-bit hash of the columns is in the lowest ``share`` of all hashes, however small the share."""
    return F.xxhash64(*columns) <= F.lit(hash_bound(share))


def join_ids(
    rows: DataFrame, ids: DataFrame, on: str | list[str], how: str = "inner", bytes_of: Column | None = None
) -> DataFrame:
    """``rows`` joined to a written narrow table with unique ids.

    The table is broadcast when its rows take at most ``MAX_BROADCAST_BYTES``, so wide
    rows stay where they are; beyond that both sides are shuffled by id. ``bytes_of``
    is the size of a row of it (by default 32 bytes, for ids and a few numbers).
    """
    size = F.lit(32) if bytes_of is None else bytes_of
    if (ids.agg(F.sum(size)).first()[0] or 0) <= MAX_BROADCAST_BYTES:
        ids = F.broadcast(ids)
    return rows.join(ids, on, how)
