"""Rows of a table as arrays that travel between blocks, many of them in one row of Spark.

Each key belongs to a block, by a hash. What a step makes for a block is one row with the
block's number and its arrays; a step then works on whole arrays, so that Spark moves,
sorts and converts few rows.
"""

from __future__ import annotations

import functools
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What travels between blocks: kind 0 is the block's own state, others are messages to it. With
#: its state a block tells how much is left to do, and of how much.
MESSAGE = "_block long, _kind int, _data binary, _left long, _total long"


def rows(found: list[tuple]) -> pa.RecordBatch:
    """Rows (block, kind, arrays), and if wanted what is left, of how much."""
    columns = list(zip(*((*r, 0, 0)[:5] for r in found))) or [()] * 5
    columns[2] = [pickle.dumps(d, 5) for d in columns[2]]
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["_block", "_kind", "_data", "_left", "_total"])


def deal(to: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The rows of the columns, which go to block ``to``, block by block."""
    order = np.argsort(to, kind="stable")
    to = to[order]
    starts = np.flatnonzero(first(to))
    for start, end in zip(starts, np.r_[starts[1:], len(to)]):
        yield int(to[start]), [c[order[start:end]] for c in columns]


def first(*keys: np.ndarray) -> np.ndarray:
    """Where keys that are sorted together begin to differ from those before."""
    out = np.ones(len(keys[0]), bool)
    if len(out):
        out[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return out


def received(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple], list[tuple]]]:
    """Block by block: its state (none or more parts) and the messages to it."""
    block, state, messages = None, [], []
    for batch in batches:
        data = batch.column(2)
        for k, (to, kind) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            if to != block:
                if block is not None:
                    yield block, state, messages
                block, state, messages = to, [], []
            (messages if kind else state).append(pickle.loads(data[k].as_buffer()))
    if block is not None:
        yield block, state, messages


class Step:
    """One step of all blocks: mapInArrow over rows (block, kind, data) sorted by block and kind."""

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, state, messages in received(batches):
            held, size = [], 0
            for row in self.step(block, state, messages):
                held.append(row)
                size += sum(getattr(a, "nbytes", 0) for a in row[2])
                if size > 1 << 24:
                    yield rows(held)
                    held, size = [], 0
            yield rows(held)

    def step(self, block: int, state: list[tuple], messages: list[tuple]) -> Iterator[tuple]:
        """Rows that a block makes of its state and the messages to it."""
        raise NotImplementedError


def dealt(parts: int, *tables: DataFrame) -> DataFrame:
    """States and messages in ``parts`` partitions, those of a block together and in order."""
    found = functools.reduce(DataFrame.unionByName, [t.select("_block", "_kind", "_data") for t in tables])
    return found.repartitionById(parts, (F.col("_block") % parts).cast("int")).sortWithinPartitions("_block", "_kind")
