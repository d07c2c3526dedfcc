"""Suffix-array dedup: removal of every byte inside a string that also starts elsewhere.

Suffixes are put into buckets by bucket-pointer refinement. The bucket of a position is a
64-bit identifier of the bytes that follow it: first 8 bytes, then twice as many in each
round, by pairing the identifier of the position with the identifier of the position that
many bytes later. Identifiers of one round are reused for all later ones, and only buckets
that can hold two suffixes go on:

1. At a quarter of the length, the smallest identifier in every stretch of positions that
   a full-length string spans is an anchor. Equal strings have equal anchors, so a string
   whose anchor bucket holds one position is unique. About one position in 150 is an
   anchor; anchor buckets are counted by Spark.
2. Strings whose anchor is shared are refined to the full length. Their identifiers, 8
   bytes each and nothing else, go to the range of identifiers they belong to, are sorted
   there, and one bit each comes back: whether the bucket holds a second one.

Texts that are copies of each other are one text with a count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.blocks import join_ids, lists, mix, pieces, utf8
from gristmill.operators.skew import join_groups
from gristmill.staging import stage

#: Bytes turned into identifiers at a time.
BLOCK = 512 << 10
#: Identifiers sorted by one task, about.
RANGE = 1_000_000
#: Identifiers of a chunk, about.
CHUNK = 500_000

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _pair(ids: np.ndarray, later: int) -> np.ndarray:
    """Identifiers of each position together with the one ``later`` positions on."""
    return mix(ids[:len(ids) - later] * _ODD + ids[later:])


def refine(data: np.ndarray, length: int, ids: np.ndarray | None = None, depth: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
    """Identifiers of ``length`` bytes at every position; also the last doubled ones and their depth."""
    if ids is None:
        n = max(0, len(data) - 7)
        words = np.ndarray(n, "<u8", np.ascontiguousarray(data), strides=(1,)) if n else np.zeros(0, np.uint64)
        ids, depth = mix(words + _ODD), 8
    while depth * 2 <= length and len(ids):
        ids, depth = _pair(ids, depth) if len(ids) > depth else ids[:0], depth * 2
    later = length - depth
    return (_pair(ids, later) if len(ids) > later else ids[:0]) if later else ids, ids, depth


def _slide(x: np.ndarray, width: int, best) -> np.ndarray:
    """``best`` of every ``width`` neighbours, by doubling."""
    have = 1
    while have * 2 <= width:
        x, have = best(x[:-have], x[have:]), have * 2
    rest = width - have
    return best(x[:len(x) - rest], x[rest:]) if rest else x


class _Strings:
    """Anchors and identifiers of the strings of a block of texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int):
        gram = max(8, length // 4)
        width = length - gram + 1
        n = len(data) - length + 1
        self._ends = offsets[1:]
        self.row = np.zeros(0, np.int64)
        self.start = self.row
        if n <= 0:
            self.low = self.grams = np.zeros(0, np.uint64)
            self.valid = np.zeros(0, bool)
            return
        self.grams, self._ids, self._depth = refine(data, gram)
        self._length = length
        self.low = _slide(self.grams, width, np.minimum)[:n]
        size = np.diff(offsets)
        self.row = np.repeat(np.arange(len(size)), size)[:n]
        self.valid = np.arange(n) + length <= offsets[1:][self.row]
        self._width = width

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows and identifiers of all anchors, one entry per position."""
        if not len(self.valid):
            return self.row, self.low
        low = np.where(self.valid, self.low, np.uint64(0))
        pad = np.zeros(self._width - 1, np.uint64)
        highest = _slide(np.concatenate([pad, low, pad]), self._width, np.maximum)[:len(self.grams)]
        at = np.flatnonzero((self.grams[:len(highest)] == highest) & (highest != 0))
        return np.searchsorted(self._ends, at, "right"), self.grams[at]

    def open(self, shared: np.ndarray) -> np.ndarray:
        """Starts of the strings whose anchor is in ``shared``."""
        if not len(self.valid):
            return np.zeros(0, np.int64)
        change = np.flatnonzero(np.r_[True, self.low[1:] != self.low[:-1]])
        known = np.isin(self.low[change], shared)
        return np.flatnonzero(np.repeat(known, np.diff(np.r_[change, len(self.low)])) & self.valid)

    def full(self) -> np.ndarray:
        return refine(np.zeros(0, np.uint8), self._length, self._ids, self._depth)[0]


def _blocks(batch: pa.RecordBatch, text: int, length: int) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with bytes and offsets; a long text comes in stretches that overlap.

    The number tells at which byte of its text the slice begins; stretches overlap by
    ``length - 1`` bytes, so every string is in exactly one.
    """
    for part in pieces(batch, text, BLOCK):
        data, offsets = utf8(part.column(text))
        if part.num_rows > 1 or len(data) <= 2 * BLOCK:
            yield 0, part, data, offsets
            continue
        for at in range(0, max(1, len(data) - length + 1), BLOCK):
            some = data[at:at + BLOCK + length - 1]
            yield at, part, some, np.array([0, len(some)])


class _Anchors:
    """mapInArrow over (key, id, text): each anchor of a text once, twice if it repeats in it."""

    def __init__(self, length: int):
        self.length = length

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, part, data, offsets in _blocks(batch, 2, self.length):
                row, ids = _Strings(data, offsets, self.length).anchors()
                order = np.lexsort((ids, row))
                row, ids = row[order], ids[order]
                third = np.zeros(len(ids), bool)
                third[2:] = (ids[2:] == ids[:-2]) & (row[2:] == row[:-2])
                row, ids = row[~third], ids[~third]
                ends = np.searchsorted(row, np.arange(part.num_rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([at] * part.num_rows), lists(ids, ends)],
                    ["_key", "_id", "_at", "_anchors"])


#: What travels to the ranges: identifiers of a chunk of texts, or the record of the chunk.
_SENT = (
    "_part long, _chunk long, _twice boolean, _ids binary, "
    "_keys array<binary>, _ats array<long>, _counts array<long>, _copied array<boolean>, _which binary")


def _sent_batch(rows: list[tuple], last: str) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64()),
             pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.binary())
    names = ["_part", "_chunk", "_twice", last, "_keys", "_ats", "_counts", "_copied", "_which"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


class _Identifiers:
    """mapInArrow over (key, copies, shared, text): identifiers of open strings by range.

    The texts of a task are gathered to chunks. A chunk sends one row to each range, and a
    record of which identifier went where, so that the bits that come back find their place.
    """

    def __init__(self, length: int, parts: int):
        self.length, self.parts = length, parts

    def _flush(self, chunk: int, held: list[tuple]) -> pa.RecordBatch:
        keys, ats, copied, ids = zip(*held)
        counts = [len(i) for i in ids]
        flat = np.concatenate(ids)
        which = (flat % np.uint64(self.parts)).astype(np.uint32)
        place = which * np.uint32(2) + np.repeat(np.array(copied, np.uint32), counts)
        order = np.argsort(place, kind="stable")
        cuts = np.flatnonzero(np.diff(place[order])) + 1
        rows = [
            (int(place[mine[0]]) >> 1, chunk, bool(place[mine[0]] & 1), flat[mine].tobytes(), None, None, None, None, None)
            for mine in np.split(order, cuts)]
        small = which.astype(np.uint16) if self.parts <= 1 << 16 else which
        rows.append((chunk % self.parts, chunk, None, None, keys, ats, counts, copied, small.tobytes()))
        return _sent_batch(rows, "_ids")

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        # The same task sees the same texts in the same order, so chunks keep their names.
        chunk, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for at, part, data, offsets in _blocks(batch, 3, self.length):
                keys, copies = part.column(0).to_pylist(), part.column(1).to_pylist()
                strings, starts = open_strings(data, offsets, part.column(2), self.length)
                if not len(starts):
                    continue
                ids, row = strings.full()[starts], strings.row[starts]
                for mine in np.split(np.arange(len(starts)), np.flatnonzero(np.diff(row)) + 1):
                    r = int(row[mine[0]])
                    held.append((keys[r], at, copies[r] > 1, ids[mine]))
                size += len(starts)
                if size >= CHUNK:
                    yield self._flush(chunk, held)
                    chunk, held, size = chunk + 1, [], 0
        if held:
            yield self._flush(chunk, held)


def open_strings(data, offsets, shared: pa.Array, length: int) -> tuple[_Strings, np.ndarray]:
    """Strings of a block, and the starts of those whose anchors are shared."""
    values = shared.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    strings = _Strings(data, offsets, length)
    return strings, strings.open(np.unique(values))


class _Shared:
    """mapInArrow over identifiers sorted by range: a bit for each, set if its bucket holds two."""

    def _bits(self, rows: list[tuple]) -> pa.RecordBatch:
        ids = [np.frombuffer(r[3], np.uint64) for r in rows]
        sizes = [len(i) for i in ids]
        flat = np.concatenate(ids)
        order = np.argsort(flat)
        held = flat[order]
        same = held[1:] == held[:-1]
        twice = np.zeros(len(flat), bool)
        twice[1:] |= same
        twice[:-1] |= same
        # A text that has copies counts for two.
        copied = np.repeat([r[2] for r in rows], sizes)[order]
        if copied.any():
            bucket = np.cumsum(np.r_[True, ~same]) - 1
            twice |= np.bincount(bucket, copied)[bucket] > 0
        flags = np.empty(len(flat), bool)
        flags[order] = twice
        ends = np.cumsum([0, *sizes])
        bits = [np.packbits(flags[a:b]).tobytes() for a, b in zip(ends, ends[1:])]
        return _sent_batch([(*r[:3], b, *r[4:]) for r, b in zip(rows, bits)], "_bits")

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[3] is None:
                    yield _sent_batch([(-1, *row[1:])], "_bits")
                    continue
                if row[0] != group and rows:
                    yield self._bits(rows)
                    rows = []
                group = row[0]
                rows.append(row)
        if rows:
            yield self._bits(rows)


class _Return:
    """mapInArrow over bits sorted by chunk, its record first: the bits of each text."""

    @staticmethod
    def _texts(record: tuple, rows: list[tuple]) -> pa.RecordBatch:
        _, _, _, _, keys, ats, counts, copied, which = record
        total = sum(counts)
        place = np.frombuffer(which, np.uint16 if len(which) == 2 * total else np.uint32).astype(np.uint32)
        place = place * np.uint32(2) + np.repeat(np.array(copied, np.uint32), counts)
        order = np.argsort(place, kind="stable")
        found = {(r[0], r[2]): r[3] for r in rows}
        flags = np.zeros(total, bool)
        for mine in np.split(order, np.flatnonzero(np.diff(place[order])) + 1):
            bits = found[int(place[mine[0]]) >> 1, bool(place[mine[0]] & 1)]
            flags[mine] = np.unpackbits(np.frombuffer(bits, np.uint8))[:len(mine)]
        ends = np.cumsum([0, *counts])
        packed = [np.packbits(flags[a:b]).tobytes() for a, b in zip(ends, ends[1:])]
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(ats, pa.int64()), pa.array(packed, pa.binary())], ["_key", "_at", "_bits"])

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record, rows = None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] < 0:
                    if record:
                        yield self._texts(record, rows)
                    record, rows = row, []
                else:
                    rows.append(row)
        if record:
            yield self._texts(record, rows)


class _Remove:
    """mapInArrow over (id, copies, shared, bits, text): what is kept, and the removed spans."""

    def __init__(self, length: int):
        self.length = length

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 4, BLOCK):
                data, offsets = utf8(part.column(4))
                cover = np.zeros(len(data) + 1, np.int32)
                size = np.diff(offsets)
                copies = part.column(1).to_pylist()
                copied = np.array([(c or 1) > 1 for c in copies]) & (size >= self.length)
                np.add.at(cover, offsets[:-1][copied], 1)
                np.add.at(cover, offsets[1:][copied], -1)
                open_ = pa.array([b is not None and not c for b, c in zip(part.column(3).to_pylist(), copied)])
                at = np.flatnonzero(open_.to_numpy(zero_copy_only=False))
                # The same stretches as when the identifiers were sent, so the bits fit.
                for k in at.tolist():
                    bits = {b["_at"]: b["_bits"] for b in part.column(3)[k].as_py()}
                    for begin, _, some, ends in _blocks(part.slice(k, 1), 4, self.length):
                        _, starts = open_strings(some, ends, part.column(2).slice(k, 1), self.length)
                        if len(starts):
                            flags = np.unpackbits(np.frombuffer(bits[begin], np.uint8))[:len(starts)].astype(bool)
                            found = offsets[k] + begin + starts[flags]
                            np.add.at(cover, found, 1)
                            np.add.at(cover, found + self.length, -1)
                gone = np.cumsum(cover)[:-1] > 0
                yield self._rows(part, data, offsets, gone)

    @staticmethod
    def _rows(part, data, offsets, gone) -> pa.RecordBatch:
        kept, spans = [], []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            mine = gone[a:b]
            if not mine.any():
                kept.append(data[a:b].tobytes())
                spans.append([])
                continue
            kept.append(data[a:b][~mine].tobytes())
            edge = np.flatnonzero(np.diff(np.r_[False, mine, False].astype(np.int8))).reshape(-1, 2)
            spans.append([{"start": int(s), "end": int(e)} for s, e in edge])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(np.diff(offsets)), pa.array(kept, pa.binary()), pa.array(spans, kind)],
            ["doc_id", "n_bytes", "kept", "spans"])


def remove_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, kept, spans`` for every row, judged on the texts as they came.

    ``kept`` is what is left of the text's UTF-8 bytes after removing each byte covered by
    a string of ``length`` bytes that also starts anywhere else, the same text included;
    ``spans`` are the maximal removed runs (``start, end``). Strings never cross texts. A
    null text is empty; texts shorter than ``length`` are kept. Rows are told apart by
    their texts, so repeated ids or missing ids do no harm, and repeated rows are copies
    of each other. An empty table gives an empty result; other columns are not read.
    ``length`` is at least 32. Different strings have equal identifiers with a chance of
    about 2**-64 a pair.
    """
    if length < 32:
        raise ValueError("length must be at least 32")
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).cast("long").alias("_id"), text.alias("_text")).withColumn(
        "_key", F.unhex(F.md5(F.col("_text").cast("binary"))))
    long_ = base.filter(F.octet_length("_text") >= length)
    anchored = stage(long_.select("_key", "_id", "_text").mapInArrow(
        _Anchors(length), "_key binary, _id long, _at long, _anchors array<long>"), "anchors")
    # A long text comes in stretches, each a row of its own.
    classes = stage(anchored.groupBy("_key", "_at").agg(
        F.count("*").alias("_copies"), F.min("_id").alias("_id"), F.first("_anchors").alias("_anchors")), "classes")
    entries = classes.select("_key", F.explode("_anchors").alias("_anchor"))
    shared = entries.groupBy("_anchor").agg(F.count("*").alias("_weight")).filter("_weight > 1")
    held = join_groups(entries, shared, ["_anchor"], "_weight", ["_key"])
    held = stage(held.groupBy("_key").agg(F.collect_set("_anchor").alias("_shared")), "shared")
    whole = classes.groupBy("_key").agg(F.max("_copies").alias("_copies"), F.min("_id").alias("_id"))
    open_ = stage(whole.join(held, "_key").withColumnRenamed("_id", "_first"), "open")
    expected = open_.agg(F.sum(F.size("_shared"))).first()[0] or 0
    parts = max(1, -(-expected * length // 3 // RANGE))
    one = join_ids(long_, open_, "_key", bytes_of=F.size("_shared") * 8 + 64).filter(F.col("_id").eqNullSafe(F.col("_first")))
    sent = one.select("_key", "_copies", "_shared", "_text").mapInArrow(_Identifiers(length, parts), _SENT)
    back = sent.repartition("_part").sortWithinPartitions("_part").mapInArrow(_Shared(), _SENT.replace("_ids", "_bits"))
    back = back.repartition("_chunk").sortWithinPartitions("_chunk", "_part").mapInArrow(
        _Return(), "_key binary, _at long, _bits binary")
    bits = stage(back, "bits").dropDuplicates(["_key", "_at"]).groupBy("_key").agg(
        F.collect_list(F.struct("_at", "_bits")).alias("_bits"))
    known = stage(whole.select("_key", "_copies").join(open_.select("_key", "_shared"), "_key", "left").join(
        bits, "_key", "left").filter("_copies > 1 OR _bits IS NOT NULL"), "known")
    size = F.coalesce(F.size("_shared"), F.lit(0)) * 8 + 64 + F.aggregate(
        F.coalesce("_bits", F.array()), F.lit(0), lambda n, b: n + 32 + F.octet_length(b["_bits"]))
    rows = join_ids(base, known, "_key", "left", size).select("_id", "_copies", "_shared", "_bits", "_text")
    return rows.mapInArrow(
        _Remove(length), "doc_id long, n_bytes long, kept binary, spans array<struct<start:long,end:long>>")
