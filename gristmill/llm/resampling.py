"""Target-distribution importance resampling with an open-addressed n-gram table per batch.

A document's weight is the log ratio of the hashed n-gram distributions of a target and of
all documents, summed over its n-grams. In each batch n-grams are interned in an
open-addressed NumPy table: keys are xxhash64, equal keys are verified byte by byte, and a
slot holds the bucket and the count of its n-gram. Slot ids of the occurrences gather the
counts of buckets in the first pass and the gains of buckets in the second. Ranks come
from ranges of the order, never from one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.blocks import pieces, utf8
from gristmill.llm.terms import LOWER, TERM, Lanes, gather, same_bytes, stretches
from gristmill.operators.plumbing import add_row_index
from gristmill.staging import stage

BUCKETS = 10_000
#: Percent of the eligible documents that are drawn, words that make one eligible, seed of the draw.
PERCENT, LEAST_WORDS, SEED = 10, 20, 2024

# ---- fixed values: the five primes of xxhash64 ----------------------------
_P1 = np.uint64(0x9E3779B185EBCA87)
_P2 = np.uint64(0xC2B2AE3D27D4EB4F)
_P3 = np.uint64(0x165667B19E3779F9)
_P4 = np.uint64(0x85EBCA77C2B2AE63)
_P5 = np.uint64(0x27D4EB2F165667C5)
# ---- end of fixed values --------------------------------------------------


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def xxhash64(lanes: Lanes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """xxhash64 (seed 0) of byte ranges; ranges of 32 bytes or more go through the library."""
    size = ends - starts
    out = size.astype(np.uint64) + _P5
    long_ = np.flatnonzero(size >= 32)
    short = np.where(size < 32, size, 0)
    for k in range(3):
        some = np.flatnonzero(short >= 8 * (k + 1))
        lane = _turn(lanes.wide[starts[some] + 8 * k] * _P2, 31) * _P1
        out[some] = _turn(out[some] ^ lane, 27) * _P1 + _P4
    at = starts + short // 8 * 8
    some = np.flatnonzero(short % 8 >= 4)
    out[some] = _turn(out[some] ^ (lanes.half[at[some]].astype(np.uint64) * _P1), 23) * _P2 + _P3
    at[some] += 4
    for k in range(3):
        some = np.flatnonzero(short % 4 > k)
        out[some] = _turn(out[some] ^ (lanes.padded[at[some] + k].astype(np.uint64) * _P5), 11) * _P1
    out ^= out >> np.uint64(33)
    out *= _P2
    out ^= out >> np.uint64(29)
    out *= _P3
    out ^= out >> np.uint64(32)
    for k in long_.tolist():
        out[k] = xxhash.xxh64_intdigest(lanes.padded[starts[k]:ends[k]])
    return out


class Table:
    """Open-addressed table of the n-grams of one stretch.

    ``slot`` has the slot of every occurrence; ``bucket`` and ``count`` are per slot.
    Occurrences are placed together, round by round: those at a free slot claim it, one
    of them wins, those that equal the winner stay, and the others go one slot on. Equal
    n-grams take the same path, so each has one slot.
    """

    def __init__(self, lanes: Lanes, starts: np.ndarray, ends: np.ndarray, buckets: int):
        n = len(starts)
        width = 1 << max(4, (2 * n - 1).bit_length())
        keys, size = xxhash64(lanes, starts, ends), ends - starts
        held = np.full(width, -1, np.int64)
        at = (keys & np.uint64(width - 1)).astype(np.int64)
        self.slot = np.zeros(n, np.int64)
        open_ = np.arange(n)
        while len(open_):
            here = at[open_]
            free = held[here] < 0
            held[here[free]] = open_[free]
            owner = held[here]
            same = (keys[owner] == keys[open_]) & (size[owner] == size[open_])
            k = np.flatnonzero(same & (owner != open_))
            same[k] = same_bytes(lanes, starts[owner[k]], lanes, starts[open_[k]], size[open_[k]])
            self.slot[open_[same]] = here[same]
            open_ = open_[~same]
            at[open_] = (at[open_] + 1) & (width - 1)
        used = np.flatnonzero(held >= 0)
        view, own = memoryview(lanes.padded), held[used]
        self.bucket = np.zeros(width, np.int64)
        self.bucket[used] = [
            zlib.crc32(view[a:b]) % buckets for a, b in zip(starts[own].tolist(), ends[own].tolist())]
        self.count = np.bincount(self.slot, minlength=width)


def occurrences(
    data: np.ndarray, offsets: np.ndarray, n: int, limit: int | None = None
) -> Iterator[tuple[Lanes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(bytes, starts, ends, rows, words of each row)`` of the n-grams of 1 to ``n`` words, by stretches.

    In the bytes the words are lower-cased (A-Z) and joined by one blank. The last
    ``n - 1`` words go on to the next stretch, where they only open n-grams.
    """
    rows = len(offsets) - 1
    kept = (np.zeros(0, np.int64),) * 3
    for _, _, starts, ends, row in stretches(data, offsets, TERM, limit):
        words = np.bincount(row, minlength=rows)
        carried = len(kept[0])
        starts, ends, row = (np.r_[k, x] for k, x in zip(kept, (starts, ends, row)))
        kept = tuple(x[max(0, len(x) - n + 1):] if n > 1 else x[:0] for x in (starts, ends, row))
        size = ends - starts
        flat = np.full(int(size.sum()) + len(size), 0x20, np.uint8)
        first = np.cumsum(size + 1) - size - 1
        flat[gather(first, size)] = LOWER[data[gather(starts, size)]]
        last = first + size
        begin, stop, owner = [], [], []
        for k in range(min(n, len(row))):
            whole = np.flatnonzero(row[k:] == row[:len(row) - k])
            whole = whole[whole + k >= carried]
            begin.append(first[whole])
            stop.append(last[whole + k])
            owner.append(row[whole])
        if begin:
            owner = np.concatenate(owner)
            order = np.argsort(owner, kind="stable")
            yield Lanes(flat), np.concatenate(begin)[order], np.concatenate(stop)[order], owner[order], words


class _Counts:
    """mapInArrow over (text): how many n-grams of all texts of the task fall into each bucket."""

    def __init__(self, n: int, buckets: int):
        self.n, self.buckets = n, buckets

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(self.buckets, np.int64)
        for batch in batches:
            for part in pieces(batch, 0):
                for lanes, starts, ends, _, _ in occurrences(*utf8(part.column(0)), self.n):
                    table = Table(lanes, starts, ends, self.buckets)
                    used = np.flatnonzero(table.count)
                    np.add.at(total, table.bucket[used], table.count[used])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])


class _Weights:
    """mapInArrow over (id, text): id, n-grams, words, sum of gains."""

    def __init__(self, n: int, gains: np.ndarray):
        self.n, self.gains = n, gains

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 1):
                rows = part.num_rows
                features, words, weight = (np.zeros(rows, np.int64) for _ in range(3))
                for lanes, starts, ends, row, more in occurrences(*utf8(part.column(1)), self.n):
                    table = Table(lanes, starts, ends, len(self.gains))
                    sums = np.zeros(len(row) + 1, np.int64)
                    np.cumsum(self.gains[table.bucket][table.slot], out=sums[1:])
                    border = np.searchsorted(row, np.arange(rows + 1))
                    weight += np.diff(sums[border])
                    features += np.diff(border)
                    words += more
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *map(pa.array, (features, words, weight))],
                    ["doc_id", "n_features", "n_words", "weight"])


def bucket_counts(texts: DataFrame, text_col: str = "text", n: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """N-grams of all texts in each bucket; a task sends at most ``buckets`` numbers."""
    counted = texts.select(F.col(text_col).alias("text")).mapInArrow(_Counts(n, buckets), "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, count in counted.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = count
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of the smoothed distributions of each bucket, in thousandths, rounded down."""
    more, less = (target + 1.0) * (source.sum() + float(len(source))), (source + 1.0) * (target.sum() + float(len(source)))
    return np.floor(1000 * np.log(more / less)).astype(np.int64)


def gumbel(seed: int, doc_id: Column) -> Column:
    """Gumbel noise in thousandths from a hash of seed and id (a missing id is empty), rounded down."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, n: int = 1, buckets: int = BUCKETS, percent: int = PERCENT,
    least_words: int = LEAST_WORDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text",
    target_text: str = "text",
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank``, one row per row of ``docs``.

    Drawn without replacement are ``percent`` % of the documents with ``least_words`` words
    or more, those with the highest weight plus noise; the others have no rank. Equal
    scores go by id, rows without an id last; rows that repeat are documents of their own.
    Null and empty texts have no n-grams and weight 0. An empty target or table is valid.
    Other columns are not read. Texts are read twice, in stretches, and never shuffled;
    what is sorted has one narrow row per document.
    """
    gains = bucket_gains(bucket_counts(docs, text_col, n, buckets), bucket_counts(target, target_text, n, buckets))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    weighed = rows.mapInArrow(_Weights(n, gains), "doc_id long, n_features long, n_words long, weight long")
    scored = stage(weighed.withColumn("score", F.col("weight") + gumbel(seed, F.col("doc_id"))), "weights")
    able = scored.filter(F.col("n_words") >= least_words)
    draws = able.count() * percent // 100
    order = able.withColumn("_down", -F.col("score")).withColumn("_id", F.coalesce("doc_id", F.lit((1 << 63) - 1)))
    ranked = add_row_index(order, ["_down", "_id", "n_features"], "_place")
    rank = F.when(F.col("_place") < draws, F.col("_place") + 1).cast("long")
    columns = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*columns, rank.alias("rank")).unionByName(
        scored.filter(F.col("n_words") < least_words).select(*columns, F.lit(None).cast("long").alias("rank")))


def resample_sql(docs: str = "documents", target: str = "benchmark") -> str:
    """DuckDB SQL of the default draw; the CRC table comes from its polynomial."""
    words = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return rf"""WITH held AS MATERIALIZED (SELECT row_number() OVER () AS no, doc_id, coalesce({words}, []) w FROM {docs}),
wanted AS MATERIALIZED (SELECT unnest({words}) x FROM {target}),
used AS MATERIALIZED (SELECT no, unnest(w) x FROM held),
crc AS MATERIALIZED (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) t),
hashed AS MATERIALIZED (SELECT x, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(strlen(x)),
  lambda k: ('0x' || hex(encode(x))[2 * k + 1:2 * k + 2])::BIGINT)), lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % {BUCKETS} bucket
  FROM (SELECT x FROM used UNION SELECT x FROM wanted), crc),
s AS (SELECT bucket, count(*) s FROM used JOIN hashed USING (x) GROUP BY bucket),
t AS (SELECT bucket, count(*) t FROM wanted JOIN hashed USING (x) GROUP BY bucket),
gains AS MATERIALIZED (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM used) + {BUCKETS}.0::DOUBLE)
  / ((coalesce(s, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM wanted) + {BUCKETS}.0::DOUBLE))))::BIGINT gain FROM s FULL JOIN t USING (bucket)),
weights AS (SELECT no, sum(gain)::BIGINT weight FROM used JOIN hashed USING (x) JOIN gains USING (bucket) GROUP BY no),
scored AS MATERIALIZED (SELECT h.no, h.doc_id, len(w)::BIGINT n_features, coalesce(weight, 0) weight, coalesce(weight, 0) + floor(-1000
  * ln(-ln((('0x' || sha256('{SEED}:' || coalesce(h.doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT score
  FROM held h LEFT JOIN weights USING (no)),
ranked AS (SELECT no, row_number() OVER (ORDER BY score DESC, doc_id) place, count(*) OVER () n FROM scored WHERE n_features >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {PERCENT} * n // 100 THEN place END AS rank FROM scored LEFT JOIN ranked USING (no)"""
