"""Benchmark decontamination: pigeonhole seeds, gram counts, exact edit verification.

A document holds an item when one of its substrings is within ``percent`` % of the item's
length in edit distance (bytes; A-Z and Latin-1 letters lower-cased, white space as blanks). An item
with ``e`` permitted edits is cut into ``e + h`` pieces; edits spoil at most ``e`` of
them, so ``h`` pieces at least stand unchanged in every such substring, within ``e`` places
of where they would without edits. Windows are laid wherever a document has that many. An edit also spoils at most ``GRAM`` of the item's grams, so
windows with too few of them leave, and then those in which too few stand in the places
of one occurrence. The rest is verified exactly: nothing is missed, whatever the edits
and however short the item.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.blocks import mix, pieces, utf8

#: Bytes of a piece at most; pieces are so long that about HITS of them stay whole, or one if that leaves less than 5 bytes.
SEED, HITS = 8, 2
#: Items sent to the tasks at a time, in bytes; a larger benchmark is taken in several passes.
ITEM_BYTES = 2 << 20
#: Bytes of text searched together, and of windows whose grams are counted together.
SEARCHED_BYTES, COUNTED_BYTES = 1 << 20, 1 << 19
#: Length of the strings counted before a pair is verified, and bits of their hashes.
GRAM, GRAM_BITS = 4, 12

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[9:14] = 32


def fold(data: np.ndarray) -> np.ndarray:
    """Lower case for A-Z and the Latin-1 letters (two bytes, C3 and 80 to 9E), blanks for white space."""
    out = _FOLD[data]
    if len(out):
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][capital] += 32
    return out


def codes(data: np.ndarray, length: int) -> np.ndarray:
    """The ``length`` bytes (8 at most) from each place on, as one integer."""
    n = max(0, len(data) - length + 1)
    out = np.zeros(n, np.uint64)
    for k in range(length):
        out = (out << np.uint64(8)) | data[k:k + n]
    return out


def gram_codes(data: np.ndarray) -> np.ndarray:
    return (mix(codes(data, GRAM)) >> np.uint64(64 - GRAM_BITS)).astype(np.int64)


def edit_end(item: bytes, text: bytes) -> tuple[int, int]:
    """Least distance of the item to a substring of the text and where it ends (bit-parallel)."""
    masks: dict[int, int] = defaultdict(int)
    for k, byte in enumerate(item):
        masks[byte] |= 1 << k
    full, top = (1 << len(item)) - 1, 1 << (len(item) - 1)
    up, down, distance, best = full, 0, len(item), (len(item), 0)
    for k, byte in enumerate(text):
        same = masks.get(byte, 0)
        carry = (((same & up) + up) ^ up) | same
        plus, minus = (down | ~(carry | up)) & full, up & carry
        vertical = same | down
        distance += bool(plus & top) - bool(minus & top)
        plus, minus = (plus << 1) & full, (minus << 1) & full
        up, down = (minus | ~(vertical | plus)) & full, plus & vertical
        if distance < best[0]:
            best = (distance, k + 1)
    return best


class Runs:
    """Where the rows of each key stand in a sorted array of keys."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.first, self.times = np.unique(keys, return_index=True, return_counts=True)

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and number of rows of every wanted key."""
        if not len(self.keys):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), np.int64)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return self.first[at], np.where(self.keys[at] == wanted, self.times[at], 0)


class Items:
    """Items of one pass: their pieces by length, and hashed grams of each as bits."""

    def __init__(self, ids: list[int], texts: list[str], percent: int):
        kept = [(i, fold(np.frombuffer(t.encode(), np.uint8))) for i, t in zip(ids, texts) if t and t.strip()]
        self.ids = [i for i, _ in kept]
        self.percent = percent
        self.bytes = [x.tobytes() for _, x in kept]
        self.size = np.array([len(x) for x in self.bytes], np.int64)
        keys = [np.uint64(k << 32) | codes(x, GRAM) for k, (_, x) in enumerate(kept)]
        places = np.concatenate([np.arange(len(x)) for x in keys] or [np.zeros(0, np.int64)])
        keys = np.concatenate(keys or [np.zeros(0, np.uint64)])
        order = np.argsort(keys, kind="stable")
        self.runs, self.places = Runs(keys[order]), places[order]
        self.bits = np.zeros((len(kept), 1 << GRAM_BITS >> 3), np.uint8)
        self.hits = np.ones(len(kept), np.int64)
        held: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        for item, (_, x) in enumerate(kept):
            at = gram_codes(x)
            np.bitwise_or.at(self.bits[item], at >> 3, (1 << (at & 7)).astype(np.uint8))
            most = int(self.edits(item))
            length = min(max(len(x) // (most + HITS), 5), len(x) // (most + 1), SEED)
            self.hits[item] = len(x) // length - most
            for offset in range(0, len(x) - length + 1, length):
                held[length].append((int.from_bytes(x[offset:offset + length].tobytes(), "big"), item, offset))
        self.pieces = []
        for length, rows in sorted(held.items()):
            rows.sort()
            value = np.array([r[0] for r in rows], np.uint64)
            sieve = np.zeros(1 << max(16, min(22, (32 * len(rows)).bit_length())), bool)
            sieve[(mix(value) & np.uint64(len(sieve) - 1)).astype(np.int64)] = True
            self.pieces.append((length, Runs(value), np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), sieve))

    def edits(self, item):
        return self.size[item] * self.percent // 100

    def find(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int]]:
        """``(row, item, distance, end)`` of all items that the texts hold."""
        data = fold(data)
        found: dict[tuple[int, int], tuple[int, int]] = {}
        raw = data.tobytes()
        row, item, left, right = self._aligned(data, offsets, *self._enough(data, *self._windows(data, offsets)))
        for k in range(len(row)):
            pair = (int(row[k]), int(item[k]))
            if pair in found and found[pair][0] == 0:
                continue
            most = int(self.edits(item[k]))
            distance, end = self._verify(int(item[k]), raw[left[k]:right[k]], most)
            if distance <= most and (pair not in found or distance < found[pair][0]):
                found[pair] = (distance, int(left[k]) + end - int(offsets[row[k]]))
        return [(r, i, d, e) for (r, i), (d, e) in sorted(found.items())]

    def _enough(self, data, row, item, left, right):
        """The windows, cut to the places around which enough grams of their item stand.

        A substring within the permitted edits has at most that many bytes more than the
        item, and in it stand all grams of the item that the edits leave.
        """
        need = self.size[item] - GRAM + 1 - GRAM * self.edits(item)
        grams, length = gram_codes(data), np.maximum(right - left - GRAM + 1, 0)
        keep, begin, end = need <= 0, left.copy(), right.copy()
        some = np.flatnonzero(~keep & (length >= need))
        ends = np.cumsum(length[some])
        for part in np.split(some, np.searchsorted(ends, np.arange(COUNTED_BYTES, ends[-1] if len(ends) else 0, COUNTED_BYTES))):
            if not len(part):
                continue
            size = length[part]
            first = np.cumsum(size) - size
            code = grams[np.arange(size.sum()) + np.repeat(left[part] - first, size)]
            sums = np.zeros(len(code) + 1, np.int64)
            np.cumsum((self.bits[np.repeat(item[part], size), code >> 3] >> (code & 7)) & 1, out=sums[1:])
            wide = np.minimum(size, self.size[item[part]] + self.edits(item[part]) - GRAM + 1)
            count = size - wide + 1
            start = np.cumsum(count) - count
            at = np.arange(count.sum()) + np.repeat(first - start, count)
            held = sums[at + np.repeat(wide, count)] - sums[at] >= np.repeat(need[part], count)
            any_ = np.add.reduceat(held, start, dtype=np.int64) > 0
            place = np.where(held, np.arange(len(held)) - np.repeat(start, count), 0)
            last = np.maximum.reduceat(place, start)
            place = np.where(held, place, len(held))
            new = np.minimum.reduceat(place, start)
            keep[part[any_]] = True
            begin[part[any_]] = (left[part] + new)[any_]
            end[part[any_]] = (left[part] + last + wide + GRAM - 1)[any_]
        return row[keep], item[keep], begin[keep], end[keep]

    def _aligned(self, data, offsets, row, item, left, right):
        """Places in the windows at which enough grams stand where one occurrence would have them.

        A gram that the edits leave stands at its place in the item from where the
        substring begins, give or take the permitted edits: its text place less its item
        place lies in a band of twice the edits and one.
        """
        most = self.edits(item)
        need = self.size[item] - GRAM + 1 - GRAM * most
        free = need <= 0
        found = [(row[free], item[free], left[free], right[free])]
        grams, some = codes(data, GRAM), np.flatnonzero(~free)
        length = np.maximum(right - left - GRAM + 1, 0)
        ends = np.cumsum(length[some])
        for part in np.split(some, np.searchsorted(ends, np.arange(COUNTED_BYTES, ends[-1] if len(ends) else 0, COUNTED_BYTES))):
            if not len(part):
                continue
            size = length[part]
            window = np.repeat(np.arange(len(part)), size)
            at = np.arange(size.sum()) + np.repeat(left[part] - (np.cumsum(size) - size), size)
            key = (item[part].astype(np.uint64) << np.uint64(32))[window] | grams[at]
            lo, times = self.runs.find(key)
            which = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(lo, times)
            window, place = np.repeat(window, times), self.places[which]
            shift = np.repeat(at, times) - place
            order = np.lexsort((shift, window))
            window, shift, place = window[order], shift[order], place[order]
            last = np.arange(len(window)) + need[part][window] - 1
            inside = np.flatnonzero(last < len(window))
            last = last[inside]
            good = (window[last] == window[inside]) & (shift[last] - shift[inside] <= 2 * most[part][window[inside]])
            inside, last = inside[good], last[good]
            if not len(inside):
                continue
            # Bands that begin within a band's width of each other are one place to look at.
            wide = 2 * most[part][window[inside]] + 1
            new = np.ones(len(inside), bool)
            bucket = shift[inside] // wide
            new[1:] = (window[inside][1:] != window[inside][:-1]) | (bucket[1:] != bucket[:-1])
            first = np.flatnonzero(new)
            final = np.append(first[1:], len(inside)) - 1
            low, high = inside[first], last[final]
            # A gram of the item counts once, however often the bands hold it.
            held = high - low + 1
            spot = np.repeat(np.arange(len(low)), held)
            pair = np.arange(held.sum()) + np.repeat(low - (np.cumsum(held) - held), held)
            single = np.unique(spot * (self.size.max() + 1) + place[pair]) // (self.size.max() + 1)
            which = part[window[low]]
            full = np.bincount(single, minlength=len(low)) >= need[which]
            low, high, which = shift[low[full]], shift[high[full]], which[full]
            found.append((
                row[which], item[which], np.maximum(low - most[which], offsets[row[which]]),
                np.minimum(high + self.size[item[which]] + 2 * most[which], offsets[row[which] + 1])))
        return tuple(map(np.concatenate, zip(*found)))

    def _verify(self, item: int, text: bytes, most: int) -> tuple[int, int]:
        x = self.bytes[item]
        at = text.find(x)
        if at >= 0:
            return 0, at + len(x)
        return edit_end(x, text)

    def _windows(self, data, offsets):
        """Rows, items and bounds of windows that have enough pieces of the item.

        The starts that pieces of one substring say lie within twice the permitted edits.
        Hits are counted in stretches of more starts than that, two neighbours together.
        """
        reach, count = int(self.size.max(initial=0)), max(1, len(self.ids))
        places = len(data) + 3 * reach + 24
        width = np.maximum(2 * self.edits(np.arange(len(self.ids))) + 1, 8)
        seen = [np.zeros(0, np.int64)]
        for length, runs, items, offset, sieve in self.pieces:
            text = codes(data, length)
            at = np.flatnonzero(sieve[(mix(text) & np.uint64(len(sieve) - 1)).astype(np.int64)])
            lo, times = runs.find(text[at])
            row = np.searchsorted(offsets, at, "right") - 1
            times = np.where(at + length <= offsets[row + 1], times, 0)
            which = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(lo, times)
            item = items[which]
            stretch = (np.repeat(at, times) - offset[which] + reach) // width[item]
            seen.append((np.repeat(row, times) * count + item) * places + stretch)
        code, hits = np.unique(np.concatenate(seen), return_counts=True)
        item = code // places % count
        # Of two stretches that have enough together, both are in the window; a run is one window.
        after = np.zeros(len(code), np.int64)
        after[:-1] = np.where(code[1:] == code[:-1] + 1, hits[1:], 0)
        before = np.zeros(len(code), np.int64)
        before[1:] = np.where(code[:-1] == code[1:] - 1, hits[:-1], 0)
        first, second = hits + after >= self.hits[item], hits + before >= self.hits[item]
        code, item = code[first | second], item[first | second]
        new = np.diff(code, prepend=-2) > 1
        begin, last = code[new], code[np.append(new[1:], True)[:len(code)]]
        item = item[new]
        row, most = begin // places // count, self.edits(item)
        start, end = (c % places * width[item] - reach for c in (begin, last))
        # A substring begins and ends within the permitted edits of where its piece says.
        return row, item, np.maximum(start - most, offsets[row]), np.minimum(
            end + width[item] - 1 + self.size[item] + most, offsets[row + 1])


    def search(self, texts: pa.Array) -> list[tuple[int, int, int, int]]:
        """:meth:`find` on a column; a text above ``SEARCHED_BYTES`` is searched in stretches.

        Stretches overlap by the longest occurrence that the permitted edits allow.
        """
        data, offsets = utf8(texts)
        if len(data) <= 2 * SEARCHED_BYTES:
            return self.find(data, offsets)
        overlap = int((self.size + self.edits(np.arange(len(self.ids)))).max(initial=0))
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for row in range(len(offsets) - 1):
            begin, end = int(offsets[row]), int(offsets[row + 1])
            for at in range(begin, end, SEARCHED_BYTES):
                part = data[at:min(end, at + SEARCHED_BYTES + overlap)]
                for _, item, distance, last in self.find(part, np.array([0, len(part)])):
                    if (row, item) not in best or distance < best[row, item][0]:
                        best[row, item] = (distance, at - begin + last)
        return [(r, i, d, e) for (r, i), (d, e) in sorted(best.items())]


class _Find:
    """mapInArrow over (id, text): one row per document and item that it holds."""

    def __init__(self, items: Items):
        self.items = items

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 1, SEARCHED_BYTES):
                found = self.items.search(part.column(1))
                rows, items, distances, ends = (list(c) for c in zip(*found)) if found else ([], [], [], [])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows, pa.int64())), pa.array([self.items.ids[i] for i in items], pa.int64()),
                     pa.array(distances, pa.int64()), pa.array(ends, pa.int64())],
                    ["doc_id", "item_id", "distance", "end_byte"])


class _Clean:
    """mapInArrow over whole rows: those that hold no item."""

    def __init__(self, items: Items, text: int):
        self.items, self.text = items, text

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, self.text, SEARCHED_BYTES):
                keep = np.ones(part.num_rows, bool)
                keep[[f[0] for f in self.items.search(part.column(self.text))]] = False
                yield part.filter(pa.array(keep))


def load_items(
    benchmark: DataFrame, percent: int = 15, item_id: str = "item_id", item_text: str = "text"
) -> list[Items]:
    """The benchmark in passes of about ``ITEM_BYTES``; null, blank and repeated items are left out.

    All passes are held by the driver, so this is for benchmarks of some hundred MB at most.
    """
    rows = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    rows = rows.filter("item_id IS NOT NULL AND text IS NOT NULL").dropDuplicates()
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    passes = total // ITEM_BYTES + 1
    out = []
    for k in range(passes):
        some = sorted(rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k).collect())
        out.append(Items([r[0] for r in some], [r[1] for r in some], percent))
    return out


def find_items(
    docs: DataFrame, items: list[Items], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, item_id, distance, end_byte``: one row per document and item that it holds.

    Whole texts are searched, in one pass without a shuffle (one for every ``ITEM_BYTES``
    of benchmark). Null and empty texts hold nothing; repeated rows give repeated results;
    an empty table or benchmark gives an empty result; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = None
    for part in items:
        one = rows.mapInArrow(_Find(part), "doc_id long, item_id long, distance long, end_byte long")
        found = one if found is None else found.unionByName(one)
    return found


def drop_contaminated(docs: DataFrame, items: list[Items], text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns as they were."""
    for part in items:
        docs = docs.mapInArrow(_Clean(part, docs.columns.index(text_col)), docs.schema)
    return docs
