"""Token-id shards with Elias-Fano document boundaries.

A shard is one file: a header, the ids of its documents one after another in 2 bytes each
(4 when the vocabulary needs it), and two Elias-Fano sequences: where documents begin, and
their ids. Both have select samples, so one offset is found without decoding the rest and
no table of 64-bit offsets is kept. Shards are written by tasks under a name of their own
in the shared folder; a manifest, committed by Spark, lists the ones that count.
"""

from __future__ import annotations

import json
import re
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from types import ModuleType

import numpy as np
import pyarrow as pa
import regex
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gristmill.staging import new_path

MAGIC = b"GRSTIDS1"
#: Ids in a shard; a longer document has a shard of its own.
SHARD_IDS = 1 << 23
#: One in so many set bits has its position stored.
SELECT_STEP = 128
#: Different word pieces whose ids a task remembers.
REMEMBERED = 300_000
#: Ids that one task reads back, about.
READ_IDS = 1 << 22
#: Fixed value: the pre-tokens of byte-level tokenizers.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters that libraries disagree on as white space.
_CONTROL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\xa0]")


@dataclass
class EliasFano:
    """A non-decreasing sequence in ``width + 2`` bits an element, or about that."""

    n: int
    width: int
    low: np.ndarray
    high: np.ndarray
    samples: np.ndarray

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        most = int(values[-1]) if n else 0
        width = max(0, (most // n).bit_length() - 1) if n else 0
        shifts = np.arange(width, dtype=np.uint64)
        low = np.packbits(((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8), bitorder="little")
        at = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        bits = np.zeros(int(at[-1]) + 1 if n else 0, np.uint8)
        bits[at] = 1
        return cls(n, width, low, np.packbits(bits, bitorder="little"), at[::SELECT_STEP].astype(np.uint32))

    def _low(self, index: np.ndarray) -> np.ndarray:
        out = np.zeros(len(index), np.uint64)
        for k in range(self.width):
            bit = index * self.width + k
            out |= ((self.low[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).astype(np.uint64) << np.uint64(k)
        return out

    def select(self, index: int) -> int:
        """Element ``index``: from the sample before it, bytes are skipped by their bit counts."""
        if not 0 <= index < self.n:
            raise IndexError(index)
        at = int(self.samples[index // SELECT_STEP])
        rest = index % SELECT_STEP
        byte = at >> 3
        here = np.unpackbits(self.high[byte:byte + 1], bitorder="little")
        here[:at & 7] = 0
        while rest >= here.sum():
            rest -= int(here.sum())
            byte += 1
            here = np.unpackbits(self.high[byte:byte + 1], bitorder="little")
        at = byte * 8 + int(np.flatnonzero(here)[rest])
        return ((at - index) << self.width) | int(self._low(np.array([index]))[0])

    def all(self) -> np.ndarray:
        at = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        index = np.arange(self.n)
        return ((at - index).astype(np.uint64) << np.uint64(self.width)) | self._low(index)

    def to_bytes(self) -> bytes:
        head = np.array([self.n, self.width, len(self.low), len(self.high), len(self.samples)], "<i8")
        return head.tobytes() + self.low.tobytes() + self.high.tobytes() + self.samples.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> tuple[EliasFano, int]:
        n, width, low, high, samples = np.frombuffer(data, "<i8", 5).tolist()
        at = 40
        parts = []
        for kind, size in ((np.uint8, low), (np.uint8, high), (np.dtype("<u4"), samples)):
            parts.append(np.frombuffer(data, kind, size, at))
            at += parts[-1].nbytes
        return cls(n, width, *parts), at


def shard_bytes(doc_ids: list[int | None], counts: list[int], ids: bytes, width: int) -> bytes:
    """One shard: documents without an id come first, the others in ascending order."""
    known = [d for d in doc_ids if d is not None]
    base = known[0] if known else 0
    head = np.array([len(doc_ids), len(doc_ids) - len(known), base, sum(counts), width], "<i8")
    ends = np.zeros(len(counts) + 1, np.uint64)
    np.cumsum(counts, out=ends[1:])
    names = np.array(known, np.int64).view(np.uint64) - np.uint64(base % (1 << 64))
    return b"".join([MAGIC, head.tobytes(), ids, EliasFano.encode(ends).to_bytes(), EliasFano.encode(names).to_bytes()])


@dataclass
class Shard:
    """A shard that has been read; ``ids(i)`` are those of its i-th document."""

    doc_ids: list[int | None]
    bounds: EliasFano
    tokens: np.ndarray

    @classmethod
    def read(cls, data: bytes) -> Shard:
        if data[:8] != MAGIC:
            raise ValueError("not a shard of token ids")
        docs, nulls, base, total, width = np.frombuffer(data, "<i8", 5, 8).tolist()
        tokens = np.frombuffer(data, f"<u{width}", total, 48)
        rest = memoryview(data)[48 + total * width:]
        bounds, used = EliasFano.from_bytes(rest)
        names, _ = EliasFano.from_bytes(rest[used:])
        known = (names.all() + np.uint64(base % (1 << 64))).view(np.int64).tolist()
        return cls([None] * nulls + known, bounds, tokens)

    def ids(self, i: int) -> np.ndarray:
        return self.tokens[self.bounds.select(i):self.bounds.select(i + 1)]


class _Pieces(dict):
    """Ids, as bytes, of a word with the blank before it; new words are encoded when asked for.

    A word with white space at an end has None: the blank beside it is not a cut.
    """

    def __init__(self, tokenizer, width: int, before: dict):
        super().__init__()
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self.letters = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
        self.tokenizer, self.model, self.before = tokenizer, tokenizer.model, before
        self.width, self.code = width, "H" if width == 2 else "I"
        self.cut = regex.compile(PRE_TOKENS).findall

    def __missing__(self, word: str) -> bytes | None:
        if word in self.before:
            ids = self.before[word]
        elif not word or word[0].isspace() or word[-1].isspace():
            ids = None
        elif word.isalpha():
            ids = self.token(" " + word)
        elif max(word) < "\u0250" and not _CONTROL.search(word):
            first, *rest = self.cut(" " + word)
            ids = (self[first[1:]] if first[1:].isalpha() else self.token(first)) + b"".join(map(self.inner, rest))
        else:
            ids = self.whole(" " + word)
        self[word] = ids
        return ids

    def token(self, text: str) -> bytes:
        """One pre-token, which the model takes in its byte alphabet."""
        mapped = "\u0120" + text[1:] if text[0] == " " and text[1:].isascii() and text[1:].isalpha() else (
            text.encode().decode("latin-1").translate(self.letters))
        return array(self.code, [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def inner(self, text: str) -> bytes:
        # Words after a blank never begin with one, so these keys are free.
        key = " " + text
        if not dict.__contains__(self, key):
            self[key] = self.before.get(key) or self.token(text)
        return self[key]

    def whole(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


class WordIds:
    """Ids of whole texts through a memory of words.

    The byte-level pre-tokenizer always begins a piece at a single blank between two
    characters that are not white space. Texts are cut there and each different stretch is
    encoded once, with the same result as encoding the text whole. ``REMEMBERED`` bounds
    the memory; what was used before it filled up stays at hand for one more round.
    """

    _gap = re.compile(r"(?<=\S) (?=\S)")

    def __init__(self, tokenizer, width: int, added: list[str] | None = None):
        self.known = _Pieces(tokenizer, width, {})
        self.added = re.compile("|".join(map(re.escape, added))).search if added else None

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            old = self.known
            self.known = _Pieces(old.tokenizer, old.width, dict(old))
        known, out = self.known, []
        get = known.__getitem__
        for text in texts:
            if self.added and self.added(text):  # added tokens go across words
                out.append(known.whole(text))
                continue
            words = text.split(" ")
            first = words.pop(0)
            try:
                if first[-1:].isspace() or not first:
                    raise TypeError
                out.append(known.whole(first) + b"".join(map(get, words)))
            except TypeError:  # a blank beside other white space: cut at the safe ones only
                first, *words = self._gap.split(text)
                parts = [known.whole(first)]
                for word in words:
                    ids = get(word)
                    parts.append(known.whole(" " + word) if ids is None else ids)
                out.append(b"".join(parts))
        return out


class WholeIds:
    """Ids of texts that the library encodes one by one, whole."""

    def __init__(self, tokenizer, width: int):
        self.whole = _Pieces(tokenizer, width, {}).whole

    def __call__(self, texts: list[str]) -> list[bytes]:
        return [self.whole(text) for text in texts]


def cuts_at_blanks(settings: dict) -> bool:
    """Whether a tokenizer file has the rules that :class:`WordIds` relies on and no others."""
    before, model = settings.get("pre_tokenizer") or {}, settings["model"]
    return (
        settings.get("normalizer") is None and settings.get("truncation") is None and settings.get("padding") is None
        and before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
        and model.get("type") == "BPE" and not model.get("dropout") and not model.get("continuing_subword_prefix")
        and not model.get("end_of_word_suffix") and not model.get("ignore_merges") and not model.get("byte_fallback")
        and all(t.get("normalized") is not None for t in settings.get("added_tokens") or []))


def encoder(tokenizer_json: str, width: int) -> WordIds | WholeIds:
    """The ids that the library gives each text, by way of its words where the file permits that."""
    from tokenizers import Tokenizer

    settings, tokenizer = json.loads(tokenizer_json), Tokenizer.from_str(tokenizer_json)
    if not cuts_at_blanks(settings):
        return WholeIds(tokenizer, width)
    return WordIds(tokenizer, width, [t["content"] for t in settings.get("added_tokens") or []])


def _memory(tokenizer_json: str, width: int) -> WordIds | WholeIds:
    """The memory of this worker process, which its later tasks go on with."""
    held = sys.modules.setdefault("gristmill_worker_memory", ModuleType("gristmill_worker_memory"))
    key = f"{width}-{hash(tokenizer_json)}"
    if key not in vars(held):
        setattr(held, key, encoder(tokenizer_json, width))
    return getattr(held, key)


class _Write:
    """mapInArrow over sorted (id, text): writes shards, returns their manifest rows."""

    names = ["shard", "first", "n_docs", "n_ids", "path"]

    def __init__(self, folder: str, tokenizer: str, end_id: int, width: int):
        self.folder, self.tokenizer, self.end_id, self.width = folder, tokenizer, end_id, width

    def _flush(self, place: int, number: int, rows: list) -> pa.RecordBatch:
        names, data = [r[0] for r in rows], [r[1] for r in rows]
        counts = [len(d) // self.width for d in data]
        system, folder = fs.FileSystem.from_uri(self.folder)
        path = f"{folder}/{place:06d}-{number:06d}-{uuid.uuid4().hex}.ids"
        with system.open_output_stream(path) as out:
            out.write(shard_bytes(names, counts, b"".join(data), self.width))
        values = [place * (1 << 32) + number, names[0], len(names), sum(counts), path.rpartition("/")[2]]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip(values, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()))],
            self.names)

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        words = _memory(self.tokenizer, self.width)
        end = self.end_id.to_bytes(self.width, "little")
        rows, held, number, place = [], 0, 0, TaskContext.get().partitionId()
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                for name, ids in zip(part.column(0).to_pylist(), words(texts)):
                    rows.append((name, ids + end))
                    held += len(ids) // self.width + 1
                    if held >= SHARD_IDS:
                        yield self._flush(place, number, rows)
                        rows, held, number = [], 0, number + 1
        if rows:
            yield self._flush(place, number, rows)


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme and host of its file system, by default the session's."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    full = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub(r"^file:/(?!//)", "file:///", full)


def write_token_files(
    docs: DataFrame, tokenizer_file: str, folder: str | None = None, end_id: int = 0,
    id_col: str = "doc_id", text_col: str = "text",
) -> str:
    """Encode every whole text, append ``end_id``, write shards in ascending id order.

    Returns the folder (a new one in the shared folder by default). A null text is empty,
    so it has the end id only. Rows without an id come first; rows with the same id stand
    in the order of a hash of their texts. An empty table gives an empty manifest. Other
    columns are not read. The tokenizer file is read on the driver and sent with the job.
    Texts have the ids that the library gives them, added tokens inside them included. A
    folder without a scheme is one of the session's default file system.
    """
    spark = docs.sparkSession
    folder = qualified(spark, folder or new_path(spark, "tokens"))
    with open(tokenizer_file, encoding="utf-8") as file:
        text = file.read()
    size = 1 + max(json.loads(text)["model"]["vocab"].values())
    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(f"{path}/shards", recursive=True)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    manifest = rows.mapInArrow(
        _Write(f"{folder}/shards", text, end_id, 2 if max(size, end_id + 1) <= 1 << 16 else 4),
        "shard long, first long, n_docs long, n_ids long, path string")
    manifest.write.parquet(f"{folder}/manifest")
    return folder


class _Read:
    """mapInArrow over manifest rows: one row per document of each shard."""

    def __init__(self, folder: str):
        self.folder = folder

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = fs.FileSystem.from_uri(self.folder)
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with system.open_input_stream(f"{folder}/{path}") as file:
                    shard = Shard.read(file.read())
                bounds = shard.bounds.all().astype(np.int64)
                wide = memoryview(shard.tokens.astype("<u4")).cast("B")
                sums = [zlib.crc32(wide[a * 4:b * 4]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.doc_ids, pa.int64()), pa.array(bounds[:-1] + start), pa.array(np.diff(bounds)),
                     pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the shards listed.

    Shards are put in order by one window over the manifest, which has one row per shard,
    and read by a task for about every ``READ_IDS`` ids.
    """
    manifest = spark.read.parquet(f"{folder}/manifest")
    shards, ids = manifest.agg(F.count("*"), F.coalesce(F.sum("n_ids"), F.lit(0))).first()
    tasks = max(1, min(shards, -(-ids // READ_IDS)))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    return placed.select("path", "start").repartition(tasks, "path").mapInArrow(
        _Read(f"{folder}/shards"), "doc_id long, start long, n_tokens long, ids_crc32 long")
