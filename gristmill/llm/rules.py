"""Quality rules: an isolation forest on rule statistics of documents.

Two rules are fixed: too few words, or too many repeated ones. What passes them is judged
by an isolation forest. Its trees split a random statistic at a random place, of a range
that is wider than that of the rows at the node; rows unlike those the trees were grown on
are alone after few splits, so short paths mark anomalous documents. The forest is grown
on rows that are labelled good (on any rows, without labels), and the path length that
rejects is calibrated on labelled rows of both kinds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.blocks import RangeHash, join_ids, mix, pieces, utf8
from gristmill.llm.terms import WORD, stretches
from gristmill.staging import stage

#: Documents fewer words fail the base rules, as do those with a larger percentage of repeated words.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Labelled rows at most that the forest and its threshold are fitted on; the first by a hash of the id.
SAMPLE = 20_000
TREES, TREE_ROWS = 200, 256
#: A split lies in the range of the rows at the node, widened by this much on both sides; statistics lie in 0 to 1.
MARGIN = 0.5
#: Share of the rows labelled good that the threshold may reject.
LOSS = 0.002
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = [
    "word_length", "symbol_words", "marked_words", "capital_words", "bare_words", "repeated_words", "dup_lines",
]


def _bytes(values) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


_SYMBOL = _bytes(b"#*$%&|<>")
_MARK = _bytes(b"!\"()+/=?@[\\]^_`{}~")
_UPPER, _SMALL, _DIGIT = _bytes(range(65, 91)), _bytes(range(97, 123)), _bytes(range(48, 58))
_SOLID = _UPPER | _SMALL | _DIGIT | _bytes(range(0xC2, 0xF5))
_FIRST = ~_bytes(range(0x80, 0xC0))


def _repeated(hashes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Words of each row that stand in a window of three that the row holds twice or more."""
    out = np.zeros(n, np.int64)
    if len(hashes) < 4:
        return out
    odd = mix(np.arange(1, 4, dtype=np.uint64)) | np.uint64(1)
    windows = mix(hashes[:-2] * odd[0] + hashes[1:-1] * odd[1] + hashes[2:] * odd[2])
    at = np.flatnonzero(rows[:-2] == rows[2:])
    at = at[np.argsort(windows[at], kind="stable")]
    same = (windows[at[1:]] == windows[at[:-1]]) & (rows[at[1:]] == rows[at[:-1]])
    twice = np.zeros(len(at), bool)
    twice[1:] |= same
    twice[:-1] |= same
    covered = np.zeros(len(hashes), bool)
    for k in range(3):
        covered[at[twice] + k] = True
    return out + np.bincount(rows[covered], minlength=n)


def _duplicate_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier one."""
    solid = [line for line in text.split(b"\n") if line.strip()]
    return len(solid), len(solid) - len(set(solid))


def statistics(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``BASE`` (integers) and ``FEATURES`` (float32) of every text.

    Features are shares of the words: with a symbol, with another mark inside or at the
    end, in capitals, without letter or digit, in repeated windows; and of the lines.
    """
    n = len(offsets) - 1
    words, symbols, points, symbol_words, marked, capital, bare = np.zeros((7, n), np.int64)
    hashes, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for begin, end, starts, ends, rows in stretches(data, offsets, WORD):
        part = data[begin:end]
        sums = np.zeros(len(part) + 1, np.int64)

        def in_words(kind):
            np.cumsum(kind[part], out=sums[1:])
            return sums[ends - begin] - sums[starts - begin]

        def add(total, some):
            total += np.bincount(rows, some, minlength=n).astype(np.int64)

        has = in_words(_SYMBOL)
        add(symbols, has)
        add(symbol_words, has > 0)
        add(points, in_words(_FIRST))
        add(marked, in_words(_MARK) > 0)
        add(bare, in_words(_SOLID) == 0)
        add(capital, (in_words(_UPPER) > 1) & (in_words(_SMALL) == 0))
        words += np.bincount(rows, minlength=n)
        hashes.append(RangeHash(part).of(starts - begin, ends - begin))
        owners.append(rows)
    repeated = _repeated(np.concatenate(hashes), np.concatenate(owners), n)
    lines = np.array([
        _duplicate_lines(data[a:b].tobytes()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]).reshape(n, 2)
    base = np.stack([words, points, symbols, lines[:, 1], repeated], axis=1)
    some = words + 10.0
    features = np.stack([
        np.minimum(1, np.log2(1 + points / np.maximum(words, 1)) / 8), symbol_words / some, marked / some, capital / some, bare / some, repeated / some,
        lines[:, 1] / (lines[:, 0] + 10.0)], axis=1)
    return base, features.astype(np.float32)


def base_failed(base: np.ndarray) -> np.ndarray:
    words, repeated = base[:, 0], base[:, 4]
    return (words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * words)


def expected_path(n: int) -> float:
    """Mean path length of an unsuccessful search in a binary tree of ``n`` rows."""
    if n < 2:
        return 0.0
    return 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n if n > 2 else 1.0


@dataclass
class Forest:
    """Trees in flat arrays; a leaf is its own child and holds the length of its path."""

    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    length: np.ndarray
    depth: int
    usual: float
    least: float = 0.0

    def paths(self, x: np.ndarray) -> np.ndarray:
        """Mean path length of every row, in units of what is usual."""
        out, rows = np.zeros(len(x)), np.arange(len(x))
        for root in self.roots.tolist():
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.cut[node], self.left[node], self.right[node])
            out += self.length[node]
        return out / max(1, len(self.roots)) / max(self.usual, 1e-9)

    def keeps(self, x: np.ndarray) -> np.ndarray:
        return self.paths(x) >= self.least


def grow(x: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 7) -> Forest:
    """An isolation forest; each tree is grown on ``tree_rows`` random rows. No rows, no trees."""
    rng = np.random.default_rng(seed)
    size = min(tree_rows, len(x))
    depth = int(np.ceil(np.log2(max(2, size)))) + 2
    nodes: list[list[float]] = []

    def add(rows: np.ndarray, level: int) -> int:
        me = len(nodes)
        nodes.append([0, 0.0, me, me, level + expected_path(len(rows))])
        if level < depth and len(rows) > 1:
            low, high = x[rows].min(axis=0), x[rows].max(axis=0)
            f = int(rng.integers(x.shape[1]))
            cut = np.float32(rng.uniform(max(0.0, low[f] - MARGIN), min(1.0, high[f] + MARGIN)))
            goes = x[rows, f] <= cut
            left, right = add(rows[goes], level + 1), add(rows[~goes], level + 1)
            nodes[me][:4] = [f, float(cut), left, right]
        return me

    roots = [add(rng.choice(len(x), size, replace=False), 0) for _ in range(trees if len(x) else 0)]
    table = np.array(nodes or [[0, 0.0, 0, 0, 0.0]], float)
    return Forest(
        np.array(roots, int), table[:, 0].astype(int), table[:, 1].astype(np.float32), table[:, 2].astype(int),
        table[:, 3].astype(int), table[:, 4], depth, expected_path(size))


def calibrate(paths: np.ndarray, good: np.ndarray, loss: float = LOSS) -> float:
    """The path length below which a row is rejected.

    Of the thresholds that reject at most a share ``loss`` of the good rows, the one at
    which good rows kept and bad rows rejected are most, in shares of each; between two
    rows it lies in the middle. Without rows of both kinds nothing is rejected.
    """
    if good.all() or not good.any():
        return 0.0
    order = np.argsort(paths, kind="stable")
    values, good = paths[order], good[order]
    lost, caught = np.cumsum(good) / good.sum(), np.cumsum(~good) / (~good).sum()
    ends = np.append(values[1:] > values[:-1], True)
    gain = np.where(ends & (lost <= loss), caught - lost, -1.0)
    best = int(gain.argmax())
    if gain[best] <= 0:
        return 0.0
    return float((values[best] + values[best + 1]) / 2) if best + 1 < len(values) else float(np.nextafter(values[best], np.inf))


class _Sample:
    """mapInArrow over (label, text): label and packed features of what passes the base rules."""

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 1):
                base, features = statistics(*utf8(part.column(1)))
                passed = np.flatnonzero(~base_failed(base))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(passed)), pa.array([features[k].tobytes() for k in passed], pa.binary())],
                    ["label", "values"])


class _Judge:
    """mapInArrow over (id, text): base statistics, both verdicts and the path length."""

    def __init__(self, forest: Forest):
        self.forest = forest

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", *BASE, "base_failed", "kept", "path"]
        for batch in batches:
            for part in pieces(batch, 1):
                base, features = statistics(*utf8(part.column(1)))
                failed = base_failed(base)
                path = self.forest.paths(features)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *map(pa.array, base.T.copy()), pa.array(failed), pa.array(~failed & (path >= self.forest.least)),
                     pa.array(path)], names)


def train_rules(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
    sample: int = SAMPLE,
) -> Forest:
    """A forest and its threshold from at most ``sample`` labelled documents.

    They are the first labelled ids by a hash, at every size of the table; null labels
    are left out, and of several labels of one id the smallest counts. Forest and
    threshold are fitted on different halves of the sample. The ids of the sample are
    broadcast; some 40 bytes of each document reach the driver.
    """
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).cast("long").alias("_id")).agg(F.min(F.col(label_col).cast("int")).alias("_label"))
    chosen = stage(known.orderBy(F.xxhash64("_id"), "_id").limit(sample), "labelled")
    texts = join_ids(docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")), chosen, "_id")
    found = texts.select("_label", "_text").mapInArrow(_Sample(), "label int, values binary").toPandas()
    x = np.frombuffer(b"".join(found["values"]), np.float32).reshape(-1, len(FEATURES))
    good = found["label"].to_numpy(int) > 0
    order = np.lexsort((*x.T, good))
    x, good = x[order], good[order]
    half = np.arange(len(x)) % 2 == 0
    forest = grow(x[half & good] if (half & good).any() else x[half])
    forest.least = calibrate(forest.paths(x[~half]), good[~half])
    return forest


def apply_rules(docs: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``BASE``, ``base_failed``, ``kept`` and ``path`` for every row, without a shuffle.

    Words are runs of characters other than blank and U+0009 to U+000D; lines that equal
    an earlier one and windows of three words are compared within a text. Null and empty
    texts have zeros and fail the base rules. Repeated rows get equal results, an empty
    table an empty one; other columns are not read. Statistics of bytes are taken in
    stretches; 8 bytes a word are held of a whole text.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    numbers = ", ".join(f"{name} long" for name in BASE)
    return rows.mapInArrow(_Judge(forest), f"doc_id long, {numbers}, base_failed boolean, kept boolean, path double")


def base_sql(docs: str = "documents") -> str:
    """DuckDB SQL of the base statistics and ``base_failed``; a forest cannot be written as SQL."""
    return rf"""WITH held AS (SELECT row_number() OVER () AS no, doc_id, coalesce(text, '') AS text FROM {docs}),
words AS MATERIALIZED (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') w FROM held),
windows AS (SELECT no, unnest(range(1, len(w) - 1)) i, w FROM words WHERE len(w) > 2),
twice AS (SELECT no, unnest(list(i)) i FROM (SELECT no, i, [w[i], w[i + 1], w[i + 2]] x FROM windows) GROUP BY no, x HAVING count(*) > 1),
repeated AS (SELECT no, count(DISTINCT i + k) n FROM twice, range(3) r(k) GROUP BY no),
lines AS (SELECT no, x, count(*) n FROM (SELECT no, unnest(string_split(text, chr(10))) x FROM held)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY no, x),
dup AS (SELECT no, sum(n - 1) n FROM lines GROUP BY no)
SELECT doc_id, len(w)::BIGINT n_words, length(array_to_string(w, ''))::BIGINT word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT n_symbols, coalesce(d.n, 0)::BIGINT n_dup_lines,
  coalesce(r.n, 0)::BIGINT n_repeat_words, len(w) < {LEAST_WORDS} OR 100 * coalesce(r.n, 0) > {MOST_REPEATED} * len(w) base_failed
FROM words LEFT JOIN dup d USING (no) LEFT JOIN repeated r USING (no)"""
