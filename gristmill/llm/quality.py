"""Quality classifier: gradient-boosted trees on histograms of document statistics.

Statistics come from one pass over the bytes of a block of texts. Trees are grown in numpy
on a bounded sample of labelled documents, and flattened into arrays that all documents of
a batch walk through at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.blocks import RangeHash, hash_below, pieces, utf8
from gristmill.llm.shingles import shingle_sets, word_spans
from gristmill.staging import stage

#: Labelled documents that the trees are fitted on, about; chosen by a hash of the id.
SAMPLE = 40_000
BINS, DEPTH, TREES, RATE, PENALTY = 64, 4, 60, 0.2, 1.0

# Byte classes. Marks that are rare in prose have classes of their own.
_CLASSES = {
    "lower": range(97, 123), "upper": range(65, 91), "digit": range(48, 58),
    "blank": [0x20, *range(9, 14)], "full_stop": b".", "comma": b",", "exclaim": b"!", "bar": b"|",
    "symbol": b"$#%&*", "markup": b"<>{}[]\\/=_~^", "quote": b"\"'()`", "other_mark": b"?:;-+@",
    "wide": range(128, 256), "control": [*range(9), *range(14, 32), 127],
}
_CLASS = np.zeros(256, np.int64)
for _k, _members in enumerate(_CLASSES.values()):
    _CLASS[list(_members)] = _k
FEATURES = [
    "log_bytes", "log_words", *(f"share_{name}" for name in _CLASSES), "upper_of_letters",
    "mean_word", "long_words", "short_words", "distinct_words", "distinct_triples",
    "log_lines", "repeated_lines", "bytes_per_line", "marks_per_word",
]


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``FEATURES`` per text, float32; an empty text has zeros."""
    rows = len(offsets) - 1
    size = np.diff(offsets)
    row = np.repeat(np.arange(rows), size)
    counts = np.bincount(row * 16 + _CLASS[data], minlength=rows * 16).reshape(rows, 16)[:, :len(_CLASSES)]
    share = counts / np.maximum(size, 1)[:, None]
    names = list(_CLASSES)
    of = lambda name: counts[:, names.index(name)]
    starts, ends = word_spans(data, offsets)
    length = ends - starts
    owner = np.searchsorted(offsets, starts, "right") - 1
    words = np.bincount(owner, minlength=rows)
    some = np.maximum(words, 1)
    per_word = lambda w: np.bincount(owner, w, rows) / some
    distinct = [np.diff(shingle_sets(data, offsets, k)[1]) for k in (1, 3)]
    breaks = np.flatnonzero(data == 10)
    line_starts = np.sort(np.concatenate([offsets[:-1][size > 0], breaks[breaks + 1 < len(data)] + 1]))
    line_starts = np.unique(line_starts)
    line_ends = np.r_[line_starts[1:], len(data)][:len(line_starts)]
    line_owner = np.searchsorted(offsets, line_starts, "right") - 1
    hashes = RangeHash(data).of(line_starts, np.maximum(line_ends, line_starts))
    order = np.lexsort((hashes, line_owner))
    again = np.zeros(len(order), bool)
    again[1:] = (hashes[order][1:] == hashes[order][:-1]) & (line_owner[order][1:] == line_owner[order][:-1])
    lines = np.bincount(line_owner, minlength=rows)
    repeated = np.bincount(line_owner[order], again, rows) / np.maximum(lines, 1)
    marks = sum(of(n) for n in ("exclaim", "bar", "symbol", "markup", "quote", "other_mark"))
    columns = [
        np.log1p(size), np.log1p(words), *share.T, of("upper") / np.maximum(of("upper") + of("lower"), 1),
        per_word(length), per_word(length > 14), per_word(length < 4), distinct[0] / some,
        distinct[1] / np.maximum(words - 2, 1) * (words > 0), np.log1p(lines), repeated,
        size / np.maximum(lines, 1), marks / some,
    ]
    return np.column_stack(columns).astype(np.float32)


@dataclass
class Trees:
    """All trees in flat arrays; node ``i`` goes to ``left[i]`` or the node after it.

    A leaf points to itself, so a walk of ``depth`` steps ends in a leaf for every row.
    """

    edges: np.ndarray
    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                go = x[rows, self.feature[node]] <= self.cut[node]
                node = np.where(go, self.left[node], self.right[node])
            out += self.value[node]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Newton boosting of the logistic loss on ``BINS`` quantile bins of each column.

    With no rows, or one class only, the model is a constant.
    """
    n, width = x.shape
    rate = (y.sum() + 1) / (n + 2)
    base = float(np.log(rate / (1 - rate)))
    nodes: list[list] = []
    roots: list[int] = []
    if n == 0 or y.min() == y.max():
        trees = 0
    grid = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = np.quantile(x, grid, axis=0).T.astype(np.float32) if n else np.zeros((width, BINS - 1), np.float32)
    binned = np.stack([np.searchsorted(edges[f], x[:, f]) for f in range(width)]) if n else None
    raw = np.full(n, base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        gradient, curvature = p - y, p * (1 - p)
        roots.append(len(nodes))
        nodes.append([0, 0.0, len(nodes), len(nodes), 0.0])
        place, open_ = np.full(n, roots[-1]), [roots[-1]]
        for level in range(depth + 1):
            following = []
            for node in open_:
                rows = np.flatnonzero(place == node)
                g, h = gradient[rows].sum(), curvature[rows].sum()
                nodes[node][4] = float(-RATE * g / (h + PENALTY))
                if level == depth or len(rows) < 20:
                    continue
                best = (1e-6, 0, 0)
                for f in range(width):
                    bins = binned[f, rows]
                    gl = np.cumsum(np.bincount(bins, gradient[rows], BINS))[:-1]
                    hl = np.cumsum(np.bincount(bins, curvature[rows], BINS))[:-1]
                    gain = gl**2 / (hl + PENALTY) + (g - gl)**2 / (h - hl + PENALTY) - g**2 / (h + PENALTY)
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (gain[k], f, k)
                if best[0] <= 1e-6:
                    continue
                _, f, k = best
                left = len(nodes)
                nodes[node][:4] = [f, float(edges[f][k]), left, left + 1]
                nodes += [[0, 0.0, left, left, 0.0], [0, 0.0, left + 1, left + 1, 0.0]]
                place[rows] = np.where(binned[f, rows] <= k, left, left + 1)
                following += [left, left + 1]
            open_ = following
        raw += np.array([node[4] for node in nodes])[place]
    table = np.array(nodes or [[0, 0.0, 0, 0, 0.0]], float)
    return Trees(
        edges, np.array(roots, int), table[:, 0].astype(int), table[:, 1].astype(np.float32),
        table[:, 2].astype(int), table[:, 3].astype(int), table[:, 4], base, depth)


class _Statistics:
    """mapInArrow over (label, text): label and packed statistics."""

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 1):
                values = statistics(*utf8(part.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([v.tobytes() for v in values], pa.binary())], ["label", "values"])


class _Score:
    """mapInArrow over rows: ``score`` after the other columns, or rows at or above ``least``."""

    def __init__(self, model: Trees, text: int, least: float | None):
        self.model, self.text, self.least = model, text, least

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, self.text):
                score = self.model.score(statistics(*utf8(part.column(self.text))))
                if self.least is None:
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score)], ["doc_id", "score"])
                else:
                    yield part.filter(pa.array(score >= self.least))


def train_quality(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
    text_col: str = "text", sample: int = SAMPLE,
) -> Trees:
    """Trees fitted on about ``sample`` labelled documents at most.

    The sample is the labelled ids whose hash is below the share that gives that size;
    null labels and ids without a document are left out, and of several labels of one id
    the smallest counts. The ids of the sample are broadcast, and only their statistics
    (some 100 bytes each) reach the driver.
    """
    known = stage(labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).cast("long").alias("_id")).agg(F.min(F.col(label_col).cast("int")).alias("_label")), "labels")
    chosen = known.filter(hash_below(sample / max(1, known.count()), F.col("_id")))
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).join(
        F.broadcast(chosen), "_id").select("_label", "_text")
    found = texts.mapInArrow(_Statistics(), "label int, values binary").toPandas()
    x = np.frombuffer(b"".join(found["values"]), np.float32).reshape(-1, len(FEATURES))
    y = found["label"].to_numpy(float)
    order = np.lexsort((*x.T, y))
    return fit_trees(x[order], y[order])


def score_quality(docs: DataFrame, model: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` for every row, in one pass without a shuffle.

    A null or empty text has zeros for statistics and is scored like any other. Repeated
    rows get the same score; an empty table gives an empty result; other columns are not
    read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    scored = rows.mapInArrow(_Score(model, 1, None), "doc_id long, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_quality(docs: DataFrame, model: Trees, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of at least ``least``, all columns as they were."""
    return docs.mapInArrow(_Score(model, docs.columns.index(text_col), least), docs.schema)
