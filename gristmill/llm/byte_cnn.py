"""Language ID: a byte convolutional network in numpy.

Bytes are embedded, filters of several widths slide over a window, each filter keeps its
largest response, and a softmax layer reads those. It is trained on windows of a bounded
sample of labelled documents. Whole texts are read in windows of fixed length, many at a
time; the windows' logits are averaged by length.

At scoring time the embedding and a filter are one table lookup per two bytes: the
response of a filter is a sum over the pairs of bytes it covers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.blocks import hash_below, pieces, utf8

#: Bytes in a window; labelled documents in the sample, about; windows taken of each.
WINDOW, SAMPLE, WINDOWS_OF_DOC = 256, 3000, 3
WIDTHS, FILTERS, EMBEDDED = (2, 3, 4), 16, 8
EPOCHS, BATCH, STEP = 6, 64, 0.01
#: Language of a text without letters.
UNDETERMINED = "und"

_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts (the last of a text is padded with 0), their rows and lengths."""
    sizes = np.diff(offsets)
    count = -(-sizes // WINDOW)
    row = np.repeat(np.arange(len(sizes)), count)
    place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[:-1][row] + place * WINDOW
    length = np.minimum(WINDOW, offsets[1:][row] - start)
    padded = np.append(data, np.zeros(WINDOW, np.uint8))
    held = padded[start[:, None] + np.arange(WINDOW)] if len(row) else np.zeros((0, WINDOW), np.uint8)
    short = np.flatnonzero(length < WINDOW)
    held[short] *= (np.arange(WINDOW) < length[short, None]).astype(np.uint8)
    return held, row, length


@dataclass
class ByteCnn:
    """Weights, and the languages in code-point order."""

    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    bias: np.ndarray
    top: np.ndarray
    top_bias: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str]) -> ByteCnn:
        rng = np.random.default_rng(9)
        draw = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
        width = len(WIDTHS) * FILTERS
        return cls(
            languages, draw(256, EMBEDDED), [draw(w, EMBEDDED, FILTERS) for w in WIDTHS],
            np.zeros(width, np.float32), draw(width, len(languages)), np.zeros(len(languages), np.float32))

    def _weights(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, self.bias, self.top, self.top_bias]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean cross entropy of windows ``x``; only the winning places carry any."""
        n = len(x)
        embedded = self.embedding[x]
        pooled, places = [], []
        for w, f in zip(WIDTHS, self.filters):
            response = sum(embedded[:, k:WINDOW - w + 1 + k] @ f[k] for k in range(w))
            places.append(response.argmax(axis=1))
            pooled.append(np.take_along_axis(response, places[-1][:, None], 1)[:, 0])
        before = np.concatenate(pooled, axis=1) + self.bias
        hidden = np.maximum(before, 0)
        logits = hidden @ self.top + self.top_bias
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(n), y] -= 1
        p /= n
        back = (p @ self.top.T) * (before > 0)
        to_embedding = np.zeros_like(self.embedding)
        to_filters = []
        for i, (w, f) in enumerate(zip(WIDTHS, self.filters)):
            part = back[:, i * FILTERS:(i + 1) * FILTERS]
            to_filter = np.empty_like(f)
            for k in range(w):
                byte = np.take_along_axis(x, places[i] + k, axis=1)
                to_filter[k] = np.einsum("nfe,nf->ef", self.embedding[byte], part)
                np.add.at(to_embedding, byte, part[:, :, None] * f[k].T)
            to_filters.append(to_filter)
        return [to_embedding, *to_filters, back.sum(axis=0), hidden.T @ p, p.sum(axis=0)]

    def fit(self, x: np.ndarray, y: np.ndarray) -> ByteCnn:
        """Adam over shuffled batches, seeded."""
        rng = np.random.default_rng(99)
        weights = self._weights()
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for k in range(0, len(x), BATCH):
                step += 1
                for w, g, a, b in zip(weights, self.gradients(x[order[k:k + BATCH]], y[order[k:k + BATCH]]), first, second):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    w -= STEP * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
        return self

    def tables(self) -> list[list[tuple[int, np.ndarray]]]:
        """Per width: ``(place, table)`` whose rows, looked up by one or two bytes, add up to the response."""
        out = []
        for w, f in zip(WIDTHS, self.filters):
            parts = []
            for k in range(0, w - 1, 2):
                pair = (self.embedding @ f[k])[:, None] + (self.embedding @ f[k + 1])[None]
                parts.append((k, pair.reshape(1 << 16, FILTERS)))
            if w % 2:
                parts.append((w - 1, self.embedding @ f[w - 1]))
            out.append(parts)
        return out

    def logits(self, x: np.ndarray, tables: list) -> np.ndarray:
        out = np.empty((len(x), len(self.languages)), np.float32)
        for k in range(0, len(x), 128):
            some = x[k:k + 128]
            pairs = some[:, :-1].astype(np.int32) * 256 + some[:, 1:]
            pooled = []
            for w, parts in zip(WIDTHS, tables):
                n = WINDOW - w + 1
                response = None
                for at, table in parts:
                    index = (pairs if len(table) > 256 else some)[:, at:at + n]
                    one = table[index]
                    response = one if response is None else np.add(response, one, out=response)
                pooled.append(response.max(axis=1))
            hidden = np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0)
            out[k:k + 128] = hidden @ self.top + self.top_bias
        return out


class _Sample:
    """mapInArrow over (language, text): some windows of each text, evenly spread over it."""

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 1):
                held, row, _ = windows(*utf8(part.column(1)))
                first = np.searchsorted(row, np.arange(part.num_rows + 1))
                chosen = np.unique(np.concatenate([
                    np.linspace(a, b - 1, WINDOWS_OF_DOC).astype(int) for a, b in zip(first[:-1], first[1:]) if b > a
                ] or [np.zeros(0, int)]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row[chosen])), pa.array([w.tobytes() for w in held[chosen]], pa.binary())],
                    ["lang", "window"])


class _Predict:
    """mapInArrow over (id, text): id, language, score."""

    def __init__(self, model: ByteCnn):
        self.model = model

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = self.model.tables()
        for batch in batches:
            for part in pieces(batch, 1, 1 << 20):
                data, offsets = utf8(part.column(1))
                held, row, length = windows(data, offsets)
                n = part.num_rows
                sums = np.zeros((n, len(self.model.languages)))
                np.add.at(sums, row, self.model.logits(held, tables) * length[:, None])
                sums /= np.maximum(np.diff(offsets), 1)[:, None]
                p = np.exp(sums - sums.max(axis=1, initial=-np.inf, keepdims=True)) if sums.shape[1] else sums
                best = p.argmax(axis=1) if sums.shape[1] else np.zeros(n, int)
                score = p[np.arange(n), best] / p.sum(axis=1) if sums.shape[1] else np.zeros(n)
                known = np.add.reduceat(np.append(_ASCII_LETTER[data], False), offsets[:-1]) > 0
                known &= np.diff(offsets) > 0
                for k in np.flatnonzero(~known & (np.diff(offsets) > 0)):
                    known[k] = any(c.isalpha() for c in part.column(1)[int(k)].as_py())
                if not sums.shape[1]:
                    known[:] = False
                names = [self.model.languages[b] if ok else UNDETERMINED for b, ok in zip(best.tolist(), known)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(np.where(known, score, 0.0))],
                    ["doc_id", "lang_pred", "score"])


def train_language_id(
    docs: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    sample: int = SAMPLE,
) -> ByteCnn:
    """A network trained on about ``sample`` documents at most, of those that are ``usable``.

    Documents are chosen by a hash of the id; null languages and texts are left out. What
    reaches the driver is at most ``WINDOWS_OF_DOC`` windows of each. Without any, the
    network knows no language.
    """
    rows = docs.filter(usable & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull())
    rows = rows.filter(hash_below(sample / max(1, rows.count()), F.col(id_col).cast("long"), F.lit(9)))
    found = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).mapInArrow(
        _Sample(), "lang string, window binary").toPandas().sort_values(["lang", "window"])
    languages = sorted(found["lang"].unique())
    model = ByteCnn.fresh(languages)
    if not len(found):
        return model
    x = np.frombuffer(b"".join(found["window"]), np.uint8).reshape(-1, WINDOW)
    return model.fit(x, np.searchsorted(languages, found["lang"].to_numpy(str)))


def predict_language(docs: DataFrame, model: ByteCnn, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` for every row, from all bytes of its text, without a shuffle.

    Texts that are null or have no letter are ``und`` with score 0, as is every text when
    the network knows no language. Repeated rows get the same result; an empty table gives
    an empty result; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_Predict(model), "doc_id long, lang_pred string, score double")
