"""Words of scripts without blanks, learned from the corpus.

A string of Han characters is a word when its parts stand together more often than by
chance (cohesion: the least mutual information of its two-part splits) and when what
stands before and after it varies (the smaller entropy of its neighbours; the end of a run
of characters is a neighbour, too). Runs are cut into words by the most probable path.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.functions.batches import joined, parts
from gristmill.functions.tries import Trie, points_of
from gristmill.staging import spread, stage

LONGEST = 4
MIN_COUNT = 5
MIN_COHESION = 4.0
MIN_ENTROPY = 1.0
# Words that a segmenter uses, the most frequent ones; their dictionary is sent to every worker.
MAX_WORDS = 200_000
# Marks of the beginning and the end of a run.
BEGIN, END = "\u0002", "\u0003"
# Characters whose strings a task counts together, about, and bytes whose words it makes together.
COUNTED, CUT = 1 << 22, 1 << 20
# So many of the longest runs of a part are cut one by one.
FEW = 16
# Distinct strings of a table that a task makes Python objects of at a time.
NAMED = 1 << 16


def han_runs(text: Column | str) -> Column:
    """Runs of Han characters."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"\p{IsHan}+"), F.lit(0))


def _numbered(keys: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """The number of each key, which are below ``bound``, among the distinct ones, and how often each of those is there."""
    if bound <= max(1 << 21, 4 * len(keys)):
        times = np.bincount(keys, minlength=bound)
        held = times > 0
        return (np.cumsum(held, dtype=np.int32) - np.int32(1))[keys], times[held]
    _, number, times = np.unique(keys, return_inverse=True, return_counts=True)
    return number.astype(np.int32), times


def _strings(points: np.ndarray, size: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Distinct strings of up to ``size`` characters within the runs, and how often they are there.

    A string is numbered by the number of all but its last character and the number of that
    one, so numbers stay small whatever the size. Strings that reach into the next run are
    numbered, too, and left out at the end.
    """
    letter, times = _numbered(points, int(points.max()) + 1)
    letters, ids = len(times), letter
    for k in range(1, size + 1):
        if k > 1:
            if len(points) < k:
                return
            ids, times = _numbered(ids[:-1].astype(np.int64) * letters + letter[k - 1:], len(times) * letters)
        place = np.empty(len(times), np.int64)
        place[ids] = np.arange(len(ids))
        for low in range(0, len(place), NAMED):
            found = points[place[low:low + NAMED, None] + np.arange(k)]
            inside = ~(found[:, :-1] == ord(END)).any(axis=1)
            names = np.ascontiguousarray(found[inside]).view(f"<U{k}")[:, 0]
            yield pa.array(names.tolist(), pa.string()), times[low:low + NAMED][inside]


class _Counts:
    """mapInArrow over texts of marked runs: (gram, n) of the strings of up to ``size`` characters."""

    def __init__(self, size: int):
        self.size = size

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for part in parts(batch.column(0)):
                held.append(points_of("".join(part.to_pylist())))
                n += len(held[-1])
                if n >= COUNTED:
                    yield from self._counted(held)
                    held, n = [], 0
        if n:
            yield from self._counted(held)

    def _counted(self, held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for grams, times in _strings(np.concatenate(held), self.size):
            yield pa.RecordBatch.from_arrays([grams, pa.array(times, pa.int64())], ["gram", "n"])


def gram_counts(df: DataFrame, longest: int = LONGEST, text_col: str = "text") -> DataFrame:
    """``(gram, n)`` of the strings of up to ``longest`` characters and one neighbour.

    Texts are not shuffled: a task counts the strings of a few million characters as
    integers and sends each distinct one once.
    """
    runs = F.trim(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), r"\P{IsHan}+", " "))
    marked = F.concat(F.lit(BEGIN), F.replace(F.col("_runs"), F.lit(" "), F.lit(END + BEGIN)), F.lit(END))
    texts = spread(df.select(text_col)).select(runs.alias("_runs")).filter("_runs <> ''").select(marked.alias("_runs"))
    return texts.mapInArrow(_Counts(longest + 1), "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _entropy(counts: DataFrame, inner: Column, name: str) -> DataFrame:
    n = F.col("n").cast("double")
    rows = counts.filter(F.length("gram") > 2).select(inner.alias("gram"), n.alias("n"))
    total = F.sum("n")
    return rows.groupBy("gram").agg((F.log(total) - F.sum(F.col("n") * F.log("n")) / total).alias(name))


def learn_words(
    df: DataFrame,
    longest: int = LONGEST,
    min_count: int = MIN_COUNT,
    min_cohesion: float = MIN_COHESION,
    min_entropy: float = MIN_ENTROPY,
    text_col: str = "text",
) -> DataFrame:
    """``(word, n, cohesion, entropy)`` of the words of 2 to ``longest`` Han characters.

    Cohesion is in bits, entropy in nats. Counts, neighbours and splits are aggregates and
    joins of distinct strings.
    """
    counts = stage(gram_counts(df, longest, text_col), "grams")
    plain = ~F.col("gram").contains(BEGIN) & ~F.col("gram").contains(END)
    total = counts.filter(plain & (F.length("gram") == 1)).agg(F.sum("n")).first()[0] or 1
    words = counts.filter(plain & F.length("gram").between(2, longest) & (F.col("n") >= min_count))
    right = _entropy(counts, F.col("gram").substr(F.lit(1), F.length("gram") - 1), "right")
    left = _entropy(counts, F.col("gram").substr(F.lit(2), F.length("gram") - 1), "left")
    entropy = F.least("left", "right")
    words = words.join(right, "gram").join(left, "gram").withColumn("entropy", entropy).filter(entropy >= min_entropy)
    words = stage(words.select("gram", "n", "entropy"), "candidates")
    split = words.select("gram", "n", F.explode(F.sequence(F.lit(1), F.length("gram") - 1)).alias("k")).select(
        "gram", "n", F.col("gram").substr(F.lit(1), F.col("k")).alias("first"),
        F.col("gram").substr(F.col("k") + 1, F.length("gram")).alias("second"))
    parts = counts.filter(plain)
    paired = split.join(parts.select(F.col("gram").alias("first"), F.col("n").alias("a")), "first").join(
        parts.select(F.col("gram").alias("second"), F.col("n").alias("b")), "second")
    bits = F.log2(F.col("n").cast("double") * total / F.col("a") / F.col("b"))
    cohesion = paired.groupBy("gram").agg(F.min(bits).alias("cohesion")).filter(F.col("cohesion") >= min_cohesion)
    return words.join(cohesion, "gram").select(F.col("gram").alias("word"), "n", "cohesion", "entropy")


class _Lexicon:
    """Words and their costs, and the most probable way to cut runs into them."""

    def __init__(self, costs: dict[str, float], unknown: float):
        self.unknown, self.longest = unknown, max(map(len, costs), default=1)
        self.words, self.values = Trie(list(costs)), np.array(list(costs.values()), float)

    def _costs(self, points: np.ndarray) -> list[np.ndarray]:
        """Per size, the cost of the word of that size from each place on."""
        out = [np.full(len(points), math.inf) for _ in range(self.longest)]
        out[0][:] = self.unknown
        for size, place, word in self.words.walk(points):
            out[size - 1][place] = self.values[word]
        return out

    def _steps(self, costs: list[list[float]]) -> list[int]:
        """For one run: the size of the last word of the best way up to each character."""
        best, out = [0.0], []
        for end, cost in enumerate(costs[0], 1):
            cost, size = best[end - 1] + cost, 1
            for k in range(2, min(len(costs), end) + 1):
                other = best[end - k] + costs[k - 1][end - k]
                if other < cost:
                    cost, size = other, k
            best.append(cost)
            out.append(size)
        return out

    def cut(self, runs: list[str]) -> list[list[str]]:
        """The words of each run; the shortest last word is taken where costs are equal."""
        text = "".join(runs)
        costs = self._costs(points_of(text))
        length = np.array([len(r) for r in runs], np.int64)
        start = np.cumsum(length) - length
        order = np.argsort(-length, kind="stable")
        step = np.ones(len(text), np.int64)
        for k in order[:FEW].tolist():
            here = slice(int(start[k]), int(start[k] + length[k]))
            step[here] = self._steps([c[here].tolist() for c in costs])
        # The others step by step together; the least costs of the last steps are kept.
        first, sizes = start[order[FEW:]], length[order[FEW:]]
        sums = [np.zeros(len(sizes))]
        for at in range(1, int(sizes[0]) + 1 if len(sizes) else 1):
            many = int(np.searchsorted(-sizes, -at, "right"))
            place = first[:many] + at - 1
            cost, size = sums[-1][:many] + costs[0][place], np.ones(many, np.int64)
            for k in range(2, min(len(costs), at) + 1):
                other = sums[-k][:many] + costs[k - 1][place - k + 1]
                less = other < cost
                cost[less], size[less] = other[less], k
            step[place] = size
            sums = [*sums[-len(costs):], cost]
        back, out = step.tolist(), []
        for begin, size, run in zip(start.tolist(), length.tolist(), runs):
            found, end = [], size
            while end:
                found.append(run[end - back[begin + end - 1]:end])
                end -= back[begin + end - 1]
            out.append(found[::-1])
        return out


def segmenter(words: DataFrame, max_words: int = MAX_WORDS):
    """A function of an array of runs that gives their words, by the most probable path.

    The ``max_words`` most frequent words are used, ties to the smaller one. A character
    that is in no word is one itself.
    """
    held = words.select("word", "n").orderBy(F.desc("n"), "word").limit(max_words).collect()
    total = sum(r["n"] for r in held) + 1
    lexicon = _Lexicon({r["word"]: math.log(total / r["n"]) for r in held}, math.log(2 * total))
    shared = words.sparkSession.sparkContext.broadcast(lexicon)

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def cut(runs: pa.Array) -> pa.Array:
        return _cut_in_parts(shared.value, runs)

    return cut


def _cut_in_parts(lexicon: _Lexicon, runs: pa.Array) -> pa.Array:
    """The words of the runs of each row; they are Python strings for a part of the rows at a time."""
    kind = pa.list_(pa.string())

    def of_part(part: pa.Array) -> pa.Array:
        rows = part.to_pylist()
        found = iter(lexicon.cut([run for row in rows for run in row or ()]))
        return pa.array([None if row is None else [w for _ in row for w in next(found)] for row in rows], kind)

    return joined([of_part(part) for part in parts(runs, CUT)], kind)
