"""Ranked lexical search: branch and bound over tries of restricted term vectors.

Items are the queries; all documents are ranked for each. A document is reduced to the
terms that occur in items of the pass, with their counts. In every task the vectors of some
thousand documents form an FP-tree: terms in order of their document frequency, documents
with the same leading terms on one path. A node keeps the largest count of each term below
it and the smallest length norm. From these follows the most that a document below can
score, in the same integers as the score, so a depth-first search from the most promising
child on leaves out every subtree that cannot reach the best documents known.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm.blocks import RangeHash, packed, pieces, utf8
from gristmill.llm.terms import LOWER, TERM, Lanes, same_bytes, stretches
from gristmill.staging import stage

#: Documents in a ranking.
BEST = 20
#: Terms of items that one pass takes, about; larger sets of items are taken in several passes.
PASS_TERMS = 50_000
#: Bytes of vectors in one tree (8 for a term), and documents that are scored together at its end.
TREE_BYTES, LEAF = 8 << 20, 48
#: Parts in which the best of all tasks are merged first.
PARTS = 256

_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LAST = (1 << 63) - 1


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, _CAPITALS, _SMALL), F.lit(_PATTERN), F.lit(0))


def gain(count: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """What one unit of weight adds to a score; grows with the count and falls with the norm."""
    return 1_000_000_000 * count // (1000 * count + 12 * norm)


class Vocabulary:
    """Terms as sorted hashes with their bytes."""

    def __init__(self, terms: list[bytes]):
        data = np.frombuffer(b"".join(terms), np.uint8)
        ends = np.cumsum([len(t) for t in terms], dtype=np.int64)
        starts = np.r_[0, ends[:-1]].astype(np.int64)[:len(terms)]
        hashes = RangeHash(data).of(starts, ends)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.term, self.starts, self.sizes = hashes[order], order, starts[order], (ends - starts)[order]
        self.data = data
        # Different terms of one hash stand side by side.
        self.most = int(np.unique(hashes, return_counts=True)[1].max(initial=0))
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(hashes >> np.uint64(44)).astype(np.int64)] = True

    def find(self, part: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the ranges are a term, and which one; bytes are compared."""
        hashes = RangeHash(part).of(starts, ends)
        at = np.flatnonzero(self.sieve[(hashes >> np.uint64(44)).astype(np.int64)])
        first = np.searchsorted(self.hashes, hashes[at])
        found, which, mine, ours = [], [], Lanes(part), Lanes(self.data)
        for k in range(self.most):
            place = np.minimum(first + k, len(self.hashes) - 1)
            same = np.flatnonzero((self.hashes[place] == hashes[at]) & (first + k < len(self.hashes)))
            a, b = at[same], place[same]
            same = self.sizes[b] == ends[a] - starts[a]
            a, b = a[same], b[same]
            same = same_bytes(mine, starts[a], ours, self.starts[b], self.sizes[b])
            found.append(a[same])
            which.append(self.term[b[same]])
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *found]), np.concatenate([none, *which])


class _Vectors:
    """mapInArrow over (id, text): id, number of all terms, terms of the vocabulary and their counts."""

    def __init__(self, terms: list[bytes]):
        self.terms = terms

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(self.terms)
        width = max(1, len(self.terms))
        for batch in batches:
            for part in pieces(batch, 1):
                data, offsets = utf8(part.column(1))
                n = part.num_rows
                total = np.zeros(n, np.int64)
                codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
                for begin, end, starts, ends, rows in stretches(data, offsets, TERM):
                    total += np.bincount(rows, minlength=n)
                    found, term = vocabulary.find(LOWER[data[begin:end]], starts - begin, ends - begin)
                    code, count = np.unique(rows[found] * width + term, return_counts=True)
                    codes, counts = np.r_[codes, code], np.r_[counts, count]
                if len(codes):
                    codes, place = np.unique(codes, return_inverse=True)
                    sums = np.zeros(len(codes), np.int64)
                    np.add.at(sums, place, counts)
                    counts = sums
                border = np.searchsorted(codes, np.arange(n + 1) * width)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(total), packed((codes % width).astype("<u4"), border), packed(counts.astype("<u4"), border)],
                    ["doc_id", "n", "terms", "counts"])


class _Frequencies:
    """mapInArrow over (terms): documents of the task that hold each term."""

    def __init__(self, width: int):
        self.width = width

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(self.width, np.int64)
        for batch in batches:
            data, _ = utf8(batch.column(0))
            held += np.bincount(np.frombuffer(data.tobytes(), "<u4"), minlength=self.width)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], ["term", "n"])


class Tree:
    """An FP-tree of documents, with bounds at its nodes.

    ``ranks`` and ``counts`` are the vectors one after the other, ``offsets`` their
    bounds, ``norms`` one number a document. Documents are sorted by their rank
    sequences; a node is an interval of them, ``begin`` to ``end``, that share a path.
    Children are the intervals between the places where neighbours share least. Small
    neighbouring children, and equal documents, are one leaf.
    """

    def __init__(self, ranks: np.ndarray, counts: np.ndarray, offsets: np.ndarray, norms: np.ndarray):
        docs = len(offsets) - 1
        row = np.repeat(np.arange(docs), np.diff(offsets))
        order = np.lexsort((ranks, row))
        ranks, counts = ranks[order], counts[order]
        raw, ends = ranks.astype(">u4").tobytes(), (4 * offsets).tolist()
        keys = [raw[a:b] for a, b in zip(ends, ends[1:])]
        self.order = np.array(sorted(range(docs), key=keys.__getitem__), np.int64)
        size = np.diff(offsets)[self.order]
        self.offsets = np.r_[0, np.cumsum(size)]
        place = np.arange(self.offsets[-1]) + np.repeat(offsets[self.order] - self.offsets[:-1], size)
        self.columns, self.column = np.unique(ranks[place], return_inverse=True)
        self.norms = norms[self.order]
        self.gains = gain(counts[place], np.repeat(self.norms, size))
        self._split(self._shared(ranks[place], size))
        self.most = np.zeros((len(self.begin), len(self.columns)), np.int32)
        self.least = np.zeros(len(self.begin), np.int64)
        leaf = np.zeros(docs, np.int64)
        for k, (a, b, below) in enumerate(zip(self.begin, self.end, self.children)):
            if not below:
                leaf[a:b] = k
                self.least[k] = self.norms[a:b].min()
        np.maximum.at(self.most, (np.repeat(leaf, size), self.column), counts[place].astype(np.int32))
        for k in range(len(self.begin) - 1, -1, -1):
            if self.children[k]:
                self.most[k] = self.most[self.children[k]].max(axis=0)
                self.least[k] = self.least[self.children[k]].min()

    def _shared(self, ranks: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Leading terms that a document shares with the one before it."""
        out, at = np.zeros(len(size), np.int64), self.offsets.tolist()
        for k in range(1, len(size)):
            n = min(at[k] - at[k - 1], at[k + 1] - at[k])
            same = ranks[at[k - 1]:at[k - 1] + n] == ranks[at[k]:at[k] + n]
            out[k] = n if same.all() else int(same.argmin())
        return out

    def _split(self, shared: np.ndarray) -> None:
        self.begin, self.end, self.children = [0], [len(shared)], [[]]
        open_ = [0]
        while open_:
            node = open_.pop()
            a, b = self.begin[node], self.end[node]
            if b - a <= LEAF:
                continue
            inner = shared[a + 1:b]
            cuts = np.r_[a, np.flatnonzero(inner == inner.min()) + a + 1, b].tolist()
            start = a
            for k in range(1, len(cuts)):
                # Children go on together until the next one would make them larger than a leaf.
                if k + 1 < len(cuts) and cuts[k + 1] - start <= LEAF:
                    continue
                self.children[node].append(len(self.begin))
                self.begin.append(start)
                self.end.append(cuts[k])
                self.children.append([])
                if cuts[k] - start > LEAF:
                    open_.append(len(self.begin) - 1)
                start = cuts[k]

    def search(self, columns: np.ndarray, weights: np.ndarray, best: "Best", ids: np.ndarray, known: np.ndarray) -> int:
        """Adds the documents that are among the best to ``best``; returns how many were scored."""
        below = self.most[:, columns].astype(np.int64)
        bounds = (gain(below, self.least[:, None]) @ weights).tolist()
        weight = np.zeros(len(self.columns), np.int64)
        weight[columns] = weights
        scored, open_ = 0, [0]
        while open_:
            node = open_.pop()
            if bounds[node] <= 0 or bounds[node] < best.least:
                continue
            if self.children[node]:
                open_ += sorted(self.children[node], key=bounds.__getitem__)
                continue
            a, b = self.begin[node], self.end[node]
            first, last = self.offsets[a], self.offsets[b]
            sums = np.r_[0, np.cumsum(weight[self.column[first:last]] * self.gains[first:last])]
            score = np.diff(sums[self.offsets[a:b + 1] - first])
            scored += b - a
            good = np.flatnonzero((score > 0) & (score >= best.least))
            if len(good):
                docs = self.order[a + good]
                best.add(score[good], ids[docs], known[docs])
        return scored


class Best:
    """The best documents of an item: highest score first, then smallest id; no id is the largest."""

    def __init__(self, k: int):
        self.k, self.least = k, 0
        self.score, self.ids, self.known = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, score: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        score, ids, known = np.r_[self.score, score], np.r_[self.ids, ids], np.r_[self.known, known]
        order = np.lexsort((ids, ~known, -score))[:self.k]
        self.score, self.ids, self.known = score[order], ids[order], known[order]
        if len(order) == self.k:
            self.least = int(self.score[-1])


class _Search:
    """mapInArrow over (id, n, terms, counts): the best documents of the task for every item.

    ``items`` has number, terms and weights of each item.
    """

    def __init__(self, items: list[tuple[int, np.ndarray, np.ndarray]], rank: np.ndarray, k: int, docs: int, length: int):
        self.items, self.rank, self.k, self.docs, self.length = items, rank, k, docs, length

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(self.k) for _ in self.items]
        wanted = [(np.array(self.rank[terms], np.int64), weights) for _, terms, weights in self.items]
        for batch in batches:
            for part in pieces(batch, 2, TREE_BYTES // 2):
                raw, offsets = utf8(part.column(2))
                if not len(raw):
                    continue
                terms = np.frombuffer(raw.tobytes(), "<u4")
                counts = np.frombuffer(utf8(part.column(3))[0].tobytes(), "<u4").astype(np.int64)
                norms = 75 + 25 * part.column(1).to_numpy() * self.docs // self.length
                tree = Tree(self.rank[terms], counts, offsets // 4, norms)
                known = np.asarray(part.column(0).is_valid())
                ids = part.column(0).fill_null(_LAST).to_numpy(zero_copy_only=False)
                for (ranks, weights), found in zip(wanted, best):
                    place = np.minimum(np.searchsorted(tree.columns, ranks), len(tree.columns) - 1)
                    here = tree.columns[place] == ranks
                    if here.any():
                        tree.search(place[here], weights[here], found, ids, known)
        number = np.repeat(np.array([i for i, _, _ in self.items], np.int64), [len(b.score) for b in best])
        score, ids, known = (np.concatenate([getattr(b, name) for b in best] or [[]]) for name in ("score", "ids", "known"))
        yield pa.RecordBatch.from_arrays(
            [pa.array(number), pa.array(ids.astype(np.int64), mask=~known.astype(bool)), pa.array(score.astype(np.int64))],
            ["_item", "doc_id", "score"])


def _top(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def rank_documents(
    docs: DataFrame, items: DataFrame, k: int = BEST, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` highest-scoring documents of each item.

    Items are taken in passes of about ``PASS_TERMS`` terms; only the items of one pass
    are held by the driver and sent to the tasks. A pass reads whole texts once, in
    stretches, and writes restricted vectors; texts are not shuffled, and a task gives
    ``k`` rows an item at most.

    Rows of ``items`` with one id are one item, equal rows counting once; a missing id is
    an item too. Null and empty items, and those whose terms no document holds, have no
    rows. Null and empty texts have no terms and do not count as documents. Equal scores
    go by id, documents without one last; repeated rows are documents of their own. Empty
    tables give an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    held = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("_text")).distinct()
    held = held.select("item_id", F.explode(terms_of(F.col("_text"))).alias("_term"))
    held = stage(held.groupBy("item_id", "_term").agg(F.count("*").alias("_times")), "item-terms")
    passes = held.count() // PASS_TERMS + 1
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    done = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for number in range(passes):
        mine = held.filter(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == number).collect()
        if not mine:
            continue
        names = sorted({r["_term"] for r in mine})
        index = {name: place for place, name in enumerate(names)}
        vectors = stage(rows.mapInArrow(
            _Vectors([name.encode() for name in names]), "doc_id long, n long, terms binary, counts binary"), "vectors")
        total, length = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not total:
            return done
        frequency = np.zeros(len(names), np.int64)
        partial = vectors.select("terms").mapInArrow(_Frequencies(len(names)), "term long, n long")
        for term, n in partial.groupBy("term").agg(F.sum("n")).collect():
            frequency[term] = n
        weight = np.floor(1000 * np.log((2 * total + 2) / (2 * frequency + 1))).astype(np.int64)
        rank = np.empty(len(names), np.int64)
        rank[np.lexsort((np.arange(len(names)), -frequency))] = np.arange(len(names))
        asked: dict[int | None, list[tuple[int, int]]] = {}
        for r in sorted(mine, key=lambda r: r["_term"]):
            asked.setdefault(r["item_id"], []).append((index[r["_term"]], r["_times"]))
        ids = sorted(asked, key=lambda i: (i is None, i or 0))
        wanted = []
        for place, item in enumerate(ids):
            terms, times = np.array(asked[item], np.int64).T
            wanted.append((place, terms, weight[terms] * times))
        found = vectors.filter("n > 0").select("doc_id", "n", "terms", "counts").mapInArrow(
            _Search(wanted, rank, k, total, length), "_item long, doc_id long, score long")
        found = _top(found.withColumn("_part", F.spark_partition_id() % PARTS), ["_item", "_part"], k).drop("rank", "_part")
        numbers = spark.createDataFrame(list(enumerate(ids)), "_item long, item_id long")
        best = _top(found, ["_item"], k).join(F.broadcast(numbers), "_item")
        done = done.unionByName(stage(best.select("item_id", "rank", "doc_id", "score"), "ranked"))
    return done


def ranked_sql(docs: str = "documents", items: str = "benchmark") -> str:
    """DuckDB SQL that scores every document for every item."""
    words = f"coalesce(regexp_extract_all(translate(text, '{_CAPITALS}', '{_SMALL}'), '{_PATTERN}'), [])"
    return rf"""WITH held AS MATERIALIZED (SELECT row_number() OVER () AS no, doc_id, {words} w FROM {docs}),
totals AS (SELECT count(*) n, sum(len(w))::BIGINT l FROM held WHERE len(w) > 0),
counts AS MATERIALIZED (SELECT no, x, count(*) tf FROM (SELECT no, unnest(w) x FROM held) GROUP BY no, x),
weights AS (SELECT x, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT weight FROM counts, totals GROUP BY x, n),
norms AS (SELECT no, doc_id, 75 + (25 * len(w) * n) // l m FROM held, totals WHERE len(w) > 0),
asked AS (SELECT item_id, x, count(*) times FROM (SELECT item_id, unnest({words}) x FROM (SELECT DISTINCT item_id, text FROM {items})) GROUP BY item_id, x),
scores AS (SELECT item_id, no, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT score
  FROM asked JOIN weights USING (x) JOIN counts USING (x) JOIN norms USING (no) GROUP BY item_id, no),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
  FROM scores JOIN norms USING (no) WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= {BEST}"""
