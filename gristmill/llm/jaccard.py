"""N-gram Jaccard join: T-occurrence search over inverted lists with DivideSkip.

Three steps, each a Spark job over narrow rows:

1. One scan hashes every text into its shingle set and keeps a 128-bit digest and the
   ``SKETCH`` smallest hashes. Equal sets are one class with one representative.
2. Which documents can meet at all? Of the shingles in their sketches, two linked
   documents share at least ``needed`` (T-occurrence on the sketches). A document whose
   sketch has fewer shingles that occur in any other sketch is done. Of the others only
   the shortest inverted lists are followed: with its ``needed - 1`` longest lists left
   out, one of the rest still holds every partner. Lists are stars around their smallest
   document, so following them costs one row per list entry, and their connected
   components are the blocks in which to search.
3. Every document of a block is sent to it once with its whole shingle set. There each
   document searches the lists of the block: short lists are merged and counted, long
   lists are probed by binary search (DivideSkip), and partners that reach the exact
   overlap are linked.

For sets of at most 51 shingles (at 80 %) the sketch is the whole set and step 2 is exact.
For larger ones it can miss a pair at the threshold with a chance below ``MISS``, less
than that of a hash collision.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.blocks import join_ids, lists, mix, packed, pieces, utf8
from gristmill.llm.shingles import shingle_sets
from gristmill.operators.components import connected_components
from gristmill.operators.skew import join_groups
from gristmill.staging import stage

#: Smallest hashes of a set that stand for it in step 2.
SKETCH = 64
#: Bound on the chance that a linked pair shares fewer sketch hashes than asked for.
MISS = 1e-12
#: Shingles in one search task; larger blocks are split into parts that meet in pairs.
BLOCK_SHINGLES = 4_000_000
#: Weight of a probe against a merged list entry in DivideSkip's choice of long lists.
MU = 0.3


def sketch_overlap(percent: int) -> int:
    """Shared hashes among the ``SKETCH`` smallest of a union, short of a chance of ``MISS``."""
    p, total, chance = percent / 100, 0.0, 0
    for k in range(SKETCH + 1):
        total += comb(SKETCH, k) * p**k * (1 - p) ** (SKETCH - k)
        if total > MISS:
            return max(1, chance)
        chance = k + 1
    return SKETCH


def overlap(a, b, percent: int):
    """Least intersection of sets of sizes a and b with 100 * intersection >= percent * union."""
    return -(-percent * (a + b) // (100 + percent))


class _Sketches:
    """mapInArrow over (id, text): id, size, digest of the set, smallest hashes."""

    def __init__(self, words: int):
        self.words = words

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_shingles", "d1", "d2", "sketch"]
        for batch in batches:
            for part in pieces(batch, 1):
                values, offsets = shingle_sets(*utf8(part.column(1)), self.words)
                sizes = np.diff(offsets)
                digests = []
                for salt in (0x1234567, 0x89ABCDF):
                    sums = np.zeros(len(values) + 1, np.uint64)
                    np.cumsum(mix(values ^ np.uint64(salt)), out=sums[1:])
                    digests.append(pa.array((sums[offsets[1:]] - sums[offsets[:-1]]).view(np.int64)))
                place = np.arange(len(values)) - np.repeat(offsets[:-1], sizes)
                short = np.zeros(len(offsets), np.int64)
                np.cumsum(np.minimum(sizes, SKETCH), out=short[1:])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes), *digests, lists(values[place < SKETCH], short)], names)


class _Sets:
    """mapInArrow over (id, text, block, own, parts): id, block, own, parts, whole set."""

    def __init__(self, words: int):
        self.words = words

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, 1):
                values, offsets = shingle_sets(*utf8(part.column(1)), self.words)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *part.columns[2:], packed(values, offsets)],
                    ["doc_id", "_block", "_own", "_parts", "_set"])


def search(sets: list[np.ndarray], side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links (as positions) that connect what the sets' links connect.

    ``side`` 0 or 1: with both present only pairs across the sides are looked for. Two
    sets that are connected already are not compared again, so there are fewer links
    than sets.
    """
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(m), sizes)
    order = np.argsort(flat, kind="stable")
    new = np.ones(len(flat), bool)
    new[1:] = flat[order][1:] != flat[order][:-1]
    token = np.empty(len(flat), np.int64)
    token[order] = np.cumsum(new) - 1
    begin = np.r_[np.flatnonzero(new), len(flat)]
    entries, lengths = owner[order], np.diff(begin)
    ends = np.r_[0, np.cumsum(sizes)]
    both = bool(side.any()) and not side.all()
    label, links = np.arange(m), []
    members: dict[int, list[int]] = {}
    for x in range(m):
        mine = token[ends[x]:ends[x + 1]]
        mine = mine[lengths[mine] > 1]
        least = -(-percent * sizes[x] // 100)
        if len(mine) < least or not least:
            continue
        mine = mine[np.argsort(lengths[mine], kind="stable")]
        skip = min(least - 1, int(least / (MU * np.log2(max(2, lengths[mine[-1]])) + 1)))
        short, long_ = mine[:len(mine) - skip], mine[len(mine) - skip:]
        merged = np.concatenate([entries[begin[t]:begin[t + 1]] for t in short])
        found, count = np.unique(merged, return_counts=True)
        keep = (count >= least - skip) & (label[found] != label[x])
        keep &= (found > x) if not both else (side[found] != side[x])
        found, count = found[keep], count[keep]
        need = overlap(sizes[x], sizes[found], percent)
        for k, t in enumerate(long_):
            alive = count + (len(long_) - k) >= need
            if not alive.all():
                found, count, need = found[alive], count[alive], need[alive]
            if not len(found):
                break
            held = entries[begin[t]:begin[t + 1]]
            at = np.minimum(np.searchsorted(held, found), len(held) - 1)
            count = count + (held[at] == found)
        for y in found[count >= need].tolist():
            if label[y] != label[x]:
                links.append((x, y))
                small, large = sorted(
                    (int(label[x]), int(label[y])), key=lambda r: len(members.get(r, (r,))))
                moved = members.pop(small, [small])
                label[moved] = large
                members.setdefault(large, [large]).extend(moved)
    return links


class _Search:
    """mapInArrow over rows sorted by (block, low, high): links found in each group."""

    def __init__(self, percent: int):
        self.percent = percent

    def _links(self, rows: list[tuple]) -> pa.RecordBatch:
        rows.sort(key=lambda r: (r[1], r[0]))
        ids = np.array([r[0] for r in rows], np.int64)
        own = np.array([r[1] for r in rows])
        links = search([np.frombuffer(r[2], np.uint64) for r in rows], (own != own[0]).astype(int), self.percent)
        a, b = np.array(links, np.int64).reshape(-1, 2).T
        return pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], ["a", "b"])

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for block, low, high, doc, own, held in zip(*columns, batch.column(5)):
                if group != (block, low, high):
                    if len(rows) > 1:
                        yield self._links(rows)
                    group, rows = (block, low, high), []
                rows.append((doc, own, held.as_buffer().to_pybytes()))
        if len(rows) > 1:
            yield self._links(rows)


def _blocks(sets: DataFrame, percent: int) -> DataFrame:
    """``doc_id, _block`` of the documents that may have a partner."""
    whole = SKETCH * percent // 100
    needed = F.when(F.col("n_shingles") <= whole, F.ceil(F.col("n_shingles") * percent / F.lit(100))).otherwise(
        F.lit(sketch_overlap(percent))).cast("int")
    entries = sets.select("doc_id", needed.alias("_needed"), F.explode("sketch").alias("_token"))
    shared = entries.groupBy("_token").agg(F.count("*").alias("_length")).filter("_length > 1")
    shared = stage(shared.withColumn("_weight", F.col("_length")), "lists")
    followed = join_groups(entries, shared, ["_token"], "_weight", ["doc_id"])
    # At most SKETCH entries per document.
    held = followed.groupBy("doc_id", "_needed").agg(F.sort_array(F.collect_list(F.struct("_length", "_token"))).alias("_lists"))
    short = F.slice("_lists", F.lit(1), F.size("_lists") - F.col("_needed") + 1)
    held = held.filter(F.size("_lists") >= F.col("_needed")).select("doc_id", F.explode(short).alias("_list"))
    routes = stage(held.select("doc_id", F.col("_list._token").alias("_token")), "routes")
    stars = routes.groupBy("_token").agg(F.min("doc_id").alias("_hub"), F.count("*").alias("_weight"))
    edges = join_groups(routes, stars.filter("_weight > 1"), ["_token"], "_weight", ["doc_id"])
    edges = edges.filter("doc_id <> _hub").select("doc_id", "_hub").distinct()
    return connected_components(edges, "doc_id", "_hub").select(
        F.col("node").alias("doc_id"), F.col("component").alias("_block"))


def ngram_jaccard(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row per input row.

    Two documents link when ``100 * intersection >= percent * union`` of their sets of
    ``words``-word shingles; ``component_id`` is the smallest id that links reach. Texts
    that are null, empty or without words have no shingles and link with nothing. Rows
    with the same id are one node. A row without an id links with nothing and has no
    component. An empty table gives an empty result. Other columns are not read.

    Equal sets are one representative and lists become stars. A block above
    ``BLOCK_SHINGLES`` shingles is dealt over tasks in parts, of which each two meet.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sets = stage(source.mapInArrow(
        _Sketches(words), "doc_id long, n_shingles long, d1 long, d2 long, sketch array<long>"), "sketches")
    known = sets.filter("doc_id IS NOT NULL AND n_shingles > 0")
    digest = ["n_shingles", "d1", "d2"]
    equal = known.groupBy(*digest).agg(F.min("doc_id").alias("_hub"), F.count("*").alias("_weight"))
    copies = join_groups(known.select("doc_id", *digest), equal.filter("_weight > 1"), digest, "_weight", ["doc_id"])
    copies = stage(copies.filter("doc_id <> _hub").select("doc_id", *digest, "_hub").distinct(), "copies")
    # An id may have several texts; only the set that equals another one is left out.
    single = join_ids(known, copies.select("doc_id", *digest), ["doc_id", *digest], "left_anti")
    blocks = stage(_blocks(single, percent), "blocks")
    sized = stage(single.groupBy("doc_id").agg(F.sum("n_shingles").alias("n_shingles")).join(blocks, "doc_id"), "sized")
    parts = sized.groupBy("_block").agg(
        F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).cast("int").alias("_parts"), F.count("*").alias("_weight"))
    dealt = join_groups(sized.select("doc_id", "_block"), parts, ["_block"], "_weight", ["doc_id"])
    dealt = dealt.select("doc_id", "_block", F.pmod(F.xxhash64("doc_id"), F.col("_parts")).cast("int").alias("_own"), "_parts")
    dealt = stage(dealt.dropDuplicates(["doc_id"]), "dealt")
    packed_sets = join_ids(source, dealt, "doc_id").select("doc_id", "text", "_block", "_own", "_parts").mapInArrow(
        _Sets(words), "doc_id long, _block long, _own int, _parts int, _set binary")
    tasks = packed_sets.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).select(
        "_block", F.least("_own", "_other").alias("_low"), F.greatest("_own", "_other").alias("_high"),
        "doc_id", "_own", "_set")
    found = tasks.repartition("_block", "_low", "_high").sortWithinPartitions("_block", "_low", "_high").mapInArrow(
        _Search(percent), "a long, b long")
    edges = found.unionByName(copies.select(F.col("doc_id").alias("a"), F.col("_hub").alias("b")))
    members = connected_components(edges, "a", "b").select(F.col("node").alias("doc_id"), "component")
    return sets.select("doc_id", "n_shingles").join(members, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def jaccard_sql(docs: str = "documents") -> str:
    """DuckDB SQL: sets by list functions, overlaps by a join on shingles, recursive reachability."""
    return rf"""WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(
  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w FROM {docs}),
sets AS MATERIALIZED (SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_distinct([array_to_string(w[i:i + 4], ' ') for i in range(1, len(w) - 3)]) END s FROM words),
shingles AS MATERIALIZED (SELECT doc_id, len(s) n, hash(x) h FROM (SELECT doc_id, s, unnest(s) x FROM sets)),
links AS MATERIALIZED (SELECT a.doc_id u, b.doc_id v FROM shingles a JOIN shingles b ON a.h = b.h AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 180 * count(*) >= 80 * (a.n + b.n)),
reach AS (SELECT doc_id node, doc_id root FROM sets UNION SELECT l.v, r.root FROM reach r JOIN links l ON l.u = r.node AND r.root < l.v)
SELECT s.doc_id, len(s.s)::BIGINT n_shingles, min(r.root) component_id FROM sets s JOIN reach r ON r.node = s.doc_id GROUP BY s.doc_id, s.s"""
