"""Approximate nearest neighbours by inner product: NN-descent and greedy graph search.

1. Equal vectors are one node; a node keeps only as many of its ids as a result can need.
2. A first graph comes from a few random-projection trees, fitted on a bounded sample:
   nodes of a leaf are compared with each other. A leaf that is still too large is cut
   further along directions of its tree, at the medians of all its nodes.
3. NN-descent: in each round every node brings its neighbours and a sample of the nodes
   that have it as a neighbour together; those are compared with each other, unless they
   were in the round before, and each keeps its best. Rounds go on until few neighbours
   change.
4. A query walks the graph greedily: its pool of best nodes is expanded a few at a time
   until all of the pool have been expanded.

Nodes are dealt to blocks by a hash of their id. A round and a step of the search are
messages between blocks, arrays for many nodes in one row, so that Spark moves few rows
and the work inside a block is done by whole arrays.

Vectors travel as packed bytes; scores of results are in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gristmill.functions.messages import MESSAGE as _MESSAGE
from gristmill.functions.messages import Step, dealt
from gristmill.functions.messages import deal as _deal
from gristmill.functions.messages import first as _first
from gristmill.functions.messages import received as _received
from gristmill.functions.messages import rows as _rows
from gristmill.llm.blocks import hash_below, mix, utf8
from gristmill.operators.skew import join_groups
from gristmill.staging import stage

#: Neighbours of a node in the graph; at most so many of the nodes that point to it take part.
NEIGHBOURS, REVERSE = 48, 24
#: Best nodes that a member takes from one leaf; from a round it takes all that are better than what it has.
LEAF_KEPT = 20
#: Trees, vectors they are fitted on, and nodes in a leaf at most.
TREES, TREE_SAMPLE, LEAF = 10, 20_000, 1000
#: NN-descent ends when fewer than this share of neighbours change.
SETTLED = 0.02
#: Bytes that a block compares in a round and that a task reads, about.
TASK_BYTES = 32 << 20
#: Nodes in the pool of a query at least (four times the results asked for, if more), and how many are expanded in a step.
POOL, EXPANDED = 80, 16


class _Pack:
    """mapInArrow over (id, vector): id and packed vector of those that are usable."""

    def __init__(self, kind: str):
        self.kind = kind

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, ends = batch.column(1), batch.column(1).offsets.to_numpy().astype(np.int64)
            given = lists.values.is_valid().to_numpy(zero_copy_only=False)
            x = lists.values.fill_null(0).to_numpy(zero_copy_only=False).astype(self.kind) + 0
            counted = lambda wanted: np.diff(np.concatenate([[0], np.cumsum(wanted)])[ends])
            usable = (counted(~given | ~np.isfinite(x)) == 0) & (counted(x != 0) > 0)
            usable &= batch.column(0).is_valid().to_numpy(zero_copy_only=False) & lists.is_valid().to_numpy(zero_copy_only=False)
            offsets = pa.py_buffer((ends * x.itemsize).astype(np.int64).tobytes())
            wide = pa.Array.from_buffers(pa.large_binary(), len(lists), [None, offsets, pa.py_buffer(x)])
            some = pa.array(usable)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(some).cast(pa.int64()), wide.filter(some).cast(pa.binary())], ["vec_id", "_vec"])


def _matrix(vectors: list[bytes], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1)


class _Trees:
    """Random-projection trees: thresholds at the medians of a sample, node by node."""

    def __init__(self, sample: np.ndarray, depth: int, dims: int):
        rng = np.random.default_rng(7)
        self.depth = depth
        self.directions = rng.normal(size=(TREES, max(depth, 1), dims))
        self.cuts = np.zeros((TREES, max(1, 1 << depth)))
        for t in range(TREES):
            at = np.ones(len(sample), int)
            for level in range(depth):
                value = sample @ self.directions[t, level]
                for node in np.unique(at):
                    self.cuts[t, node] = np.median(value[at == node])
                at = 2 * at + (value > self.cuts[t, at])

    def leaves(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((TREES, len(x)), np.int64)
        for t in range(TREES):
            at = np.ones(len(x), int)
            for level in range(self.depth):
                at = 2 * at + (x @ self.directions[t, level] > self.cuts[t, at])
            out[t] = at + (t << 40)
        return out


class _Leaves:
    """mapInArrow over (node, vector): one row per tree with the leaf."""

    def __init__(self, trees: _Trees, kind: str):
        self.trees, self.kind = trees, kind

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            leaves = self.trees.leaves(_packed(batch.column(1), self.kind))
            for leaf in leaves:
                yield pa.RecordBatch.from_arrays([pa.array(leaf), batch.column(0), batch.column(1)], ["_group", "_node", "_vec"])


class _Project:
    """mapInArrow over (group, node, vector): the node's place along its tree's direction of a level."""

    def __init__(self, level: int, kind: str):
        self.level, self.kind = level, kind

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _packed(batch.column(2), self.kind)
            tree = batch.column(0).to_numpy() >> 40
            value = np.empty(len(x))
            for t in np.unique(tree):
                mine = tree == t
                value[mine] = x[mine] @ np.random.default_rng([int(t), self.level]).normal(size=x.shape[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(value)], ["_group", "_node", "_value"])


def _split(leaves: DataFrame, nodes: DataFrame, depth: int, kind: str) -> DataFrame:
    """``leaves`` (``_group, _node, _vec``), none of them above ``LEAF`` nodes.

    Larger ones are halved level by level. Each tree has directions of its own, so nodes
    that are parted in one tree meet in another. Equal places are dealt by tree and level.
    """
    open_, done, level = leaves, None, depth
    while True:
        sizes = stage(open_.groupBy("_group").agg(F.count("*").alias("_weight")), "leaf-sizes")
        large = sizes.filter(F.col("_weight") > LEAF)
        if large.isEmpty():
            return open_ if done is None else done.unionByName(open_)
        fit = open_.join(large.select("_group"), "_group", "left_anti").select("_group", "_node", "_vec")
        done = fit if done is None else done.unionByName(fit)
        valued = stage(join_groups(open_, large, ["_group"], "_weight", ["_node"]).select("_group", "_node", "_vec").mapInArrow(
            _Project(level, kind), "_group long, _node long, _value double"), "values")
        cuts = valued.groupBy("_group").agg(F.percentile_approx("_value", 0.5).alias("_cut"), F.count("*").alias("_weight"))
        tree = F.shiftright("_group", 40)
        tied = (F.col("_value") == F.col("_cut")) & (F.pmod(F.xxhash64("_node", tree, F.lit(level)), F.lit(2)) == 1)
        right = ((F.col("_value") > F.col("_cut")) | tied).cast("long")
        at = 2 * (F.col("_group") - F.shiftleft(tree, 40)) + right
        halves = join_groups(valued, cuts, ["_group"], "_weight", ["_node"]).select(
            (F.shiftleft(tree, 40) + at).alias("_group"), "_node")
        open_ = stage(halves, "leaves").join(nodes.select("_node", "_vec"), "_node")
        level += 1


def _packed(column: pa.Array, kind: str) -> np.ndarray:
    """A column of packed vectors of one length as the rows of a matrix."""
    data, _ = utf8(column)
    return data.view(kind).reshape(len(column), -1)


def _block_of(ids: np.ndarray, blocks: int) -> np.ndarray:
    """The block that holds a node: a function of its id alone."""
    return (mix(ids.view(np.uint64)) % np.uint64(blocks)).astype(np.int64)


class Layout:
    """The nodes in ``blocks``, the kind of their vectors, and tasks for a round and for a step of the search.

    What a block compares in a round takes 32 MB at most, as does what a task of a step reads.
    """

    def __init__(self, spark: SparkSession, n: int, vector_bytes: int, kind: str):
        compared = (1 + NEIGHBOURS + REVERSE) * max(1, vector_bytes)
        self.blocks = max(1, -(-n // min(1024, max(16, TASK_BYTES // compared), max(256, n // 64))))
        self.kind = kind
        least = 2 * spark.sparkContext.defaultParallelism
        self.round = max(least, n * compared // TASK_BYTES)
        self.search = max(least, n * (vector_bytes + 16 * NEIGHBOURS) // TASK_BYTES)


def _concat(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _rank(first: np.ndarray) -> np.ndarray:
    """Places, from 0, of rows in their group, of which ``first`` tells the beginnings."""
    at = np.arange(len(first))
    return at - np.maximum.accumulate(np.where(first, at, 0))


class _Step(Step):
    """One step of all blocks of a layout."""

    def __init__(self, layout: Layout, **parameters):
        self.layout, self.blocks, self.kind = layout, layout.blocks, layout.kind
        self.__dict__.update(parameters)


def _stepped(step: _Step, parts: int, *tables: DataFrame) -> DataFrame:
    """What a step makes of states and messages, in ``parts`` tasks; a block is in one of them."""
    return dealt(min(parts, step.blocks), *tables).mapInArrow(step, _MESSAGE)


def _staged(steps: DataFrame, label: str) -> tuple[DataFrame, int, int]:
    """The written states of all blocks, what is left to do in them, and of how much."""
    table = stage(steps, label)
    left, total = table.agg(F.sum("_left"), F.sum("_total")).first()
    return table.select("_block", "_kind", "_data"), left or 0, total or 0


class _Nodes:
    """mapInArrow over (node, vector): parts of the states of blocks."""

    def __init__(self, layout: Layout):
        self.blocks, self.kind = layout.blocks, layout.kind

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids, x = batch.column(0).to_numpy(), _packed(batch.column(1), self.kind)
                yield _rows([(to, 0, tuple(part)) for to, part in _deal(_block_of(ids, self.blocks), ids, x)])


class _Compare:
    """mapInArrow over (group, node, vector) by group: each member's best in its group, sent to its block."""

    def __init__(self, kept: int, layout: Layout):
        self.kept, self.blocks, self.kind = kept, layout.blocks, layout.kind

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for ids, x in self._groups(batches):
            scores = x @ x.T
            np.fill_diagonal(scores, -np.inf)
            kept = min(self.kept, len(ids) - 1)
            if not kept:
                continue
            top = np.argpartition(-scores, kept - 1, axis=1)[:, :kept]
            held.append((np.repeat(ids, kept), ids[top].ravel(), np.take_along_axis(scores, top, axis=1).ravel()))
            size += top.size
            if size > 1_000_000:
                yield self._sent(held)
                held, size = [], 0
        if held:
            yield self._sent(held)

    def _sent(self, held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        node, near, score = (np.concatenate(c) for c in zip(*held))
        return _rows([(to, 1, tuple(part)) for to, part in _deal(_block_of(node, self.blocks), node, near, score)])

    def _groups(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        last, ids, x = None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            groups, nodes, vectors = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _packed(batch.column(2), self.kind)
            starts = np.flatnonzero(_first(groups))
            for start, end in zip(starts, np.r_[starts[1:], len(groups)]):
                if ids and groups[start] != last:
                    yield np.concatenate(ids), np.concatenate(x)
                    ids, x = [], []
                last = groups[start]
                # Copies, as the memory of a batch is used again.
                ids.append(nodes[start:end].copy())
                x.append(vectors[start:end].copy())
        if ids:
            yield np.concatenate(ids), np.concatenate(x)


# The state of a block: ids (sorted) and vectors of its nodes, the neighbours of each with their scores, best
# first (-inf where there are none), and who was compared for each in the last round.


class _Merge(_Step):
    """The neighbours of each node become the best of those it had and those that were found.

    It tells how many neighbours are new, and how many there are.
    """

    def step(self, block, state, messages):
        if len(state) == 1 and len(state[0]) > 2:
            ids, x, near, score, met = state[0]
        else:
            ids, x = (np.concatenate(c) for c in zip(*state))
            order = np.argsort(ids)
            ids, x, met = ids[order], x[order], None
            near, score = np.zeros((len(ids), NEIGHBOURS), np.int64), np.full((len(ids), NEIGHBOURS), -np.inf, self.kind)
        row, place = np.nonzero(score > -np.inf)
        at = np.concatenate([row, *(np.searchsorted(ids, m[0]) for m in messages)])
        who = np.concatenate([near[row, place], *(m[1] for m in messages)])
        value = np.concatenate([score[row, place], *(m[2] for m in messages)])
        new = np.arange(len(at)) >= len(row)
        # Of a pair that comes more than once, the place it had counts first.
        order = np.lexsort((who, at))
        order = order[_first(at[order], who[order])]
        at, who, value, new = at[order], who[order], value[order], new[order]
        order = np.lexsort((who, -value, at))
        rank = _rank(_first(at[order]))
        order, rank = order[rank < NEIGHBOURS], rank[rank < NEIGHBOURS]
        near, score = np.zeros_like(near), np.full_like(score, -np.inf)
        near[at[order], rank], score[at[order], rank] = who[order], value[order]
        yield block, 0, (ids, x, near, score, met), int(new[order].sum()), len(order)


class _Ask(_Step):
    """Blocks ask for the nodes that theirs point to, and tell those who points to them.

    A node is told by a block at most ``REVERSE`` of the nodes, those that come first.
    """

    def step(self, block, state, messages):
        ids, _, near, score, _ = state[0]
        row, place = np.nonzero(score > -np.inf)
        to, by = near[row, place], ids[row]
        order = np.lexsort((by, _order(by, self.turn), to))
        to, by = to[order], by[order]
        told = _rank(_first(to)) < REVERSE
        for other, (t, b) in _deal(_block_of(to[told], self.blocks), to[told], by[told]):
            yield other, 1, (block, t, b)
        yield block, 0, state[0]


def _order(ids: np.ndarray, turn: int) -> np.ndarray:
    return mix(ids.view(np.uint64) ^ mix(np.array([turn + 1], np.uint64)))


class _Sample(_Step):
    """Of the nodes that point to a node ``REVERSE`` take part in the round; their blocks are asked for them."""

    def step(self, block, state, messages):
        to, by = _concat([m[1] for m in messages], np.int64), _concat([m[2] for m in messages], np.int64)
        order = np.lexsort((by, _order(by, self.turn), to))
        to, by = to[order], by[order]
        taken = _rank(_first(to)) < REVERSE
        to, by = to[taken], by[taken]
        asked = [(m[0], np.unique(m[1])) for m in messages]
        for other, (b,) in _deal(_block_of(by, self.blocks), by):
            yield other, 1, (block, np.unique(b))
        yield block, 0, (state[0], to, by, asked)


class _Answer(_Step):
    """Blocks get the vectors that they asked for, with the score that a new neighbour of each must reach."""

    def step(self, block, state, messages):
        own, to, by, asked = state[0]
        ids, x, _, score, _ = own
        wanted = {}
        for other, some in [*asked, *messages]:
            wanted.setdefault(other, []).append(some)
        for other, some in wanted.items():
            if other != block:
                at = np.searchsorted(ids, np.unique(np.concatenate(some)))
                yield other, 1, (ids[at], x[at], score[at, -1])
        yield block, 0, (own, to, by)


class _Local(_Step):
    """The neighbours of a node and those that point to it are compared with each other.

    What can be among the neighbours of a node is sent to it. Two nodes that were both
    here in the last round have been compared then.
    """

    def step(self, block, state, messages):
        (ids, x, near, score, met), to, by = state[0]
        known = np.concatenate([ids, *(m[0] for m in messages)])
        vectors = np.concatenate([x, *(m[1] for m in messages)])
        least = np.concatenate([score[:, -1], *(m[2] for m in messages)])
        sorter = np.argsort(known)
        place = lambda some: sorter[np.minimum(np.searchsorted(known, some, sorter=sorter), len(known) - 1)]
        own = np.arange(len(ids))[:, None]
        back = np.repeat(own, REVERSE, axis=1)
        back[np.searchsorted(ids, to), _rank(_first(to))] = place(by)
        members = np.concatenate([own, np.where(score > -np.inf, place(near), own), back], axis=1)
        members.sort(axis=1)
        valid = np.ones(members.shape, bool)
        valid[:, 1:] = members[:, 1:] != members[:, :-1]
        n = len(known)
        fresh = valid
        if met is not None:
            was = place(met)
            was = (own * n + was)[known[was] == met]
            fresh = valid & ~np.isin(own * n + members, was)
        pairs, scores = [], []
        size = max(1, (1 << 22) // (members.shape[1] * max(members.shape[1], vectors.shape[1])))
        for start in range(0, len(ids), size):
            m, v, f = members[start:start + size], valid[start:start + size], fresh[start:start + size]
            some = vectors[m]
            value = some @ some.transpose(0, 2, 1)
            met_now = (v[:, :, None] & f[:, None, :]) | (f[:, :, None] & v[:, None, :])
            met_now &= value >= least[m][:, :, None]
            met_now[:, np.arange(m.shape[1]), np.arange(m.shape[1])] = False
            g, i, j = np.nonzero(met_now)
            pairs.append(m[g, i] * n + m[g, j])
            scores.append(value[g, i, j])
        pairs, first = np.unique(np.concatenate(pairs), return_index=True)
        at, who, value = pairs // n, pairs % n, np.concatenate(scores)[first]
        if len(at) and np.bincount(at).max() > NEIGHBOURS:
            order = np.lexsort((known[who], -value, at))
            order = order[_rank(_first(at[order])) < NEIGHBOURS]
            at, who, value = at[order], who[order], value[order]
        at, who = known[at], known[who]
        for other, part in _deal(_block_of(at, self.blocks), at, who, value):
            yield other, 1, tuple(part)
        yield block, 0, (ids, x, near, score, known[members])


def build_graph(nodes: DataFrame, kind: str) -> tuple[DataFrame, Layout]:
    """States of all blocks: near neighbours of each node (``_node, _vec``, written), best first."""
    n = nodes.count()
    depth = max(0, int(np.ceil(np.log2(max(1, n) / (LEAF * 0.75)))))
    sample = nodes.filter(hash_below(TREE_SAMPLE / max(1, n), F.col("_node"))).select("_node", "_vec").toPandas()
    if not len(sample):
        depth = 0
    dims = len(sample["_vec"].iloc[0]) // np.dtype(kind).itemsize if len(sample) else 1
    x = _matrix(list(sample.sort_values("_node")["_vec"]), kind) if len(sample) else np.zeros((0, 1), kind)
    # A leaf of the sample has about 20 vectors at least; larger leaves are split on all nodes.
    trees = _Trees(x, min(depth, max(0, int(np.log2(max(1, len(x)) / 20)))), dims)
    leaves = nodes.select("_node", "_vec").mapInArrow(_Leaves(trees, kind), "_group long, _node long, _vec binary")
    leaves = _split(leaves, nodes, trees.depth, kind)
    layout = Layout(nodes.sparkSession, n, dims * np.dtype(kind).itemsize, kind)
    dealt = leaves.repartition("_group").sortWithinPartitions("_group")
    found = dealt.mapInArrow(_Compare(LEAF_KEPT, layout), _MESSAGE)
    states = nodes.select("_node", "_vec").mapInArrow(_Nodes(layout), _MESSAGE)
    graph, _, _ = _staged(_stepped(_Merge(layout), layout.round, states, found), "graph")
    if n <= LEAF_KEPT + 1:
        return graph, layout
    # Neighbours only get better, so rounds end; log n of them are enough for most tables.
    for turn in range(2 * int(np.ceil(np.log2(n)))):
        steps = graph.mapInArrow(_Ask(layout, turn=turn), _MESSAGE)
        for step in (_Sample(layout, turn=turn), _Answer(layout), _Local(layout), _Merge(layout)):
            steps = _stepped(step, layout.round, steps)
        graph, changed, total = _staged(steps, "graph")
        if not total or changed < SETTLED * total:
            break
    return graph, layout


# The state of the queries of a block: their nodes (sorted) with vectors; the pool of each, ids with scores, best
# first (-inf where there are none), and which were expanded; pairs of query and node that have been scored.


class _Parts(_Step):
    """What a search needs of a graph: ``part`` 0 the vectors, 1 the neighbours of the nodes."""

    def step(self, block, state, messages):
        ids, x, near, score, _ = state[0]
        yield block, 0, (ids, x) if self.part == 0 else (ids, near, score > -np.inf)


class _Begin(_Step):
    """The first thing a query sees is itself."""

    def step(self, block, state, messages):
        if not messages:
            return
        ids, x = state[0]
        asked = np.unique(np.concatenate([m[0] for m in messages]))
        x = x[np.searchsorted(ids, asked)]
        near, score = np.zeros((len(asked), self.pool), np.int64), np.full((len(asked), self.pool), -np.inf)
        done = np.ones((len(asked), self.pool), bool)
        near[:, 0], score[:, 0], done[:, 0] = asked, (x.astype(np.float64) ** 2).sum(axis=1), False
        yield block, 0, (asked, x, near, score, done, np.arange(len(asked)), asked), len(asked), len(asked)


def _open(done: np.ndarray) -> np.ndarray:
    """Those of each pool that are expanded next: the best that were not."""
    return ~done & (np.cumsum(~done, axis=1) <= EXPANDED)


class _Expand(_Step):
    """Nodes of the pools are asked for their neighbours."""

    def step(self, block, state, messages):
        asked, _, near, _, done, _, _ = state[0]
        row, place = np.nonzero(_open(done))
        node = near[row, place]
        for other, part in _deal(_block_of(node, self.blocks), asked[row], node):
            yield other, 1, tuple(part)


class _Adjacent(_Step):
    def step(self, block, state, messages):
        if not messages:
            return
        ids, near, valid = state[0]
        query, node = (np.concatenate(c) for c in zip(*messages))
        at = np.searchsorted(ids, node)
        row, place = np.nonzero(valid[at])
        for other, part in _deal(_block_of(query[row], self.blocks), query[row], near[at[row], place]):
            yield other, 1, tuple(part)


class _Want(_Step):
    """Scores are asked for of the neighbours that a query has not met."""

    def step(self, block, state, messages):
        if not messages:
            return
        asked, x, _, _, _, row, node = state[0]
        query, found = (np.concatenate(c) for c in zip(*messages))
        at = np.r_[row, np.searchsorted(asked, query)]
        who = np.r_[node, found]
        order = np.lexsort((who, at))
        order = order[_first(at[order], who[order])]
        order = order[order >= len(row)]
        at, who = at[order], who[order]
        for other, (a, w) in _deal(_block_of(who, self.blocks), at, who):
            some, which = np.unique(a, return_inverse=True)
            yield other, 1, (asked[some], x[some], which.astype(np.int32), w)


class _Score(_Step):
    def step(self, block, state, messages):
        ids, x = state[0] if messages else ((), ())
        queries, nodes, values = [], [], []
        for asked, vectors, which, node in messages:
            vectors, at = vectors.astype(np.float64), np.searchsorted(ids, node)
            for start in range(0, len(at), 4096):
                some = slice(start, start + 4096)
                values.append((x[at[some]].astype(np.float64) * vectors[which[some]]).sum(axis=1))
            queries.append(asked[which])
            nodes.append(node)
        query, node, value = _concat(queries, np.int64), _concat(nodes, np.int64), _concat(values, np.float64)
        for other, part in _deal(_block_of(query, self.blocks), query, node, value):
            yield other, 1, tuple(part)


class _Pool(_Step):
    """The pools keep their best; those asked for in this step have been expanded. It tells how many are open."""

    def step(self, block, state, messages):
        asked, x, near, score, done, row, node = state[0]
        done = done | _open(done)
        if messages:
            query, found, value = (np.concatenate(c) for c in zip(*messages))
            query = np.searchsorted(asked, query)
            row, node = np.r_[row, query], np.r_[node, found]
            had = np.nonzero(score > -np.inf)
            at, who, value = np.r_[had[0], query], np.r_[near[had], found], np.r_[score[had], value]
            new = np.r_[done[had], np.zeros(len(query), bool)]
            order = np.lexsort((who, -value, at))
            rank = _rank(_first(at[order]))
            order, rank = order[rank < self.pool], rank[rank < self.pool]
            near, score, done = np.zeros_like(near), np.full_like(score, -np.inf), np.ones_like(done)
            near[at[order], rank], score[at[order], rank], done[at[order], rank] = who[order], value[order], new[order]
        yield block, 0, (asked, x, near, score, done, row, node), int((~done).sum()), len(asked)


class _Found:
    """mapInArrow over the states of queries: ``_query, _ids, _scores``."""

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, state, _ in _received(batches):
            asked, _, near, score, _, _, _ = state[0]
            valid = score > -np.inf
            ends = pa.array(np.r_[0, np.cumsum(valid.sum(axis=1))].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(asked), pa.ListArray.from_arrays(ends, pa.array(near[valid])), pa.ListArray.from_arrays(ends, pa.array(score[valid]))],
                ["_query", "_ids", "_scores"])


class _Queries:
    """mapInArrow over queries: their blocks get them."""

    def __init__(self, layout: Layout):
        self.blocks = layout.blocks

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            yield _rows([(to, 1, tuple(part)) for to, part in _deal(_block_of(ids, self.blocks), ids)])


def search_graph(queries: DataFrame, graph: DataFrame, layout: Layout, pool: int = POOL) -> DataFrame:
    """``_query, _ids, _scores``: best nodes of each query node, itself included, by greedy search.

    It ends when every node of every pool has been expanded; a node is expanded once by a
    query at most, so it does end.
    """
    vectors, links = (stage(graph.mapInArrow(_Parts(layout, part=k), _MESSAGE), "parts") for k in (0, 1))
    asked = queries.select("_query").mapInArrow(_Queries(layout), _MESSAGE)
    state, left, _ = _staged(_stepped(_Begin(layout, pool=pool), layout.search, vectors, asked), "pool")
    while left:
        near = _stepped(_Adjacent(layout), layout.search, links, state.mapInArrow(_Expand(layout), _MESSAGE))
        wanted = _stepped(_Want(layout), layout.search, state, near)
        scored = _stepped(_Score(layout), layout.search, vectors, wanted)
        state, left, _ = _staged(_stepped(_Pool(layout, pool=pool), layout.search, state, scored), "pool")
    return state.mapInArrow(_Found(), "_query long, _ids array<long>, _scores array<double>")


def nearest(
    embeddings: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each id of ``queries`` (``vec_id``) its ``k`` best others.

    Nearness is the inner product; ties go to the smaller id. Vectors that are null, zero
    or hold null or non-finite components take no part, as do rows without an id. A query
    gets all others if there are fewer than ``k``. Rows that repeat count once, and of
    several vectors of one id the one with the smallest bytes. Vectors take part whose
    number of components is the most frequent one (the larger of equally frequent ones).
    An empty table gives an empty result; other columns are not read.

    Every vector is in the graph; the trees are fitted on ``TREE_SAMPLE`` vectors, the
    search is not exhaustive, and its recall is measured in the tests on tables many
    times larger than a leaf.
    """
    single = dict(embeddings.dtypes)[vector_col] == "array<float>"
    kind = "<f4" if single else "<f8"
    rows = stage(embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(
        "array<float>" if single else "array<double>").alias("vector")).mapInArrow(
        _Pack(kind), "vec_id long, _vec binary").groupBy("vec_id").agg(F.min("_vec").alias("_vec")), "vectors")
    sizes = rows.groupBy(F.octet_length("_vec").alias("n")).agg(F.count("*").alias("rows"))
    common = sizes.orderBy(F.desc("rows"), F.desc("n")).first()
    rows = rows.filter(F.octet_length("_vec") == (common["n"] if common else 0))
    nodes = stage(rows.groupBy("_vec").agg(F.min("vec_id").alias("_node"), F.count("*").alias("_weight")), "nodes")
    order = Window.partitionBy("_vec").orderBy("vec_id")
    few = rows.withColumn("_k", F.row_number().over(order)).filter(F.col("_k") <= k + 1)
    members = stage(few.join(nodes, "_vec").select("_node", "vec_id"), "members")
    asked = rows.join(queries.select(F.col("vec_id").cast("long").alias("vec_id")).distinct(), "vec_id", "left_semi")
    asked = stage(join_groups(asked, nodes, ["_vec"], "_weight", ["vec_id"]).select(
        F.col("vec_id").alias("query_id"), F.col("_node").alias("_query")), "asked")
    nodes = nodes.drop("_weight")
    graph, layout = build_graph(nodes, kind)
    found = search_graph(asked.select("_query").distinct(), graph, layout, max(POOL, 4 * (k + 1)))
    best = found.select("_query", F.posexplode(F.arrays_zip("_ids", "_scores")).alias("_place", "_p")).filter(F.col("_place") <= k)
    ids = best.select("_query", F.col("_p._ids").alias("_node"), F.col("_p._scores").alias("score")).join(members, "_node")
    # k + 1 ids are enough for every query of a node, as each leaves out only its own.
    order = Window.partitionBy("_query").orderBy(F.desc("score"), "vec_id")
    ids = ids.withColumn("_k", F.row_number().over(order)).filter(F.col("_k") <= k + 1)
    found = stage(ids.groupBy("_query").agg(F.sort_array(F.collect_list(F.struct("_k", "vec_id", "score"))).alias("_found")), "found")
    mine = asked.join(found, "_query").withColumn("_found", F.slice(F.filter(
        "_found", lambda f: f["vec_id"] != F.col("query_id")), 1, k))
    return mine.select("query_id", F.posexplode("_found").alias("rank", "_f")).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("_f.vec_id").alias("vec_id"), F.col("_f.score").alias("score"))
