"""Rounds and searches of the neighbour graph: what moves between blocks, and what is compared."""

import numpy as np

from gristmill.llm import neighbours


def normal(n, dims=16, seed=1):
    return np.random.default_rng(seed).normal(size=(n, dims)).astype(np.float32)


def written(spark, x):
    return neighbours.stage(spark.createDataFrame([(i, v.tobytes()) for i, v in enumerate(x)], "_node long, _vec binary"), "nodes")


def neighbours_of(graph):
    found = {}
    for _, state, _ in neighbours._received(iter(graph.select("_block", "_kind", "_data").toArrow().to_batches())):
        ids, _, near, score, _ = state[0]
        found |= {int(i): [(int(w), float(v)) for w, v in zip(n, s) if v > -np.inf] for i, n, s in zip(ids, near, score)}
    return found


def test_many_nodes_are_one_row_between_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LEAF", 100)
    nodes = written(spark, normal(3000))
    moved = []
    stepped = neighbours._stepped
    monkeypatch.setattr(neighbours, "_stepped", lambda step, parts, *tables: moved.append(tables) or stepped(step, parts, *tables))
    graph, layout = neighbours.build_graph(nodes, "<f4")
    assert graph.count() == layout.blocks < 20
    # A round used to move a row for each of the 73 nodes that are compared for a node.
    assert all(t.count() <= 3 * layout.blocks ** 2 for t in moved[1])
    assert all(len(n) == neighbours.NEIGHBOURS for n in neighbours_of(graph).values())


def test_a_block_compares_all_pairs_once(spark):
    x = normal(30)
    layout = neighbours.Layout(spark, 30, 64, "<f4")
    scores = x @ x.T
    np.fill_diagonal(scores, -np.inf)
    # Everyone points to the ten nodes that are its next ids.
    near, score = np.zeros((30, neighbours.NEIGHBOURS), np.int64), np.full((30, neighbours.NEIGHBOURS), -np.inf, np.float32)
    near[:, :10] = (np.arange(30)[:, None] + np.arange(1, 11)) % 30
    score[:, :10] = np.take_along_axis(scores, near[:, :10], 1)
    state, none = (np.arange(30), x, near, score, None), np.zeros(0, np.int64)
    found = list(neighbours._Local(layout).step(0, [(state, none, none)], []))
    pairs = {(int(a), int(b)) for a, b in zip(*found[0][2][:2])}
    members = [{g, *((g + k) % 30 for k in range(1, 11))} for g in range(30)]
    assert pairs == {(a, b) for m in members for a in m for b in m if a != b}
    again = found[-1][2]
    assert [row[1] for row in neighbours._Local(layout).step(0, [(again, none, none)], [])] == [0]
    # A node that is new in one group is compared with all of that group, and only there.
    again[2][0, 10], again[3][0, 10] = 15, scores[0, 15]
    found = list(neighbours._Local(layout).step(0, [(again, none, none)], []))
    pairs = {(int(a), int(b)) for a, b in zip(*found[0][2][:2])}
    assert pairs == {p for b in range(11) for p in ((15, b), (b, 15))}


def test_neighbours_are_the_true_ones(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LEAF", 100)
    x = normal(2000, 8, 2)
    graph, _ = neighbours.build_graph(written(spark, x), "<f4")
    scores = x @ x.T
    np.fill_diagonal(scores, -np.inf)
    shares = []
    for i, found in neighbours_of(graph).items():
        ids = [w for w, _ in found]
        assert len(set(ids)) == len(ids) and i not in ids
        assert [s for _, s in found] == sorted((s for _, s in found), reverse=True)
        assert np.allclose([s for _, s in found], scores[i, ids], atol=1e-4)
        shares.append(len(set(ids) & set(np.argsort(-scores[i])[:neighbours.NEIGHBOURS].tolist())) / neighbours.NEIGHBOURS)
    assert np.mean(shares) >= 0.95


def test_packed_vectors_leave_out_what_is_not_usable(spark):
    rows = [(1, [1.0, -0.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [None, 2.0]), (6, [float("inf"), 1.0]), (None, [1.0, 1.0]), (8, [3.0])]
    frame = spark.createDataFrame(rows, "vec_id long, vector array<float>").coalesce(1)
    found = frame.mapInArrow(neighbours._Pack("<f4"), "vec_id long, _vec binary").collect()
    assert [(r.vec_id, bytes(r._vec)) for r in found] == [
        (1, np.array([1, 0], "<f4").tobytes()), (8, np.array([3], "<f4").tobytes())]
