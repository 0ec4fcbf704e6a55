import random

import numpy as np
import pytest

import wearlog.llm.topk as topk
from wearlog.llm.topk import BallTree, Search, top_k


def _plain(rows, queries, k):
    out = []
    asked = {}
    for i, v in sorted(queries):
        asked.setdefault(i, v)
    for q, v in asked.items():
        scored = [
            (-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q and len(w) == len(v)
        ]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def _found(spark, rows, queries, k=5):
    kind = "vec_id long, vector array<double>"
    found = top_k(spark.createDataFrame(rows, kind).repartition(3), spark.createDataFrame(queries, kind), k)
    return sorted((r["query_id"], r["rank"], r["id"], r["score"]) for r in found.collect())


@pytest.mark.parametrize("shard, part, leaf, roots", [(8192, 256, 64, 1024), (40, 3, 4, 4)])
def test_equals_brute_force(spark, monkeypatch, shard, part, leaf, roots):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard)
    monkeypatch.setattr(topk, "SLICE_ROWS", part)
    monkeypatch.setattr(topk, "MOST_PER_TASK", 2 * part)
    monkeypatch.setattr(topk, "LEAF_ROWS", leaf)
    monkeypatch.setattr(topk, "PIECE_ROOTS", roots)
    rng = random.Random(7)
    centers = [[rng.randint(-90, 90) for _ in range(6)] for _ in range(5)]
    rows = [
        (i, [float(c + rng.randint(-20, 20)) for c in rng.choice(centers)]) for i in range(400)
    ]
    # Many rows with the same vector, and so with the same score.
    rows += [(i, [40.0] * 6) for i in range(400, 520)]
    queries = [row for row in rows if row[0] % 50 == 0]
    assert _found(spark, rows, queries) == _plain(rows, queries, 5)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (2, [3.0, 0.0]), (3, [0.0, 0.0]), (4, [1.0]), (5, [2.0])]
    bad = [(6, None), (7, []), (8, [1.0, None]), (9, [nan, 1.0]), (10, [1.0, -inf]), (None, [1.0, 1.0])]
    rows = good + bad
    assert _found(spark, rows, rows, 5) == _plain(good, good, 5)
    assert _found(spark, rows, [(1, [1.0, 2.0])], 1) == [(1, 1, 2, 5.0)]
    assert _found(spark, bad, good) == [] and _found(spark, good, bad) == []
    single = [(1, [1.0, 2.0])]
    assert _found(spark, single, single) == []


@pytest.fixture
def meetings(monkeypatch):
    """The holders and the number of askers of every round."""
    seen = {}
    meet = topk._meet

    def watched(holders, askers, work, schema, name):
        seen[name] = (holders, askers.count())
        return meet(holders, askers, work, schema, name)

    monkeypatch.setattr(topk, "_meet", watched)
    return seen


def test_repeated_rows_fill_no_shard(spark, monkeypatch, meetings):
    monkeypatch.setattr(topk, "SHARD_ROWS", 50)
    rows = [(7, [1000.0, 1000.0])] * 200 + [(i, [float(i % 9), float(i % 7)]) for i in range(100, 500)]
    queries = [(i, [1.0, 1.0]) for i in range(1000, 1010)]
    assert _found(spark, rows, queries) == _plain(rows, queries, 5)
    sizes = [len(t["ids"]) // 8 for t in meetings["second"][0].select("ids").collect()]
    assert sum(sizes) == 600 and max(sizes) <= 100


def test_shards_below_the_shared_score_are_not_visited(spark, monkeypatch, meetings):
    monkeypatch.setattr(topk, "SHARD_ROWS", 30)
    rows = [(i, [float(i), 1.0]) for i in range(600)]
    queries = [(2000, [1.0, 0.0])]
    assert _found(spark, rows, queries) == _plain(rows, queries, 5)
    assert meetings["first"][1] == 1 and meetings["second"][1] <= 3


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(2)
    vectors = np.floor(rng.normal(0, 40, (3000, 8)) + rng.choice([-400, 0, 400], (3000, 1)))
    tree = BallTree.build(np.arange(3000), vectors)
    queries = vectors[::100]
    norms = np.sqrt((queries**2).sum(axis=1))
    for node, (start, end, _, _) in enumerate(tree.nodes.tolist()):
        scores = queries @ tree.vectors[start:end].T
        assert (tree.bounds(node, queries, norms) >= scores.max(axis=1)).all()
    search = Search(np.arange(0, 3000, 100), queries, 5, np.full(30, -np.inf))
    visited = []
    leaf = search.leaf
    search.leaf = lambda t, n, who: (visited.append(len(who)), leaf(t, n, who))
    search.run(tree)
    leaves = (tree.nodes[:, 2] == 0).sum()
    assert sum(visited) < 0.5 * leaves * 30
