import hashlib
import random

import pytest
from pyspark.sql import functions as F

import wearlog.llm.rows as rows
import wearlog.llm.trie as trie_module
from brute import trie as plain
from wearlog.llm.trie import numbered_turns, prefix_trie, with_ends_digest, with_heads
from wearlog.session import stored

TURNS = "conv_id long, turn long, role string, text string"
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _conversations(n, seed=1):
    """Conversations that share beginnings, some the same; null roles, texts and turn numbers."""
    rng = random.Random(seed)
    out = {}
    for conv in range(-3, n):
        like = rng.choice(list(out)) if out and rng.random() < 0.7 else None
        turns = out[like][: rng.randint(0, len(out[like]))] if like is not None else []
        turns = turns + [(rng.choice(["user", None]), rng.choice(["a", "b c", None, "d  e\nf"])) for _ in range(rng.randint(0, 3))]
        out[conv] = turns or [("user", "a")]
    return out


def _frame(spark, conversations):
    rows_ = [
        (conv, None if at == 0 and conv % 3 else at, *turn)
        for conv, turns in conversations.items() for at, turn in enumerate(turns)
    ]
    frame = spark.createDataFrame([(*row, 1, 2) for row in rows_], f"{TURNS}, pos int, p1 int")
    return frame.orderBy(F.rand(3)).repartition(3)


def _found(trie):
    return sorted((tuple(r) for r in with_ends_digest(trie).select(*NODE).collect()), key=repr)


def _expected(paths):
    named = {
        c: [((r or "", x or ""), len((x or "").split())) for r, x in turns] for c, turns in paths.items()
    }
    sha = lambda ids: hashlib.sha256(ids.encode()).hexdigest()
    return sorted(((*node[:-1], sha(node[-1])) for node in plain(named)), key=repr)


@pytest.mark.parametrize("shard_rows", [2, 20, 1 << 15])
@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, monkeypatch, shard_rows, small):
    monkeypatch.setattr(trie_module, "SHARD_ROWS", shard_rows)
    if small:
        monkeypatch.setattr(trie_module, "BATCH_ROWS", 3)
        monkeypatch.setattr(rows.measured, "__defaults__", (0,))
    paths = _conversations(60)
    numbered = stored(numbered_turns(_frame(spark, paths)), "numbered")
    ids = numbered.select("conv_id").distinct()
    assert _found(prefix_trie(numbered, ids)) == _expected(paths)


def test_lent_heads_and_conversations_without_turns(spark):
    paths = {0: [("user", "a"), ("user", "b")], 1: [("user", "x")], 2: [("user", "y")] * 4, 23: [("user", "z")]}
    numbered = stored(numbered_turns(_frame(spark, paths)), "numbered")
    ids = numbered.select("conv_id").distinct()
    family, heads = F.col("conv_id") - F.col("conv_id") % 20, F.col("conv_id") % 20 + 1
    rebuilt = with_heads(numbered, ids, family, heads, most=3)
    a, b, y = ("user", "a"), ("user", "b"), ("user", "y")
    # 23 has no family: its own turns after the first four are none.
    expected = {0: [a, b], 1: [a, b], 2: [a, b, y], 23: []}
    heads_ = {0: 1, 1: 2, 2: 3}
    expected = {c: [a, b][: heads_[c]] + paths[c][heads_[c]:] for c in heads_} | {23: []}
    assert _found(prefix_trie(rebuilt, ids)) == _expected(expected)


def test_awkward_tables(spark):
    schema = f"{TURNS}, k1 string, words int"
    turns = [(None, 0, "user", "lost", "k", 1), (5, None, None, None, "k", 1), (5, 1, "u", "x", "k", 1), (5, 1, "u", "x", "k", 1)]
    numbered = stored(numbered_turns(spark.createDataFrame(turns, schema)), "numbered")
    found = _found(prefix_trie(numbered, numbered.select("conv_id").distinct()))
    assert found == _expected({5: [("", ""), ("u", "x"), ("u", "x")]})
    none = numbered.limit(0)
    assert _found(prefix_trie(none, none.select("conv_id"))) == []


def test_a_conversation_larger_than_a_shard_is_a_path(spark, monkeypatch):
    monkeypatch.setattr(trie_module, "SHARD_ROWS", 500)
    turns = spark.range(3 * 4000).selectExpr(
        "id % 3 AS conv_id", "id DIV 3 AS turn", "'user' AS role", "concat('w ', IF(id % 3 = 2 AND id > 3000, id, id DIV 3)) AS text"
    )
    numbered = stored(numbered_turns(turns), "numbered")
    nodes = stored(with_ends_digest(prefix_trie(numbered, numbered.select("conv_id").distinct())), "nodes")
    # Two are the same; the third has 1000 turns in common with them.
    same = nodes.filter("depth > 0").groupBy("n_convs").count().collect()
    assert {r["n_convs"]: r["count"] for r in same} == {3: 1000, 2: 3000, 1: 3000}
    root = nodes.filter("depth = 0").first()
    assert (root["n_leaves"], root["n_children"], root["saved_tokens"]) == (2, 1, 2 * (2 * 1000 + 3000))
    assert nodes.filter("n_leaves > 1").count() == 1001


def test_a_common_first_turn_is_one_row_per_shard(spark, monkeypatch):
    monkeypatch.setattr(trie_module, "SHARD_ROWS", 1000)
    turns = spark.range(20000).selectExpr(
        "id DIV 2 AS conv_id", "id % 2 AS turn", "'user' AS role", "IF(id % 2 = 0, 'the same', concat('own ', id)) AS text"
    )
    numbered = stored(numbered_turns(turns), "numbered")
    trie = prefix_trie(numbered, numbered.select("conv_id").distinct())
    top = trie.nodes.filter("depth < 2").orderBy("depth").collect()
    assert [(r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"]) for r in top] == [
        (10000, 1, 10000, 2 * 9999), (10000, 10000, 10000, 2 * 9999),
    ]
    assert trie.pieces.count() == 0
