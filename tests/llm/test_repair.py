import hashlib
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import wearlog.llm.repair as repair
from brute import repairs
from wearlog.llm.repair import damaged, repair_summary, repaired_turns

TURNS = "conv_id long, turn long, role string, text string"
TEXTS = ["Yes.", "No!", "cut", "", " \n", "Why? \t", "also cut."]


def _sorted_back(rows):
    """Rows (role, text, fault) as a batch that arrives the last first."""
    rows = list(reversed(rows))
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32()]
    columns = [[1] * len(rows), list(range(len(rows), 0, -1)), *map(list, zip(*rows))]
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
    return pa.RecordBatch.from_arrays(arrays, names=["conv_id", "turn", "role", "text", "fault"])


rows_ = st.lists(
    st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "u"]), st.sampled_from("xyz"), st.integers(0, 3)),
    min_size=1, max_size=4,
)


@settings(max_examples=150, deadline=None)
@given(rows_, st.booleans())
def test_cheapest_edits_equal_all_ways(rows, spill):
    before = repair.SPILL_BYTES, repair.BATCH_ROWS
    repair.SPILL_BYTES, repair.BATCH_ROWS = (1, 1) if spill else before
    try:
        (found,) = [b.to_pylist()[0] for b in repair._summaries(iter([_sorted_back(rows)]))]
        turns = [r for b in repair._repaired(iter([_sorted_back(rows)])) for r in b.to_pylist()]
    finally:
        repair.SPILL_BYTES, repair.BATCH_ROWS = before
    cost, audit, text = repairs(rows)
    assert (found["cost"], found["audit"]) == (cost, audit)
    assert found["repaired_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert "\n".join(f"{r['role']}:{r['text']}" for r in turns) == text
    assert [r["place"] for r in turns] == list(range(len(turns)))


def _plain(rows):
    """rows: (turn, role, text) of one conversation."""
    rows = [(t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows]
    rows.sort(key=lambda row: (row[0] is not None, row[0] or 0, row[1], row[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        fault = 1 if not last else 2 if (role, text) in seen else 3 if last not in ".!?" else 0
        seen.add((role, text))
        faults.append((role, text, fault))
    cost, audit, text = repairs(faults)
    turns = {t for t, _, _ in rows if t is not None}
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    n = [sum(f == kind for *_, f in faults) for kind in (1, 2, 3)]
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(pair not in ("su", "ua", "au") for pair in pairs)
    return len(rows), gaps, *n, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def conversations():
    """With nulls in every column, ties, equal rows, gaps and unknown roles."""
    rng = random.Random(3)
    out = []
    for conv in [None, *range(40)]:
        for turn in range(rng.randint(1, 6)):
            turn = rng.choice([turn, turn, turn + 3, None])
            role = rng.choice(["user", "assistant", "system", "tool", None, ""])
            out.append((conv, turn, role, rng.choice([*TEXTS, None])))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_summaries_equal_the_plain_version(spark, monkeypatch, conversations, small):
    if small:
        monkeypatch.setattr(repair, "BATCH_ROWS", 2)
        monkeypatch.setattr(repair, "BATCH_BYTES", 1)
    frame = spark.createDataFrame([(*row, 1, "x") for row in conversations], f"{TURNS}, fault int, again string")
    ids = spark.createDataFrame([(5,), (99,), (99,), (None,)], "conv_id long")
    got = {r["conv_id"]: tuple(r)[1:] for r in repair_summary(frame.repartition(3), ids).collect()}
    groups = {conv: [row[1:] for row in conversations if row[0] == conv] for conv in {row[0] for row in conversations}}
    nothing = (0,) * 7 + ("", hashlib.sha256(b"").hexdigest())
    assert got == {conv: _plain(rows) for conv, rows in groups.items()} | {99: nothing}
    turns = repaired_turns(frame).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "role", "text"))).alias("l"))
    for r in turns.collect():
        text = "\n".join(f"{t['role']}:{t['text']}" for t in r["l"])
        assert hashlib.sha256(text.encode()).hexdigest() == got[r["conv_id"]][-1]


def test_damage(spark):
    frame = spark.createDataFrame([(1, i, "system", "A. b? c!") for i in range(6)] + [(1, 5, None, None)], TURNS)
    got = sorted(tuple(r) for r in damaged(frame, F.col("turn")).collect())
    whole = "A. b? c!"
    assert got == sorted([
        (1, 1, "system", ""), (1, 2, "system", "A b c"), (1, 3, "system", whole), (1, 3, "system", whole),
        (1, 4, "user", whole), (1, 5, "system", whole), (1, 5, " ", " "),
    ])


def test_a_giant_conversation_is_read_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(repair, "SPILL_BYTES", 1000)
    turns = spark.range(50001).selectExpr(
        "1L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "concat('text ', id, '.') AS text"
    )
    (row,) = repair_summary(turns.repartition(4)).collect()
    assert (row["rows"], row["cost"], row["audit"]) == (50001, 3, "K" * 50001 + "I")
    text = "\n".join(f"{('user', 'assistant')[i % 2]}:text {i}." for i in range(50001)) + "\nassistant:"
    assert row["repaired_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_no_rows(spark):
    empty = spark.createDataFrame([], TURNS)
    assert repair_summary(empty).collect() == [] and repaired_turns(empty).collect() == []
