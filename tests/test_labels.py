"""Remaining-life labels and the join below them."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from wearlog.operators.attach import attach
from wearlog.operators.labels import engine_spans, label_from_truth, label_run_to_failure

# Broadcast everything; shuffle; shuffle, with engines above 40 rows split off, both ways.
LIMITS = [
    {},
    {"broadcast_bytes": 0},
    {"broadcast_bytes": 0, "hot_rows": 40},
    {"broadcast_bytes": 400, "hot_rows": 40},
]


@pytest.fixture(scope="module")
def log(spark):
    """Engines of 1 to 10 rows, one that owns most rows, one without id, some repeated cycles."""
    rng = random.Random(3)
    rows = [(e, rng.randint(1, 30)) for e in range(1, 60) for _ in range(rng.randint(1, 10))]
    rows += [(99, c) for c in range(400)] + [(99, 399)] * 100 + [(None, 4), (None, 9)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "engine_id int, cycle int"), rows


def last_cycles(rows):
    last = defaultdict(int)
    for engine, cycle in rows:
        last[engine] = max(last[engine], cycle)
    return last


@pytest.mark.parametrize("limits", LIMITS)
def test_run_to_failure(log, limits):
    df, rows = log
    last = last_cycles(rows)
    got = Counter(tuple(r) for r in label_run_to_failure(df, **limits).collect())
    assert got == Counter((e, c, last[e] - c) for e, c in rows)


@pytest.mark.parametrize("limits", LIMITS)
def test_truth_labels_every_copy_of_the_last_row_only(spark, log, limits):
    df, rows = log
    truth = {e: 1000 + e for e in range(1, 100) if e % 3}
    truth_df = spark.createDataFrame(list(truth.items()), "engine_id int, RUL int")
    last = last_cycles(rows)
    got = label_from_truth(df, truth_df, **limits)
    assert got.columns == ["engine_id", "cycle", "RUL"]
    assert Counter(tuple(r) for r in got.collect()) == Counter(
        (e, c, truth.get(e) if c == last[e] else None) for e, c in rows
    )


def test_label_type(log):
    assert dict(label_run_to_failure(log[0]).dtypes)["RUL"] == "int"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_tables_are_broadcast_and_rows_not_shuffled(log):
    text = plan(label_run_to_failure(log[0]))
    assert "BroadcastHashJoin" in text
    assert "hashpartitioning" not in text and "Window" not in text


def test_large_tables_are_not_broadcast(log):
    text = plan(label_run_to_failure(log[0], broadcast_bytes=0))
    assert "SortMergeJoin" in text and "Broadcast" not in text


@pytest.mark.parametrize("broadcast_bytes", [0, 400])
def test_only_hot_keys_are_broadcast(log, broadcast_bytes):
    text = plan(label_run_to_failure(log[0], broadcast_bytes=broadcast_bytes, hot_rows=40))
    assert "LeftAnti" in text and "Union" in text
    assert text.count("SortMergeJoin") == 1 and text.count("BroadcastHashJoin") == 2


def test_spans_combine_before_the_shuffle(log):
    text = plan(engine_spans(log[0]))
    assert text.count("HashAggregate") == 2 and "partial_max" in text


def test_attach_keeps_rows_without_a_match(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    side = spark.createDataFrame([(1, 10.0, 1)], "k int, x double, n_rows long")
    got = attach(rows, side, "k").orderBy("k")
    assert [tuple(r) for r in got.collect()] == [(1, "a", 10.0), (2, "b", None)]
    empty = attach(rows, side.filter(F.lit(False)), "k").orderBy("k")
    assert [tuple(r) for r in empty.collect()] == [(1, "a", None), (2, "b", None)]


@pytest.mark.parametrize("limits", LIMITS)
def test_attach_on_two_keys_of_which_one_is_text(spark, limits):
    rows = [(k % 7 or None, f"t{k % 3}", k) for k in range(200)]
    rows += [(1, "hot", k) for k in range(300)]
    df = spark.createDataFrame(rows, "k int, t string, v int")
    side = df.groupBy("k", "t").agg(F.max("v").alias("top"), F.count(F.lit(1)).alias("n_rows"))
    top = {}
    for k, t, v in rows:
        top[k, t] = max(v, top.get((k, t), v))
    got = Counter(tuple(r) for r in attach(df, side, "k", "t", **limits).collect())
    assert got == Counter((k, t, v, top[k, t]) for k, t, v in rows)


def test_attach_refuses_tables_of_unknown_size(spark):
    rows = spark.createDataFrame([(1,)], "k int")
    side = spark.createDataFrame([(1, [1], 1)], "k int, x array<int>, n_rows long")
    with pytest.raises(ValueError, match="no size known"):
        attach(rows, side, "k")


@pytest.mark.parametrize(
    "kind, values",
    [("timestamp", ["2024-01-01", "2024-01-02", None]), ("decimal(38,5)", ["1.5", "-2", None]), ("binary", ["ab", "", None])],
)
@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_keys_of_any_plain_type(spark, kind, values, broadcast_bytes):
    rows = spark.createDataFrame([(v, i) for i, v in enumerate(values * 3)], "k string, v int")
    rows = rows.withColumn("k", F.col("k").cast(kind))
    side = rows.groupBy("k").agg(F.max("v").alias("top"), F.count(F.lit(1)).alias("n_rows"))
    got = attach(rows, side, "k", broadcast_bytes=broadcast_bytes, hot_rows=2).select("v", "top")
    assert sorted(map(tuple, got.collect())) == [(i, 6 + i % 3) for i in range(9)]


def test_a_key_with_several_rows_is_an_error(spark, log):
    truth = spark.createDataFrame([(1, 5), (2, 6), (1, 7)], "engine_id int, RUL int")
    with pytest.raises(ValueError, match="keys"):
        label_from_truth(log[0], truth)
    side = spark.createDataFrame([(None, 1.0, 1), (None, 2.0, 1)], "k int, x double, n_rows long")
    with pytest.raises(ValueError, match="2 rows for 1 keys"):
        attach(spark.createDataFrame([(1,)], "k int"), side, "k")


def test_columns_of_the_log_are_kept(spark, log):
    own = log[0].withColumn("n_rows", F.lit("mine")).withColumn("last_cycle", F.lit(-1))
    truth = spark.createDataFrame([(1, 5)], "engine_id int, RUL int")
    for labelled in (label_run_to_failure(own), label_from_truth(own, truth)):
        assert labelled.columns == ["engine_id", "cycle", "n_rows", "last_cycle", "RUL"]
        assert {tuple(r) for r in labelled.select("n_rows", "last_cycle").collect()} == {("mine", -1)}
    side = spark.createDataFrame([(1, "b", 1)], "k int, v string, n_rows long")
    with pytest.raises(ValueError, match="both tables"):
        attach(spark.createDataFrame([(1, "a")], "k int, v string"), side, "k")
