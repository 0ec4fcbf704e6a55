"""Contiguous folds."""

import datetime
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wearlog.operators import folds
from wearlog.operators.folds import _starts, assign_folds, read_with_folds


def test_starts():
    assert _starts(10, 3) == [4, 7]
    assert _starts(7, 7) == [1, 2, 3, 4, 5, 6]
    for total, k in ((2, 3), (0, 2), (5, 1)):
        with pytest.raises(ValueError):
            _starts(total, k)


def by_position(keys, k):
    starts = _starts(len(keys), k)
    return {key: sum(i >= s for s in starts) for i, key in enumerate(sorted(keys))}


@pytest.mark.parametrize("k", [2, 3, 7, 10])
@pytest.mark.parametrize("n", [10, 1003])
def test_equal_parts_in_order(spark, k, n):
    rng = random.Random(n)
    # One engine owns a third of the rows.
    keys = [(rng.choice([1, 2, 3, 5, 5, 5]), c) for c in range(n)]
    df = spark.createDataFrame(rng.sample(keys, n), "e int, c int").repartition(5)
    got = {(r.e, r.c): r.fold for r in assign_folds(df, k, ["e", "c"]).collect()}
    assert got == by_position(keys, k)


def test_all_types_of_keys(spark):
    day = datetime.datetime(2024, 1, 1)
    rows = [
        (i / 3, f"s'{i}", day + datetime.timedelta(microseconds=i * 1_000_003)) for i in range(50)
    ]
    df = spark.createDataFrame(rows, "d double, s string, t timestamp_ntz").withColumns(
        {
            "f": F.col("d").cast("float"),
            "n": F.col("d").cast("decimal(20,9)"),
            "b": F.unhex(F.hex("s")),
            "l": F.timestamp_micros((F.col("d") * 3e15).cast("long")),
            "a": F.date_add(F.lit("2024-01-01").cast("date"), (F.col("d") * 3).cast("int")),
        }
    )
    for order in (["d"], ["s"], ["t"], ["t", "d", "s"], ["f"], ["n"], ["b"], ["l"], ["a"]):
        rows = assign_folds(df, 4, order).orderBy(*order).collect()
        assert [r.fold for r in rows] == [0] * 13 + [1] * 13 + [2] * 12 + [3] * 12
    with pytest.raises(ValueError, match="array"):
        assign_folds(df.withColumn("x", F.array("d")), 4, ["x"])


def test_times_around_a_repeated_hour(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 00:00 to 03:30 local time, with 01:00 to 02:00 twice.
        df = spark.range(8).selectExpr("id", "timestamp_micros(1730606400000000 + id * 1800000000) t")
        rows = assign_folds(df, 2, ["t"]).orderBy("id").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r.fold for r in rows] == [0] * 4 + [1] * 4


def test_odd_numbers(spark):
    values = [float("-inf"), -0.0, 1e-300, 0.1, float("inf"), *[float("nan")] * 3]
    rows = [(v, i) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "d double, i int")
    got = [r.fold for r in assign_folds(df, 4, ["d", "i"]).orderBy("i").collect()]
    assert got == [0, 0, 1, 1, 2, 2, 3, 3]
    nulls = spark.createDataFrame([(None, 1), (None, 2), (1, None), (1, 1)], "a int, b int")
    got = [r.fold for r in assign_folds(nulls, 4, ["a", "b"]).orderBy("a", "b").collect()]
    assert got == [0, 1, 2, 3]


def test_only_values_with_a_cut_are_looked_into(spark, monkeypatch):
    counted = []
    before = folds._values_at
    monkeypatch.setattr(
        folds, "_values_at", lambda rows, *a: (counted.append(rows.count()), before(rows, *a))[1]
    )
    df = spark.range(3000).selectExpr("id % 100 e", "id DIV 100 c", "id")
    sizes = Counter(r.fold for r in assign_folds(df, 3, ["e", "c", "id"]).collect())
    assert sizes == {0: 1000, 1: 1000, 2: 1000}
    # 100 engines, the 30 cycles of two of them, one row of two cycles.
    assert counted == [100, 60, 2]


@pytest.mark.parametrize("most", [1, 7])
def test_many_ranges(spark, monkeypatch, most):
    monkeypatch.setattr(folds, "KEYS_PER_TASK", most)
    keys = [(e, c) for e in range(5) for c in range(1 + 9 * (e == 2))]
    df = spark.createDataFrame(keys, "e int, c int")
    got = {(r.e, r.c): r.fold for r in assign_folds(df, 3, ["e", "c"]).collect()}
    assert got == by_position(keys, 3)


def test_ties_share_a_fold(spark):
    keys = [1] * 4 + [2] * 7 + [3] * 2 + [4] * 5
    df = spark.createDataFrame([(key,) for key in keys], "e int")
    got = {(r.e, r.fold) for r in assign_folds(df, 3, ["e"]).collect()}
    # Folds would begin at rows 6 and 12: within the twos and within the threes.
    assert got == {(1, 0), (2, 1), (3, 2), (4, 2)}


def test_whole_engines(spark):
    keys = [1] * 90 + [2] * 2 + [3] * 2 + [4] + [5]
    df = spark.createDataFrame([(key,) for key in keys], "e int")
    got = {(r.e, r.fold) for r in assign_folds(df, 3, ["e"], by_rows=False).collect()}
    assert got == {(1, 0), (2, 0), (3, 1), (4, 1), (5, 2)}


def test_a_tie_larger_than_a_fold_empties_one(spark):
    df = spark.createDataFrame([(key,) for key in [1] * 20 + [2] * 60 + [3] * 10], "e int")
    got = {(r.e, r.fold) for r in assign_folds(df, 3, ["e"]).collect()}
    assert got == {(1, 0), (2, 2), (3, 2)}


def test_more_folds_than_engines_is_an_error(spark):
    df = spark.createDataFrame([(key,) for key in [1] * 90 + [2] * 5], "e int")
    with pytest.raises(ValueError, match="cannot cut"):
        assign_folds(df, 3, ["e"], by_rows=False)


def test_the_table_itself_is_not_shuffled(spark):
    folded = assign_folds(spark.range(100), 3, ["id"])
    assert "Exchange" not in folded._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("files", [1, 6])
def test_folds_as_stored(spark, tmp_path, files):
    path = str(tmp_path / "t")
    spark.range(100).repartition(files).write.parquet(path)
    folded = read_with_folds(spark, path, 7)
    assert folded.columns == ["id", "fold"]
    plan = folded._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan
    sizes = Counter(r.fold for r in folded.collect())
    assert sizes == {0: 15, 1: 15, 2: 14, 3: 14, 4: 14, 5: 14, 6: 14}
    # Contiguous: in stored order the fold never falls.
    stored = (
        spark.read.parquet(path)
        .selectExpr("id", "_metadata.file_path f", "_metadata.row_index r")
        .join(folded, "id")
        .orderBy("f", "r")
    )
    order = [r.fold for r in stored.collect()]
    assert order == sorted(order)
