"""Statistics that follow landed files."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from wearlog.operators.moments import (
    RANK_ERROR,
    current_moments,
    file_moments,
    land_moments,
    merged_moments,
    merged_quantiles,
    rank_bounds,
    stats_row,
    withdraw_files,
)
from wearlog.operators.scaling import fit_stats

SCHEMA = "file string, engine_id int, sensor_1 double, sensor_2 double, sensor_3 double"


def frame(spark, values, file):
    return spark.createDataFrame([(file, 1, v, 518.67, None if i % 2 else 1e9 + i) for i, v in enumerate(values)], SCHEMA)


@pytest.fixture()
def table(tmp_path):
    return str(tmp_path / "moments")


def found(spark, table):
    return {r["sensor"]: r for r in merged_moments(current_moments(spark, table)).collect()}


def test_merged_equal_those_of_the_whole_log(spark, table):
    rng = random.Random(1)
    files = {f: [rng.gauss(5, 3) for _ in range(n)] for f, n in (("a", 50), ("b", 1), ("c", 200))}
    land_moments(frame(spark, files["a"], "a"), table, 0)
    land_moments(frame(spark, [0.0, 100.0], "b"), table, 1)
    land_moments(frame(spark, files["c"], "c").unionByName(frame(spark, files["b"], "b")), table, 2)
    # Running a landing again changes nothing.
    land_moments(frame(spark, [7.0], "d"), table, 2)
    whole = frame(spark, files["a"], "a").unionByName(frame(spark, files["b"], "b")).unionByName(frame(spark, files["c"], "c"))
    sensors = ["sensor_1", "sensor_2", "sensor_3"]
    ours = stats_row(merged_moments(current_moments(spark, table)), sensors).first().asDict()
    for name, value in fit_stats(whole).first().asDict().items():
        assert ours[name] == pytest.approx(value, rel=1e-9), name
    assert ours["std_sensor_2"] == 0.0
    row = found(spark, table)["sensor_1"]
    every = [v for values in files.values() for v in values]
    assert (row["n"], row["least"], row["most"]) == (251, min(every), max(every))
    assert row["std"] == pytest.approx(statistics.stdev(every))


def test_withdrawn_files_and_single_rows(spark, table):
    land_moments(frame(spark, [1.0], "a"), table, 0)
    row = found(spark, table)
    assert row["sensor_1"]["std"] is None and row["sensor_3"]["mean"] == 1e9
    land_moments(frame(spark, [3.0, 5.0], "b"), table, 1)
    withdraw_files(spark, ["a", "never landed"], table, 2)
    assert found(spark, table)["sensor_1"]["mean"] == 4.0
    land_moments(frame(spark, [10.0], "a"), table, 3)
    assert found(spark, table)["sensor_1"]["mean"] == 6.0
    withdraw_files(spark, ["a", "b"], table, 4)
    assert found(spark, table) == {}


def test_sensors_without_readings(spark):
    rows = file_moments(spark.createDataFrame([("a", 1, None, 1.0, None)], SCHEMA)).filter("sensor <> 'sensor_2'").collect()
    assert [(r["n"], r["mean"], r["least"]) for r in rows] == [(0, None, None)] * 2
    assert file_moments(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("kind", ["uniform", "skewed", "few"])
def test_quantiles_of_merged_sketches(spark, table, kind):
    value = {"uniform": "rand(3)", "skewed": "pow(rand(3), 9)", "few": "CAST(floor(rand(3) * 4) AS DOUBLE)"}[kind]
    log = spark.range(60_000).selectExpr("concat('f', id % 7) AS file", f"{value} AS sensor_1").cache()
    for landing in range(3):
        land_moments(log.filter(F.col("file").substr(2, 1).cast("int") % 3 == landing), table, landing)
    shares = [0.001, 0.1, 0.5, 0.9, 0.999]
    quantiles = merged_quantiles(current_moments(spark, table), shares)
    ranks = rank_bounds(log, quantiles, ["sensor_1"]).collect()
    assert [r["share"] for r in sorted(ranks, key=lambda r: r["share"])] == shares
    assert all(r["below"] - RANK_ERROR <= r["share"] <= r["upto"] + RANK_ERROR for r in ranks)
    log.unpersist()
