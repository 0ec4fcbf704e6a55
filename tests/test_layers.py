"""The batch run from text to gold."""

from pathlib import Path

import pytest
from log_lines import log_line

from wearlog.operators.features import gold_projection
from wearlog.plans.layers import land, previews, project, refine, run_batch
from wearlog.schema import KEYS, LABEL, SENSORS, SETTINGS
from wearlog.sources.tables import append_table, preview, read_table


@pytest.fixture()
def out(spark, landing, tmp_path):
    run_batch(spark, str(landing), str(tmp_path))
    return tmp_path


def test_silver(spark, out):
    half = 2**-0.5
    for split, labels in (("train", [1, 0]), ("test", [None, 88])):
        rows = spark.read.parquet(f"{out}/silver/{split}").orderBy("cycle").collect()
        assert [(r.engine_id, r.cycle, r.RUL) for r in rows] == [
            (1, 2, labels[0]),
            (1, 3, labels[1]),
        ]
        assert {r[s] for r in rows for s in SETTINGS} == {0.0}
        for s in SENSORS:
            assert [r[s] for r in rows] == pytest.approx([-half, half])


def test_gold_columns_and_preview(spark, landing, out):
    for split in ("train", "test"):
        gold = spark.read.parquet(f"{out}/gold/{split}")
        assert gold.columns == [*SENSORS, LABEL] and gold.count() == 2
    first = run_batch(spark, str(landing), str(out), keep_keys=True)
    assert first["train"].count() == 2 and first["test"].columns == [*KEYS, *SENSORS, LABEL]
    # Every table below gold is shown, whoever wrote it.
    spark.range(9).write.parquet(f"{out}/gold/extra")
    shown = previews(spark, f"{out}/gold", n=3)
    assert list(shown) == ["extra", "test", "train"] and shown["extra"].count() == 3


def test_no_intermediate_table_is_left(spark, landing, tmp_path):
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(folder.iterdir())
    run_batch(spark, str(landing), str(tmp_path))
    assert set(folder.iterdir()) == before


def test_two_lines_leave_one_row_in_raw_units(spark, landing, tmp_path):
    for split in ("train", "test"):
        lines = [log_line(1, 1, 1), log_line(1, 2, 1)]
        (landing / f"{split}_FD001.txt").write_text("\n".join(lines))
    run_batch(spark, str(landing), str(tmp_path))
    row = spark.read.parquet(f"{tmp_path}/gold/train").first()
    assert row == (*[float(i) for i in range(1, 22)], 0)


def test_headerless_truth_pairs_by_position(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    log = [log_line(e, c, e * c) for e in (1, 2, 3) for c in range(1, 4 + e)]
    (landing / "train_FD001.txt").write_text("\n".join(log) + "\n")
    (landing / "test_FD001.txt").write_text("\n".join(log) + "\n")
    (landing / "RUL_FD001.txt").write_text("112 \n98 \n69 \n")

    def labels(out, skip_header):
        run_batch(spark, str(landing), str(out), skip_header=skip_header)
        test = spark.read.parquet(f"{out}/silver/test")
        return {r.engine_id: r.RUL for r in test.collect() if r.cycle == 3 + r.engine_id}

    assert labels(tmp_path / "right", False) == {1: 112, 2: 98, 3: 69}
    assert labels(tmp_path / "shifted", True) == {1: 98, 2: 69, 3: None}


def test_stages_can_run_again_and_alone(spark, landing, tmp_path):
    for _ in range(2):
        land(spark, str(landing), f"{tmp_path}/b")
        refine(spark, f"{tmp_path}/b", f"{tmp_path}/s")
        project(spark, f"{tmp_path}/s", f"{tmp_path}/g")
    assert spark.read.parquet(f"{tmp_path}/g/train").count() == 2


def test_silver_is_the_same_without_broadcast(spark, out):
    refine(spark, f"{out}/bronze", f"{out}/other", broadcast_bytes=0)
    for split in ("train", "test"):
        one, other = (spark.read.parquet(f"{out}/{d}/{split}") for d in ("silver", "other"))
        assert one.exceptAll(other).isEmpty() and one.count() == other.count()


def test_missing_label_is_null(spark):
    df = spark.createDataFrame([(1, 2, 3.0)], "engine_id int, cycle int, sensor_1 double")
    assert gold_projection(df).collect() == [(3.0, None)]
    assert gold_projection(df, keep_keys=True).columns == ["engine_id", "cycle", "sensor_1", "RUL"]


def test_appends_may_add_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    append_table(spark.sql("SELECT 1 AS a"), path)
    append_table(spark.sql("SELECT 2 AS a, 'x' AS b"), path)
    merged = read_table(spark, path, merge_schema=True).orderBy("a")
    assert [tuple(r) for r in merged.collect()] == [(1, None), (2, "x")]


def test_preview_order(spark):
    assert [r.id for r in preview(spark.range(100), order=["id"]).collect()] == [0, 1, 2, 3, 4]


def test_gold_reads_no_other_columns(spark, out):
    gold = gold_projection(read_table(spark, f"{out}/silver/train")).select("sensor_2", "RUL")
    plan = gold._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<sensor_2:double,RUL:int>" in plan
