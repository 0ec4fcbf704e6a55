"""Landing text: fields, numbers, rejects, headers, line numbers."""

import random
import re

import pytest
from log_lines import log_line
from pyspark.sql import functions as F

from wearlog.functions.text import (
    all_finite,
    fields,
    numbers,
    quick_fields,
    to_numbers,
    utc_text,
    without_gaps,
)
from wearlog.plans.layers import land
from wearlog.schema import LOG_COLUMNS
from wearlog.sources.landing import (
    good_rows,
    land_log,
    number_lines,
    parse_lines,
    parse_truth,
    rejected_lines,
    rejected_truth,
)


def lines_of(spark, *lines):
    rows = [(line, "f.txt", 0, i) for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, "value string, file string, block long, id long")


@pytest.mark.parametrize(
    "line",
    [
        "1 2 3",
        " 1 2 3 ",
        "1   2 3  ",
        "\t1\t2 3",
        '"1 2 3"',
        '" 1 2" 3',
        ' "\t1 2 3"\r',
        "1\x0b2\f3",
    ],
)
def test_white_space_and_quotes_never_shift_fields(spark, line):
    df = lines_of(spark, line).select(fields(F.col("value")).alias("f"))
    assert df.first()["f"] == ["1", "2", "3"]


def test_fields_of_random_lines(spark):
    rng = random.Random(11)
    lines = ["".join(rng.choices('1a. \t\x0b\f"é;', k=rng.randint(0, 25))) for _ in range(2000)]
    df = lines_of(spark, *lines).select("value", fields(F.col("value")).alias("f"))
    for row in df.collect():
        bare = row.value.replace('"', "").strip(" \t\x0b\f")
        assert row.f == re.split(r"[ \t\x0b\f]+", bare), row.value


def test_numbers_do_not_depend_on_the_quick_way(spark):
    rng = random.Random(12)
    parts = ["1", "2.5", "-3e2", "x", "NaN", "", " ", " ", " ", "  ", "\t", '"', "\x0b"]
    lines = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(3000)]
    lines += ["1 2  3", "1 2 3 ", '" 1 2 3', "1 \t2 3", "1 2\t 3", "1  2", "1 2 3 4", "1\t2 3 4"]
    value = F.col("value")
    df = lines_of(spark, *lines).select(
        "value",
        without_gaps(value, numbers(value, quick_fields(value), 3), 3).alias("got"),
        to_numbers(fields(value)).alias("expected"),
    )
    assert df.filter("size(got) = 3").count() > 100
    assert df.filter(~F.col("got").eqNullSafe(F.col("expected"))).collect() == []


def test_all_finite(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1.0, -2.0), (-0.0, 0.0), (1.0, nan), (inf, 1.0), (-inf, inf), (None, 1.0), (None, nan)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = [r[0] for r in df.select(all_finite([F.col("a"), F.col("b")])).collect()]
    assert got == [True, True, False, False, False, None, None]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_lines_are_rejected_with_a_reason(spark, ansi):
    good = log_line(7, 3, 1)
    cases = {
        good: None,
        good.replace("7 3", "7.0 3.0", 1): None,
        good.replace("7 3", "70e-1 +3", 1): None,
        good.rsplit(" ", 1)[0]: "field_count",
        good + " 5": "field_count",
        good.rsplit(" ", 1)[0] + " abc": "not_a_number",
        good.rsplit(" ", 1)[0] + " NaN": "not_finite",
        good.rsplit(" ", 1)[0] + " Infinity": "not_finite",
        good.rsplit(" ", 1)[0] + " -inf": "not_finite",
        good.rsplit(" ", 1)[0] + " 1d": "not_a_number",
        good.rsplit(" ", 1)[0] + " 2F": "not_a_number",
        good.rsplit(" ", 1)[0] + " 0x1p3": "not_a_number",
        '"' + good.rsplit(" ", 1)[0] + '\t 3f"': "not_a_number",
        "99999999999 " + good.split(" ", 1)[1]: "not_an_integer",
        "1.7 " + good.split(" ", 1)[1]: "not_an_integer",
        "-0.5 " + good.split(" ", 1)[1]: "not_an_integer",
        good.replace("7 3", "7 2.9", 1): "not_an_integer",
    }
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        parsed = parse_lines(lines_of(spark, *cases, "", "  ", '""'))
        rejected = {r["line"]: r["reject_reason"] for r in rejected_lines(parsed).collect()}
        rows = good_rows(parsed).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert rejected == {line: reason for line, reason in cases.items() if reason}
    assert len(rows) == 3 and rows[0] == rows[1] == rows[2]
    assert rows[0].asDict() == dict(
        zip(LOG_COLUMNS, [7, 3, 0.0, 0.0, 0.0, *[float(i) for i in range(1, 22)]])
    )


def scans_of_text(spark, run):
    """How many scans of text files the executed plans of ``run`` have."""
    store = spark._jsparkSession.sharedState().statusStore()

    def executions():
        """By number, as Spark forgets the oldest of many."""
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        runs = store.executionsList()
        return {runs.apply(i).executionId(): runs.apply(i) for i in range(runs.size())}

    before = max(executions(), default=-1)
    run()
    seen = [own.physicalPlanDescription() for number, own in executions().items() if number > before]
    return sum(text.count("Scan text ") - text.count(") Scan text ") for text in seen)


def test_header_is_dropped_once_per_file(spark, tmp_path, small_splits):
    expected = []
    for name, n in (("a", 40), ("b", 1), ("c", 25)):
        lines = [log_line(1, i + 1, i) for i in range(n)]
        (tmp_path / f"{name}.txt").write_text("\n".join(lines) + "\n")
        expected += range(2, n + 1)
    good = good_rows(land_log(spark, str(tmp_path)))
    assert sorted(r.cycle for r in good.collect()) == sorted(expected)
    assert good_rows(land_log(spark, str(tmp_path), skip_header=False)).count() == 66


def test_a_header_is_the_first_line_even_if_blank(spark, tmp_path):
    lines = [log_line(1, cycle, cycle) for cycle in (1, 2)]
    for name, first in (("blank", ""), ("spaces", "  \t"), ("head", "id cycle"), ("bad", "1 x")):
        (tmp_path / f"{name}.txt").write_text("\n".join([first, *lines, "", lines[0]]) + "\n")
    parsed = land_log(spark, str(tmp_path))
    assert sorted(r.cycle for r in good_rows(parsed).collect()) == [1] * 8 + [2] * 4
    assert rejected_lines(parsed).collect() == []
    numbered = number_lines(spark, str(tmp_path))
    assert numbered.count() == 16


def test_text_is_read_once_for_good_rows_and_rejects(spark, landing, tmp_path):
    (landing / "train_FD001.txt").write_text("\n".join(["head", log_line(1, 1, 1), "bad"]) + "\n")

    def run():
        parsed = land_log(spark, str(landing / "train_FD001.txt"))
        good_rows(parsed).write.parquet(str(tmp_path / "good"))
        rejected_lines(parsed).write.parquet(str(tmp_path / "bad"))

    assert scans_of_text(spark, run) == 1
    parsed = land_log(spark, str(landing / "train_FD001.txt"), skip_header=False)
    plan = rejected_lines(parsed)._jdf.queryExecution().executedPlan().toString()
    assert "Scan text" not in plan and "IsNotNull(reject_reason)" in plan


def test_lines_are_left_alone(spark, tmp_path):
    odd = ["a\u0001b", "\0q r\0 s", '"', "\\", "#c", "é\u2028k", 'a "b" c', "x" * 100_000]
    for i, end in enumerate(("\n", "\r\n")):
        (tmp_path / f"{i}.txt").write_bytes(end.join(["header", *odd]).encode())
        rejects = rejected_lines(land_log(spark, str(tmp_path / f"{i}.txt"))).collect()
        assert sorted(r.line for r in rejects) == sorted(line for line in odd if line != '"')


@pytest.mark.parametrize("skip_header", [True, False])
def test_line_numbers_run_over_splits_and_files(spark, tmp_path, small_splits, skip_header):
    rng = random.Random(5)
    expected = []
    for name, n in (("a", 700), ("b", 3), ("c", 1200)):
        lines = [f"{name}{i}" + "x" * rng.randint(0, 40) for i in range(n)]
        (tmp_path / f"{name}.txt").write_text("\n".join(lines) + "\n")
        expected += lines[1:] if skip_header else lines
    numbered = number_lines(spark, str(tmp_path), skip_header).collect()
    assert sorted((r.line_no, r.value) for r in numbered) == list(enumerate(expected, 1))


def test_truth_lines_keep_their_place(spark, tmp_path):
    (tmp_path / "t.txt").write_text('head\n112 \n\n"98"\nabc\n69.0\n69.7\n7d\n')
    numbered = number_lines(spark, str(tmp_path))
    assert sorted(tuple(r) for r in parse_truth(numbered).collect()) == [
        (1, 112), (2, None), (3, 98), (4, None), (5, 69), (6, None), (7, None),
    ]
    rejects = rejected_truth(numbered).collect()
    assert sorted(tuple(r) for r in rejects) == [(2, ""), (4, "abc"), (6, "69.7"), (7, "7d")]


def test_headerless_truth(spark, tmp_path):
    (tmp_path / "t.txt").write_text("112 \n98 \n69 \n")
    truth = parse_truth(number_lines(spark, str(tmp_path), skip_header=False))
    assert sorted(tuple(r) for r in truth.collect()) == [(1, 112), (2, 98), (3, 69)]
    shifted = parse_truth(number_lines(spark, str(tmp_path)))
    assert sorted(tuple(r) for r in shifted.collect()) == [(1, 98), (2, 69)]


def test_warning_when_a_header_looks_like_data(spark, tmp_path, caplog):
    for name, first in (("a_head", "RUL"), ("b_data", "112 "), ("c_data", "7")):
        (tmp_path / f"{name}.txt").write_text(f"{first}\n98\n")
    number_lines(spark, str(tmp_path))
    assert "2 files" in caplog.text and "b_data" in caplog.text and "skip_header" in caplog.text
    caplog.clear()
    number_lines(spark, str(tmp_path / "a_head.txt"))
    assert caplog.text == ""
    (tmp_path / "log").mkdir()
    for name, first in (("a", "engine cycle"), ("b", log_line(1, 1, 1))):
        (tmp_path / "log" / f"{name}.txt").write_text(f"{first}\n{log_line(1, 2, 1)}\n")
    land_log(spark, str(tmp_path / "log"), skip_header=False)
    assert caplog.text == ""
    land_log(spark, str(tmp_path / "log"))
    assert "1 files" in caplog.text and "log/b.txt" in caplog.text


def test_bronze_tables(spark, landing, tmp_path):
    lines = [log_line(1, 1, 1), log_line(1, 2, 1), "1 3 broken", "", log_line(1, 4, 1)]
    (landing / "train_FD001.txt").write_text("\n".join(lines) + "\n")
    bronze = str(tmp_path / "bronze")
    land(spark, str(landing), bronze)
    train = spark.read.parquet(f"{bronze}/train")
    assert train.columns == LOG_COLUMNS
    assert [f.dataType.simpleString() for f in train.schema] == ["int"] * 2 + ["double"] * 24
    assert sorted(r.cycle for r in train.collect()) == [2, 4]
    assert spark.read.parquet(f"{bronze}/test").columns == LOG_COLUMNS
    assert spark.read.parquet(f"{bronze}/test").count() == 2
    rul = spark.read.parquet(f"{bronze}/RUL")
    assert rul.columns == ["RUL"] and [r.RUL for r in rul.collect()] == [88]
    assert [tuple(r) for r in spark.read.parquet(f"{bronze}/truth").collect()] == [(1, 88)]
    rejects = spark.read.parquet(f"{bronze}/rejects/train")
    (reject,) = rejects.collect()
    assert (reject.line, reject.reject_reason) == ("1 3 broken", "field_count")
    assert reject.file.endswith("/train_FD001.txt")
    assert spark.read.parquet(f"{bronze}/rejects/test").count() == 0
    assert spark.read.parquet(f"{bronze}/rejects/truth").count() == 0


def test_rejects_of_many_files(spark, tmp_path):
    folder = tmp_path / "land ing" / "train_FD001.txt"
    folder.mkdir(parents=True)
    for name, lines in {
        "clean": ["head", log_line(1, 1, 1)],
        "one bad+%20": ["head", "oops", log_line(1, 2, 1)],
        "two": ["head", log_line(1, 3, 1) + " 4", log_line(1, 3, 1), "", "x"],
    }.items():
        (folder / f"{name}.txt").write_text("\n".join(lines) + "\n")
    land(spark, str(folder.parent), str(tmp_path / "bronze"), parts=("train",))
    rejects = spark.read.parquet(str(tmp_path / "bronze" / "rejects" / "train"))
    expected = ["oops", "x", log_line(1, 3, 1) + " 4"]
    assert sorted(r.line for r in rejects.collect()) == sorted(expected)
    assert spark.read.parquet(str(tmp_path / "bronze" / "train")).count() == 3


def test_utc_text(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        df = spark.sql("SELECT timestamp'2024-02-01 08:59:59' AS t")
        assert df.select(utc_text(F.col("t"))).first()[0] == "2024-01-31T23:59:59Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
