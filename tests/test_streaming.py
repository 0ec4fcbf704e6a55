"""Events to rows, rejects, predictions and alerts."""

import json
import random
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wearlog.operators.forest import PREDICTION, fit_forest
from wearlog.operators.scaling import fit_stats
from wearlog.schema import LABEL, SENSORS
from wearlog.streaming import jobs
from wearlog.streaming.events import (
    alert_messages,
    low_life,
    parse_events,
    read_events,
    rejected_events,
    sensor_rows,
)

NOW = {"available_now": True}


def event(**changes):
    return json.dumps({**{s: float(i) for i, s in enumerate(SENSORS, 1)}, **changes})


BAD = [
    "bad",
    "{}",
    "[1, 2]",
    event(sensor_3="text"),
    event(sensor_4=None),
    event(sensor_5=float("nan")),
    event()[:-1],
    event() + event(),
    event() + " garbage",
    event() + "}",
    event() + ',"end":1',
    event() + "," + event(),
    event() + '],"end":1,"event":[' + event(),
]


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path


def drop(folder, name, lines):
    (folder / "in" / f"{name}.json").write_text("\n".join(lines) + "\n")


def rows_and_rejects(spark, folder, table_format="parquet"):
    table = spark.read.format(table_format).load(f"{folder}/events")
    return sensor_rows(table), rejected_events(table)


def run(query):
    query.awaitTermination()
    return query


def test_parse(spark):
    good = [event(), event(sensor_2=-1), event(other="ignored")]
    df = spark.createDataFrame([(bytearray(b, "utf-8"),) for b in good + BAD], "body binary")
    rows = parse_events(df).collect()
    assert [r.body for r in rows if r.complete] == good
    assert [r.body for r in rows if not r.complete] == BAD
    assert rows[1].sensor_2 == -1.0 and rows[1].sensor_21 == 21.0
    wrong_type = next(r for r in rows if r.body == BAD[3])
    assert wrong_type.sensor_3 is None and wrong_type.sensor_4 == 4.0


def test_ingest_across_batches_and_restarts(spark, folder):
    def counted():
        events = read_events(spark, f"{folder}/in", maxFilesPerTrigger=1)
        run(jobs.ingest(events, f"{folder}/events", f"{folder}/c1", tasks=1, **NOW))
        rows, bad = rows_and_rejects(spark, folder)
        assert rows.columns == SENSORS and bad.columns == ["body"]
        return rows.count(), sorted(r.body for r in bad.collect())

    drop(folder, "a", [event(), *BAD])
    drop(folder, "b", [event()] * 5)
    assert counted() == (6, sorted(BAD))
    assert counted() == (6, sorted(BAD))
    drop(folder, "c", [event()] * 2 + ["late"])
    assert counted() == (8, sorted([*BAD, "late"]))
    # One file per batch, partition and task; the text of complete events is not kept.
    files = list((folder / "events").glob("complete=*/*.parquet"))
    assert len(files) == 5
    assert spark.read.parquet(f"{folder}/events").filter("complete AND body IS NOT NULL").isEmpty()


INGEST_ALONE = """
import sys
from pyspark.sql import SparkSession
from wearlog.streaming import jobs
from wearlog.streaming.events import read_events
folder = sys.argv[1]
conf = {"spark.master": "local[1]", "spark.ui.enabled": "false", "spark.checkpoint.dir": folder + "/shared",
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + folder + "/log",
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"}
spark = SparkSession.builder.config(map=conf).getOrCreate()
query = jobs.ingest(read_events(spark, folder + "/in"), folder + "/events", folder + "/c", available_now=True)
query.awaitTermination()
spark.stop()
"""


def test_ingest_holds_no_rows_in_memory(spark, folder):
    """Tasks write both partitions as the rows come, instead of sorting them first."""
    (folder / "log").mkdir()
    drop(folder, "a", [event(), "{}", event(), *['{"k": 1}'] * 5000])
    root = str(Path(jobs.__file__).parents[2])
    subprocess.run([sys.executable, "-c", INGEST_ALONE, str(folder)], cwd=root, check=True, capture_output=True)
    (log,) = (folder / "log").iterdir()
    told = [json.loads(line) for line in log.read_text().splitlines()]
    tasks = [t["Task Info"]["Accumulables"] for t in told if t["Event"] == "SparkListenerTaskEnd"]
    peaks = [int(a["Update"]) for task in tasks for a in task if a["Name"] == "internal.metrics.peakExecutionMemory"]
    assert tasks and sum(peaks) == 0
    rows, bad = rows_and_rejects(spark, folder)
    assert (rows.count(), bad.count()) == (2, 5001)
    # Here one task; a file per partition, as before.
    assert len(list((folder / "events").glob("complete=*/*.parquet"))) == 2


def test_downstream_reads_complete_events_only(spark, folder):
    drop(folder, "a", [event(), *BAD])
    run(jobs.ingest(read_events(spark, f"{folder}/in"), f"{folder}/events", f"{folder}/c", **NOW))
    rows, _ = rows_and_rejects(spark, folder)
    assert "PartitionFilters: [isnotnull(complete" in rows._jdf.queryExecution().toString()


def test_a_batch_run_twice_counts_once(spark, folder):
    drop(folder, "a", [event()] * 3)
    for _ in range(2):
        events = read_events(spark, f"{folder}/in")
        run(jobs.ingest(events, f"{folder}/events", f"{folder}/c", **NOW))
        # As after a failure between writing the batch and noting that it is done.
        for note in (Path(folder) / "c" / "commits").glob("*0*"):
            shutil.move(str(note), str(folder / f"note-{note.name}"))
    assert spark.read.parquet(f"{folder}/events").count() == 3


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(2)
    rows = [
        {s: rng.choice([-1.0, 1.0]) if s == "sensor_2" else rng.random() for s in SENSORS}
        for _ in range(200)
    ]
    train = spark.createDataFrame(rows).select(*SENSORS)
    return fit_forest(
        train.withColumn(LABEL, F.when(F.col("sensor_2") < 0, 10).otherwise(50)),
        n_estimators=1,
        max_depth=1,
        bootstrap=False,
    )


def test_score_and_alert(spark, folder, model):
    drop(folder, "a", [event(sensor_2=-0.5), event(sensor_2=0.5), event(sensor_2=-0.9)])
    run(jobs.ingest(read_events(spark, f"{folder}/in"), f"{folder}/events", f"{folder}/c1", **NOW))

    def score_and_alert():
        run(
            jobs.score_stream(
                spark, model, f"{folder}/events", f"{folder}/pred", f"{folder}/c2", **NOW
            )
        )
        run(jobs.alert_stream(spark, f"{folder}/pred", f"{folder}/alerts", f"{folder}/c3", **NOW))
        return [spark.read.parquet(f"{folder}/{t}") for t in ("pred", "alerts")]

    for _ in range(2):
        predicted, alerts = score_and_alert()
        assert predicted.columns == [*SENSORS, PREDICTION, "processed_utc"]
        assert sorted(r[PREDICTION] for r in predicted.collect()) == [10.0, 10.0, 50.0]
        assert predicted.select("processed_utc").distinct().count() == 1
        assert sorted(r.sensor_2 for r in alerts.collect()) == [-0.9, -0.5]


def test_all_jobs_at_once_in_any_order(spark, folder, model):
    names = ["alert", "score", "ingest"]
    drop(folder, "a", [event(sensor_2=-0.5), "bad"])
    try:
        alert = jobs.alert_stream(spark, f"{folder}/pred", f"{folder}/alerts", f"{folder}/c1")
        score = jobs.score_stream(
            spark, model, f"{folder}/events", f"{folder}/pred", f"{folder}/c2"
        )
        events = read_events(spark, f"{folder}/in")
        ingest = jobs.ingest(events, f"{folder}/events", f"{folder}/c4")
        for n in (1, 2):
            for query in (ingest, score, alert):
                query.processAllAvailable()
            counts = [table.count() for table in rows_and_rejects(spark, folder)]
            counts += [spark.read.parquet(f"{folder}/{t}").count() for t in ("pred", "alerts")]
            assert counts == [n, n, n, n]
            drop(folder, "b", [event(sensor_2=-0.7), "also bad"])
    finally:
        jobs.stop_jobs(spark, *names)
    assert not any(query.name in names for query in spark.streams.active)


def test_other_table_formats(spark, folder, model):
    drop(folder, "a", [event(sensor_2=-0.5), event(sensor_2=0.5)])
    orc = {"table_format": "orc", **NOW}
    run(jobs.ingest(read_events(spark, f"{folder}/in"), f"{folder}/events", f"{folder}/c1", **orc))
    run(
        jobs.score_stream(spark, model, f"{folder}/events", f"{folder}/pred", f"{folder}/c2", **orc)
    )
    run(jobs.alert_stream(spark, f"{folder}/pred", f"{folder}/alerts", f"{folder}/c3", **orc))
    alerts = spark.read.orc(f"{folder}/alerts")
    assert [(r.sensor_2, r[PREDICTION]) for r in alerts.collect()] == [(-0.5, 10.0)]


def test_raw_rows_are_scaled_by_training_statistics(spark, folder, model):
    raw = spark.createDataFrame([(95.0,), (105.0,)], "sensor_2 double")
    drop(folder, "a", [event(sensor_2=96.0), event(sensor_2=104.0)])
    run(jobs.ingest(read_events(spark, f"{folder}/in"), f"{folder}/events", f"{folder}/c1", **NOW))
    run(
        jobs.score_stream(
            spark, model, f"{folder}/events", f"{folder}/pred", f"{folder}/c2",
            stats=fit_stats(raw), **NOW,
        )
    )
    assert sorted(r[PREDICTION] for r in spark.read.parquet(f"{folder}/pred").collect()) == [
        10.0,
        50.0,
    ]


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([(19.999,), (20.0,), (None,)], f"{PREDICTION} double")
    assert [r[0] for r in low_life(df).collect()] == [19.999]
    assert low_life(df, 30.0).count() == 2


def test_alert_messages(spark):
    now = "timestamp'2024-01-31 23:59:59' AS processed_utc"
    df = spark.sql(f"SELECT 1.5D AS sensor_1, 3.0D AS {PREDICTION}, {now}")
    (row,) = alert_messages(df).collect()
    assert json.loads(row.value) == {
        "sensor_1": 1.5,
        PREDICTION: 3.0,
        "processed_utc": "2024-01-31T23:59:59Z",
    }


def test_progress_counts_rejects(spark, folder):
    drop(folder, "a", [event(), *BAD])
    query = run(
        jobs.ingest(read_events(spark, f"{folder}/in"), f"{folder}/events", f"{folder}/c", **NOW)
    )
    counts = query.recentProgress[0].observedMetrics["events"]
    assert (counts["parsed"], counts["rejected"]) == (1 + len(BAD), len(BAD))


def test_only_named_jobs_are_stopped(spark, folder):
    drop(folder, "a", [event()])
    events = read_events(spark, f"{folder}/in")
    ours = jobs.ingest(events, f"{folder}/events", f"{folder}/c1", name="ours")
    other = jobs.ingest(events, f"{folder}/rows2", f"{folder}/c2", name="other")
    try:
        jobs.stop_jobs(spark, "ours")
        assert not ours.isActive and other.isActive
    finally:
        jobs.stop_jobs(spark, "ours", "other")
    assert not other.isActive
