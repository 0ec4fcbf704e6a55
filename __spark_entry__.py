"""

The given tables hold no sensor logs, so the queries run on the log that ``wearlog.plans.series``
derives from ``events`` (and truth from ``customer``), over the whole tables. Files that a query
reads as its input, e.g. landing text, are first written by Spark into the shared folder.
"""

from __future__ import annotations

import contextlib
import io
import json
from collections.abc import Callable
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from wearlog import __main__ as cli
from wearlog.functions.metrics import rmse
from wearlog.functions.text import utc_text
from wearlog.operators.attach import attach
from wearlog.operators.compiled import compile_forest, compile_model, score_compiled
from wearlog.operators.features import gold_projection, with_label
from wearlog.operators.folds import FOLD, assign_folds, read_with_folds
from wearlog.operators.forest import (
    PREDICTION,
    fit_forest,
    load_model,
    model_rmse,
    save_model,
    score,
    score_record,
    search_forest,
)
from wearlog.operators.labels import label_from_truth, label_run_to_failure
from wearlog.operators.moments import (
    RANK_ERROR,
    current_moments,
    land_moments,
    merged_moments,
    merged_quantiles,
    rank_bounds,
    stats_row,
    withdraw_files,
)
from wearlog.operators.scaling import apply_stats, fit_stats, range_profile
from wearlog.operators.trees import Growth, binned, equal_bins, grid_search, grow
from wearlog.plans import layers, series
from wearlog.plans.series import events, test_log, to_line, train_log, truth
from wearlog.plans.trainer import train_life
from wearlog.schema import KEYS, LABEL, LOG_COLUMNS, SENSORS, SETTINGS
from wearlog.session import scratch_path
from wearlog.sources.commits import (
    append_commit,
    compact,
    follow,
    overwrite_commit,
    read_version,
    vacuum,
    version_of,
    write_part,
)
from wearlog.sources.landing import (
    good_rows,
    land_log,
    number_lines,
    parse_truth,
    rejected_lines,
)
from wearlog.sources.tables import append_table, overwrite_table, preview, read_table
from wearlog.streaming import jobs, segments, spool
from wearlog.streaming.events import (
    alert_messages,
    low_life,
    parse_events,
    read_events,
    rejected_events,
    sensor_rows,
)

FLAGSHIP_DIR = "/root/testdata/sf0.001"

# The sensors that say which type an event has. A tree that may use these only ends in one leaf
# per type, whose prediction SQL can compute too.
INDICATORS = [f"sensor_{i}" for i in series.INDICATOR]


def entry(spark: SparkSession) -> DataFrame:
    """Landing text to gold, on the smallest tables."""
    return batch_gold_train(spark, FLAGSHIP_DIR)


# ---------------------------------------------------------------- landing


def _text(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).text(path)
    return path


def _daily_files(spark: SparkSession, sf_dir: str, value, blank_days: bool = False) -> str:
    """One file per day, a new one after a million events, lines by event id. With ``blank_days`` the files
    of every third day begin with a blank line."""
    day = F.to_date("ts").alias("day")
    roll = F.lpad((F.col("event_id") / 1_000_000).cast("long").cast("string"), 9, "0").alias("roll")
    rows = series.series(
        events(spark, sf_dir), "event_id", "ts", "user_id", "event_type"
    ).select(value, day, roll, "event_id")
    if blank_days:
        third = rows.filter(F.dayofmonth("day") % 3 == 0).select("day", "roll").distinct()
        blank = third.select(F.lit("").alias("value"), "day", "roll", F.lit(-1).alias("event_id"))
        rows = rows.unionByName(blank)
    filed = rows.repartition("day", "roll").sortWithinPartitions("day", "roll", "event_id")
    return _text(filed.drop("event_id"), "daily", ("day", "roll"))


def landing_parse(spark, sf_dir):
    """Line items as untidy text lines, parsed back."""
    numbers = [
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
        "l_extendedprice", "l_partkey", "l_suppkey",
        *[f"l_quantity * {i}" for i in range(4, 22)],
    ]
    line = F.concat_ws(" ", *[F.expr(number).cast("string") for number in numbers])
    tidy = F.col("l_linenumber") % 2 == 0
    untidy = F.concat(F.lit('\t"  '), F.regexp_replace(line, " ", " \t "), F.lit('" '))
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    path = _text(items.select(F.when(tidy, line).otherwise(untidy)), "lines")
    return good_rows(land_log(spark, path, skip_header=False))


def landing_skip_header(spark, sf_dir):
    """Daily files parsed without the first line of each."""
    return good_rows(land_log(spark, _daily_files(spark, sf_dir, to_line())))


def landing_header_blank(spark, sf_dir):
    """The same where the first line of some files is blank."""
    return good_rows(land_log(spark, _daily_files(spark, sf_dir, to_line(), blank_days=True)))


# A line of whole numbers for each event, spoiled in a way that depends on type and id: the same text in
# Spark and in other engines.
_HEAD = "CAST(user_id + 1 AS STRING)", "CAST(event_id % 300 AS STRING)"
_READING = "CAST(event_id AS STRING)"
_SPOILED = f"""
    CASE event_type
    WHEN 'view' THEN concat({{head}}, ' 0 0 0', {{twenty}}, ' ', {_READING}, ' 0')
    WHEN 'error' THEN concat({{head}}, ' 0 0 0', {{twenty}})
    WHEN 'click' THEN concat({{head}}, ' 0 0 0', {{twenty}}, ' abc')
    WHEN 'signup' THEN concat({{head}}, ' 0 0 0', {{twenty}}, ' NaN')
    ELSE CASE event_id % 5
         WHEN 0 THEN concat({{head}}, ' 0 0 0', {{twenty}}, ' ', {_READING})
         WHEN 1 THEN concat('1.7 ', {_HEAD[1]}, ' 0 0 0', {{twenty}}, ' ', {_READING})
         WHEN 2 THEN concat({_HEAD[0]}, ' -0.5 0 0 0', {{twenty}}, ' ', {_READING})
         WHEN 3 THEN concat({{head}}, ' 0 0 0', {{twenty}}, ' 1d')
         ELSE concat({{head}}, ' 0 0 0', {{twenty}}, ' 0x1p3') END
    END""".format(
    head=f"{_HEAD[0]}, ' ', {_HEAD[1]}", twenty=", ".join(["' '", _READING] * 20)
)


def landing_rejects(spark, sf_dir):
    """Event types spoil their lines in different ways; every rejected line, with reason and file."""
    path = _daily_files(spark, sf_dir, F.expr(_SPOILED).alias("value"))
    rejects = rejected_lines(land_log(spark, path, skip_header=False))
    # Of the file's name, the day is what another engine knows too.
    day = F.regexp_extract("file", r"day=(\d{4}-\d{2}-\d{2})", 1).alias("day")
    return rejects.select("line", "reject_reason", day)


def truth_line_numbers(spark, sf_dir):
    """Event ids in order as lines of many files, numbered through."""
    ids = events(spark, sf_dir).select("event_id").orderBy("event_id")
    path = _text(ids.select(F.col("event_id").cast("string").alias("value")), "numbers")
    return number_lines(spark, path, skip_header=False)


def truth_skip_header(spark, sf_dir):
    """Daily files of event ids: engine numbers after dropping the first line of each file."""
    value = F.concat(F.lit(" "), F.col("event_id").cast("string"), F.lit(" ")).alias("value")
    return parse_truth(number_lines(spark, _daily_files(spark, sf_dir, value)))


# ---------------------------------------------------------------- labels and scaling


def rul_train(spark, sf_dir):
    return label_run_to_failure(train_log(spark, sf_dir, "event_id")).select(
        "event_id", *KEYS, LABEL
    )


def rul_test_last(spark, sf_dir):
    labelled = label_from_truth(test_log(spark, sf_dir, "event_id"), truth(spark, sf_dir))
    return labelled.select("event_id", *KEYS, LABEL)


def _rounded(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(
        *[F.round(c, 6).alias(c) if c in set(columns) else F.col(c) for c in df.columns]
    )


def sensor_stats(spark, sf_dir):
    stats = fit_stats(train_log(spark, sf_dir))
    return _rounded(stats, stats.columns)


def _landed(spark: SparkSession, sf_dir: str) -> str:
    """Moments of the training log after three landings; the second delivers one file anew, which was spoiled
    at first, and one that the third withdraws."""
    table = scratch_path(spark, "moments")
    rows = train_log(spark, sf_dir, "event_id")
    files = rows.withColumn("file", F.concat(F.lit("part-"), F.col("event_id") % 4)).drop("event_id")
    spoiled = files.withColumns({s: F.col(s) * 3 - 7 for s in SENSORS})
    land_moments(files.filter("file = 'part-0'").unionByName(spoiled.filter("file = 'part-1'")), table, 0)
    extra = spoiled.withColumn("file", F.lit("part-9"))
    land_moments(files.filter("file <> 'part-0' AND file <> 'part-3'").unionByName(extra), table, 1)
    land_moments(files.filter("file = 'part-3'"), table, 2)
    withdraw_files(spark, ["part-9"], table, 3)
    return table


def sensor_stats_incremental(spark, sf_dir):
    """Mean and deviation merged from what each landed file left, never from the log."""
    merged = merged_moments(current_moments(spark, _landed(spark, sf_dir)))
    stats = stats_row(merged, SENSORS)
    return _rounded(stats, stats.columns)


def sensor_quantiles(spark, sf_dir):
    """Quantiles merged from the files' sketches: whether each one's exact rank is within the stated error."""
    shares = [0.01, 0.25, 0.5, 0.75, 0.99]
    quantiles = merged_quantiles(current_moments(spark, _landed(spark, sf_dir)), shares)
    ranks = rank_bounds(train_log(spark, sf_dir), quantiles, SENSORS)
    within = F.col("share").between(F.col("below") - RANK_ERROR, F.col("upto") + RANK_ERROR)
    return ranks.select("sensor", "share", within.alias("within"))


def sensor_ranges(spark, sf_dir):
    return range_profile(train_log(spark, sf_dir))


def sensor_zscore(spark, sf_dir):
    """Test rows scaled by the statistics of the training rows."""
    scaled = apply_stats(
        test_log(spark, sf_dir, "event_id"), fit_stats(train_log(spark, sf_dir))
    )
    return _rounded(scaled, SENSORS)


def gold_train(spark, sf_dir):
    train = train_log(spark, sf_dir)
    return _rounded(
        gold_projection(apply_stats(label_run_to_failure(train), fit_stats(train))), SENSORS
    )


def gold_test(spark, sf_dir):
    labelled = label_from_truth(test_log(spark, sf_dir), truth(spark, sf_dir))
    return _rounded(
        gold_projection(apply_stats(labelled, fit_stats(train_log(spark, sf_dir)))), SENSORS
    )


def gold_unlabelled(spark, sf_dir):
    """A table without labels gets empty ones."""
    return gold_projection(with_label(test_log(spark, sf_dir)), keep_keys=True)


# ---------------------------------------------------------------- whole batch run


def _batch(spark: SparkSession, sf_dir: str, keep_keys: bool = False) -> str:
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "layers")
    series.write_landing(spark, sf_dir, landing)
    layers.run_batch(spark, landing, out, skip_header=False, keep_keys=keep_keys)
    return out


def batch_gold_train(spark, sf_dir):
    return _rounded(read_table(spark, f"{_batch(spark, sf_dir)}/gold/train"), SENSORS)


def batch_gold_test(spark, sf_dir):
    return _rounded(read_table(spark, f"{_batch(spark, sf_dir)}/gold/test"), SENSORS)


def batch_silver_test(spark, sf_dir):
    return _rounded(read_table(spark, f"{_batch(spark, sf_dir)}/silver/test"), SENSORS)


def _command(*args: str) -> None:
    """Run the command line in this session; what it prints is not shown."""
    with contextlib.redirect_stdout(io.StringIO()):
        cli.main(args)


def cli_batch(spark, sf_dir):
    """Landing text to gold by the command line."""
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "layers")
    series.write_landing(spark, sf_dir, landing)
    _command("batch", landing, out, "--no-header")
    return _rounded(read_table(spark, f"{out}/gold/test"), SENSORS)


def cli_ingest(spark, sf_dir):
    """Events parsed by the command line."""
    table, offsets = scratch_path(spark, "table"), scratch_path(spark, "offsets")
    _command("ingest", _event_files(spark, sf_dir), table, offsets, "--once")
    return sensor_rows(read_table(spark, table))


def gold_previews(spark, sf_dir):
    """The tables below gold, with the number of rows that their previews show."""
    gold = f"{_batch(spark, sf_dir)}/gold"
    shown = [(name, rows.count()) for name, rows in layers.previews(spark, gold).items()]
    return spark.createDataFrame(shown, "name string, n_rows long")


def first_rows(spark, sf_dir):
    """The preview of a layer, ordered."""
    rows = train_log(spark, sf_dir, "event_id")
    return preview(rows, order=["event_id"])


# ---------------------------------------------------------------- folds and model

ORDER = ["engine_id", "cycle", "event_id"]


def cv_folds(spark, sf_dir):
    keys = train_log(spark, sf_dir, "event_id").select(*ORDER)
    return assign_folds(keys, 3, ORDER)


def cv_folds_tied(spark, sf_dir):
    """Rows of one engine and cycle stay together."""
    keys = train_log(spark, sf_dir, "event_id").select(*ORDER)
    return assign_folds(keys, 7, KEYS)


def cv_folds_by_engine(spark, sf_dir):
    keys = train_log(spark, sf_dir, "event_id").select(*ORDER)
    return assign_folds(keys, 3, ["engine_id"], by_rows=False)


def cv_folds_as_stored(spark, sf_dir):
    """Folds of a table without a key, written in the order of the event ids."""
    path = scratch_path(spark, "stored")
    rows = train_log(spark, sf_dir, "event_id").select("event_id", *SENSORS)
    overwrite_table(rows.orderBy("event_id"), path)
    return read_with_folds(spark, path, 7).select("event_id", FOLD)


def rmse_group_mean(spark, sf_dir):
    """Error of predicting each engine's mean label."""
    labelled = label_run_to_failure(train_log(spark, sf_dir).select(*KEYS))
    means = labelled.groupBy("engine_id").agg(
        F.avg(LABEL).alias(PREDICTION), F.count(F.lit(1)).alias("n_rows")
    )
    error = rmse(F.col(LABEL), F.col(PREDICTION))
    return attach(labelled, means, "engine_id").agg(F.round(error, 6).alias("rmse"))


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_stats(train_log(spark, sf_dir).select(*INDICATORS))


def _model_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = label_run_to_failure(train_log(spark, sf_dir, "event_id"))
    return apply_stats(rows.select(*ORDER, *INDICATORS, LABEL), _stats(spark, sf_dir))


def _type_model(spark: SparkSession, sf_dir: str):
    """A forest over the indicators, through a save and a load."""
    path = scratch_path(spark, "model")
    save_model(
        fit_forest(
            _model_train(spark, sf_dir), bootstrap=False, n_estimators=2, max_depth=5
        ),
        path,
    )
    return load_model(path)


def forest_grid(spark, sf_dir):
    """Cross-validated error of each grid point."""
    folded = assign_folds(_model_train(spark, sf_dir), 3, ORDER)
    grid = {"n_estimators": [1], "max_depth": [0, 5]}
    search = search_forest(folded, 3, grid, bootstrap=False, parallelism=2)
    rows = [(point["max_depth"], round(error, 6)) for point, error in search.scores]
    return spark.createDataFrame(rows, "max_depth int, rmse double")


def forest_score(spark, sf_dir):
    rows = test_log(spark, sf_dir, "event_id").select(*ORDER, *INDICATORS)
    scored = score(_type_model(spark, sf_dir), apply_stats(rows, _stats(spark, sf_dir)))
    return _rounded(scored.select(*ORDER, PREDICTION), [PREDICTION])


def first_predictions(spark, sf_dir):
    """The first hundred predictions in order."""
    return preview(forest_score(spark, sf_dir), 100, ORDER)


def forest_rmse(spark, sf_dir):
    error = model_rmse(_type_model(spark, sf_dir), _model_train(spark, sf_dir))
    return _rounded(error, ["rmse"])


def forest_life(spark, sf_dir):
    """Batch run, grid search over all sensors and bagged trees, predictions on the test rows.

    Of each prediction: does it lie within the training labels, as an average of some of them must; and
    is the model's error on its training rows below that of predicting their mean.
    """
    gold = f"{_batch(spark, sf_dir, keep_keys=True)}/gold"
    grid = {"n_estimators": [5, 10], "max_depth": [5, 8], "min_samples_leaf": [1, 2]}
    found = train_life(spark, gold, cv=3, grid=grid)
    low, high, spread = found.train.agg(
        F.min(LABEL), F.max(LABEL), F.stddev_pop(LABEL)
    ).first()
    in_range = F.coalesce(F.col(PREDICTION).between(low, high), F.lit(False)).alias("in_range")
    beats_mean = F.lit(found.rmse() < spread).alias("beats_mean")
    return found.predict().select(*KEYS, LABEL, in_range, beats_mean)


def score_one_record(spark, sf_dir):
    """The prediction for the readings of the first test row."""
    rows = test_log(spark, sf_dir, "event_id").select(*ORDER, *INDICATORS)
    first = preview(apply_stats(rows, _stats(spark, sf_dir)), 1, ["event_id"]).first()
    life = score_record(spark, _type_model(spark, sf_dir), {s: first[s] for s in INDICATORS})
    return spark.createDataFrame([(first["event_id"], round(life, 6))], f"event_id long, {PREDICTION} double")


# Trees of two levels over all sensors, cut at equal distances: SQL can grow them too.
GRID_16 = {
    "n_estimators": [1, 2], "max_depth": [1, 2], "min_samples_split": [2, 300], "min_samples_leaf": [1, 100],
}


def forest_grid_all(spark, sf_dir):
    """Cross-validated error of the points of a grid with all four axes, over all sensors."""
    train = label_run_to_failure(train_log(spark, sf_dir, "event_id")).select(*ORDER, *SENSORS, LABEL)
    folded = assign_folds(train, 3, ORDER)
    found = grid_search(folded, 3, GRID_16, equal_bins(train, SENSORS), bootstrap=False)
    rows = [(*(point[name] for name in GRID_16), round(error, 6)) for point, error in found.scores]
    return spark.createDataFrame(rows, ", ".join(f"{name} int" for name in GRID_16) + ", rmse double")


def _two_levels(spark: SparkSession, sf_dir: str):
    train = label_run_to_failure(train_log(spark, sf_dir)).select(*SENSORS, LABEL)
    bins = equal_bins(train, SENSORS)
    return grow(binned(train, bins), bins, [Growth({"n_estimators": 1, "max_depth": 2}, bootstrap=False)])


def forest_splits(spark, sf_dir):
    """The nodes of a tree of two levels over all sensors."""
    name = F.get(F.array(*map(F.lit, SENSORS)), F.col("feature")).alias("sensor")
    nodes = _two_levels(spark, sf_dir).table(spark)
    cut, value = (F.round(c, 6).alias(c) for c in ("threshold", "value"))
    return nodes.select("node", name, cut, value, F.col("n").cast("long").alias("n_rows"))


def score_compiled_rows(spark, sf_dir):
    """Test rows scored by that tree as compiled; whether a bagged forest over all sensors, compiled, says the
    same as Spark ML, and whether a record scored without a job gets its row's prediction."""
    compiled = compile_forest(_two_levels(spark, sf_dir))
    stats = fit_stats(train_log(spark, sf_dir))
    train = apply_stats(label_run_to_failure(train_log(spark, sf_dir)), stats)
    bagged = fit_forest(train.select(*SENSORS, LABEL), n_estimators=5, max_depth=6)
    rows = score_compiled(compiled, test_log(spark, sf_dir, "event_id").select(*ORDER, *SENSORS))
    first = rows.orderBy("event_id").first()
    alone = compiled.predict(first.asDict()) == first[PREDICTION]
    ours = score_compiled(compile_model(spark, bagged), apply_stats(rows, stats).withColumnRenamed(PREDICTION, "tree"))
    both = score(bagged, ours.withColumnRenamed(PREDICTION, "compiled"))
    agrees = (F.col("compiled") == F.col(PREDICTION)) & F.lit(alone)
    return both.select(*ORDER, F.round("tree", 6).alias("tree"), agrees.alias("agrees"))


# ---------------------------------------------------------------- events


def json_parse(spark, sf_dir):
    """Bodies that are one object; others, which hold more after it, are rejected."""
    more = F.get(
        F.array(F.lit(""), F.lit("}"), F.lit(" x"), F.col("props"), F.lit(',"end":1')),
        F.col("event_id") % 5,
    )
    body = F.concat("props", more).cast("binary").alias("body")
    parsed = parse_events(events(spark, sf_dir).select(body), StructType([StructField("k", DoubleType())]))
    return parsed.select("body", "k", "complete")


def low_value_alerts(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_id", F.col("value").alias(PREDICTION))
    return low_life(rows)


def _event_files(spark: SparkSession, sf_dir: str) -> str:
    """Every event's readings as JSON, and every event's ``props``, which are no readings."""
    rows = events(spark, sf_dir)
    readings = series.series(rows).select(F.to_json(F.struct(*SENSORS)).alias("value"))
    return _text(readings.union(rows.select("props")), "events")


def _finished(spark: SparkSession, start: Callable, *args, **options) -> str:
    """Run a streaming job over the data at hand; returns its table."""
    table, checkpoint = scratch_path(spark, "table"), scratch_path(spark, "offsets")
    start(*args, table, checkpoint, available_now=True, **options).awaitTermination()
    return table


def stream_ingest(spark, sf_dir):
    stream = read_events(spark, _event_files(spark, sf_dir))
    return sensor_rows(read_table(spark, _finished(spark, jobs.ingest, stream)))


def stream_rejects(spark, sf_dir):
    """Events that are no complete object of readings, some with text after the object."""
    path = _event_files(spark, sf_dir)
    readings = series.series(events(spark, sf_dir), "event_id")
    body = F.to_json(F.struct(*SENSORS))
    more = F.get(
        F.array(F.lit("}"), F.lit(" garbage"), body, F.lit(',"end":1')), F.col("event_id") % 4
    )
    readings.select(F.concat(body, more).alias("value")).write.mode("append").text(path)
    rejects = rejected_events(read_table(spark, _finished(spark, jobs.ingest, read_events(spark, path))))
    # The readings' text is Spark's; what another engine knows is how the rejects end.
    last = F.regexp_extract("body", r"(\}\}| garbage|,\"end\":1)$", 1)
    doubled = F.col("body").rlike(r"\}\{")
    shown = F.when(doubled, "doubled").when(last != "", last).otherwise(F.col("body"))
    return rejects.select(shown.alias("body"))


def stream_restart(spark, sf_dir):
    """A finished stream started again finds nothing new, then what was added meanwhile."""
    rows = series.series(events(spark, sf_dir), "event_id")
    halves = [rows.filter(F.col("event_id") % 2 == i) for i in (0, 1)]
    path, table, offsets = (scratch_path(spark, name) for name in ("events", "table", "offsets"))
    for part in (halves[0], None, halves[1]):
        if part is not None:
            part.select(F.to_json(F.struct(*SENSORS)).alias("value")).write.mode("append").text(path)
        query = jobs.ingest(read_events(spark, path), table, offsets, available_now=True)
        query.awaitTermination()
    return sensor_rows(read_table(spark, table))


def stream_stop(spark, sf_dir):
    """A running job stopped by its name after it has worked off what is there."""
    table, offsets = scratch_path(spark, "table"), scratch_path(spark, "offsets")
    name = f"stop-{table[-32:]}"
    stream = read_events(spark, _event_files(spark, sf_dir))
    query = jobs.ingest(stream, table, offsets, name=name)
    query.processAllAvailable()
    running = query.isActive
    jobs.stop_jobs(spark, name)
    stopped = running and not query.isActive
    return sensor_rows(read_table(spark, table)).withColumn("stopped", F.lit(stopped))


def stream_score(spark, sf_dir):
    """Raw readings scaled by the training statistics and scored as they arrive; one time for the batch."""
    table = _finished(spark, jobs.ingest, read_events(spark, _event_files(spark, sf_dir)))
    scored = _finished(
        spark,
        jobs.score_stream,
        spark,
        _type_model(spark, sf_dir),
        table,
        stats=_stats(spark, sf_dir),
    )
    rows = read_table(spark, scored)
    times = rows.select("processed_utc").distinct().count()
    timed = F.col("processed_utc").isNotNull().alias("timed")
    return _rounded(
        rows.select(*SENSORS, PREDICTION, timed, F.lit(times).cast("long").alias("n_times")),
        [*SENSORS, PREDICTION],
    )


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as predictions: the value is the predicted life, the event's time (in UTC) that of scoring."""
    rows = series.series(events(spark, sf_dir), "ts")
    scored_at = F.concat(F.col("ts").cast("string"), F.lit("Z")).cast("timestamp")
    return rows.select(
        *SENSORS, F.col("sensor_2").alias(PREDICTION), scored_at.alias("processed_utc")
    )


def stream_alerts(spark, sf_dir):
    path = scratch_path(spark, "predictions")
    overwrite_table(_predictions(spark, sf_dir), path)
    alerts = read_table(spark, _finished(spark, jobs.alert_stream, spark, path))
    return alerts.withColumn("processed_utc", utc_text(F.col("processed_utc")))


def alert_payloads(spark, sf_dir):
    """Alerts as JSON messages, read back."""
    messages = alert_messages(low_life(_predictions(spark, sf_dir)))
    fields = ", ".join(f"{name} double" for name in [*SENSORS, PREDICTION])
    read = F.from_json("value", f"{fields}, processed_utc string")
    return messages.select(read.alias("m")).select("m.*")


def prediction_merge(spark, sf_dir):
    """Two appends, the second with one more column."""
    path = scratch_path(spark, "merged")
    rows = _predictions(spark, sf_dir).select("sensor_2", "sensor_3", PREDICTION)
    append_table(rows, path)
    append_table(rows.withColumn("model", F.lit("second")), path)
    return read_table(spark, path, merge_schema=True)


def _fails(action: Callable) -> bool:
    try:
        action()
    except Exception:  # noqa: BLE001
        return True
    return False


def stream_compacted(spark, sf_dir):
    """Two lots of events ingested in many batches into a table of versions, merged after each, scored
    downstream. Whether an overwrite that fails leaves the table as it was, and the parts it is left with."""
    path, table, offsets = (scratch_path(spark, name) for name in ("events", "table", "offsets"))
    scored, scored_offsets = scratch_path(spark, "scored"), scratch_path(spark, "offsets")
    rows = series.series(events(spark, sf_dir), "event_id")
    model, stats = _type_model(spark, sf_dir), _stats(spark, sf_dir)
    for lot in (0, 1):
        readings = rows.filter(F.col("event_id") % 2 == lot).select(F.to_json(F.struct(*SENSORS)).alias("value"))
        readings.repartition(6).write.mode("append").text(path)
        stream = read_events(spark, path, maxFilesPerTrigger=2)
        jobs.ingest(stream, table, offsets, available_now=True, table_format="commits").awaitTermination()
        if lot:
            # One more version than the reader has seen is merged before it reads on.
            compact(spark, table)
        jobs.score_commits(
            spark, model, table, scored, scored_offsets, stats=stats, available_now=True
        ).awaitTermination()
        compact(spark, table)
    broken = read_version(spark, table).withColumn("sensor_1", F.raise_error(F.lit("broken")).cast("double"))
    failed = _fails(lambda: overwrite_commit(broken, table))
    vacuum(spark, table, keep=1, unnamed_hours=0)
    intact = failed and read_version(spark, table).count() == rows.count()
    parts = len(version_of(spark, table).parts)
    return _rounded(
        read_version(spark, scored).select(
            *SENSORS, PREDICTION, F.lit(intact).alias("intact"), F.lit(parts).alias("n_parts")
        ),
        [*SENSORS, PREDICTION],
    )


def stream_batch_sink(spark, sf_dir):
    """Predictions into a table of versions, batch by batch. The sink's last batch is run again, as its end was
    not noted; later batches have a column more."""
    rows = _predictions(spark, sf_dir).select("sensor_2", "sensor_3", PREDICTION)
    source, table, offsets = (scratch_path(spark, name) for name in ("predictions", "table", "offsets"))
    for lot in (0, 1):
        append_table(rows.repartition(4), source)
        stream = jobs.stream_table(spark, source, rows.schema, files_per_batch=2)
        for _ in range(2):
            handle = jobs.append_to(
                table, offsets, lambda new, lot=lot: new.withColumn("model", F.lit("second")) if lot else new
            )
            jobs.each_batch(stream, handle, offsets, "sink", available_now=True).awaitTermination()
            _forget_last_batch(spark, offsets)
    return read_version(spark, table)


def _forget_last_batch(spark: SparkSession, offsets: str) -> None:
    """Remove a checkpoint's note that its last batch was finished."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{offsets}/commits")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    notes = [x.getPath() for x in files.listStatus(folder) if x.getPath().getName().isdigit()]
    files.delete(max(notes, key=lambda note: int(note.getName())), False)


def stream_recovered(spark, sf_dir):
    """Two versions of readings passed on by a job that fails after writing data, then after its commit; the
    rows that arrived, and how many parts were written in vain."""
    source, table, offsets = (scratch_path(spark, name) for name in ("source", "table", "offsets"))
    rows = series.series(events(spark, sf_dir), "event_id")
    faults = ["written", "committed", None, "written", "written", "committed", None]

    def handle(new: DataFrame, batch: int) -> None:
        fault = faults.pop(0)
        if fault == "written":
            write_part(new, table)
            raise RuntimeError("lost before the commit")
        append_commit(new, table, "sink", batch)
        if fault == "committed":
            raise RuntimeError("lost before the offsets were noted")

    for lot in (0, 1):
        append_commit(rows.filter(F.col("event_id") % 2 == lot).select(*SENSORS), source)
        while _fails(follow(spark, source, handle, offsets, "recover", available_now=True).awaitTermination):
            pass
    _, in_vain = vacuum(spark, table, keep=2, unnamed_hours=0)
    return read_version(spark, table).withColumn("in_vain", F.lit(in_vain + len(faults)))


def live_view(spark, sf_dir):
    """Running totals of predictions by day, of a job that is stopped and started again."""
    rows = _predictions(spark, sf_dir).withColumn("day", utc_text(F.col("processed_utc")).substr(1, 10))
    rows = rows.select("day", PREDICTION)
    path, view, offsets = (scratch_path(spark, name) for name in ("predictions", "view", "offsets"))
    for lot in (0, 1, 2):
        append_table(rows.filter(F.pmod(F.xxhash64("*"), F.lit(3)) == lot), path)
        stream = jobs.stream_table(spark, path, rows.schema, files_per_batch=2)
        jobs.live_view(stream, ["day"], view, offsets, available_now=True).awaitTermination()
    # As totals, which have two decimals: means can lie halfway between two rounded ones.
    total = F.round(F.col("mean") * F.col("n_rows"), 2).alias("total")
    return read_version(spark, view).select("day", "n_rows", "least", total)


def alert_spool(spark, sf_dir):
    """Alerts handed over message by message: those for a life below 1 are refused however often they are
    tried, others only the first time. The last batch is run again, as its end was not noted."""
    source, folder, offsets = (scratch_path(spark, name) for name in ("predictions", "spool", "offsets"))
    overwrite_table(_predictions(spark, sf_dir).repartition(4), source)
    seen = set()

    def send(message: str) -> None:
        if json.loads(message)[PREDICTION] < 1:
            raise ValueError("refused")
        if message not in seen:
            seen.add(message)
            raise ConnectionError("busy")

    rows = jobs.stream_table(spark, source, jobs.PREDICTION_SCHEMA, files_per_batch=2)
    for _ in range(2):
        spool.spool_stream(
            alert_messages(low_life(rows)), folder, offsets, send=send, available_now=True
        ).awaitTermination()
        _forget_last_batch(spark, offsets)
    life = F.from_json("value", f"{PREDICTION} double")[PREDICTION].alias(PREDICTION)
    good = spool.delivered(spark, folder).select(life, F.lit("delivered").alias("state"))
    return good.unionByName(spool.failed(spark, folder).select(life, F.col("error").alias("state")))


def stream_segments(spark, sf_dir):
    """Events from a log of four partitions with binary bodies, in bounded batches, ingested over two restarts
    while the log grows."""
    folder, table, offsets = (scratch_path(spark, name) for name in ("log", "table", "offsets"))
    rows = series.series(events(spark, sf_dir), "event_id")
    limit = max(1, rows.count() // 16)
    for lot in range(3):
        body = F.to_json(F.struct(*SENSORS)).cast("binary").alias("body")
        segments.write_segments(rows.filter(F.col("event_id") % 3 == lot).select(body), folder, 4)
        stream = segments.read_segments(spark, folder, f"{offsets}-progress/noted", limit)
        query = jobs.ingest(stream.select("body"), table, offsets, name=f"segments-{table[-32:]}", every="0 seconds")
        query.processAllAvailable()
        query.stop()
    return sensor_rows(read_table(spark, table))


QUERIES = [
    landing_parse,
    landing_skip_header,
    landing_header_blank,
    landing_rejects,
    truth_line_numbers,
    truth_skip_header,
    rul_train,
    rul_test_last,
    sensor_stats,
    sensor_stats_incremental,
    sensor_quantiles,
    sensor_ranges,
    sensor_zscore,
    gold_train,
    gold_test,
    gold_unlabelled,
    batch_gold_train,
    batch_gold_test,
    batch_silver_test,
    cli_batch,
    gold_previews,
    first_rows,
    cv_folds,
    cv_folds_tied,
    cv_folds_by_engine,
    cv_folds_as_stored,
    rmse_group_mean,
    forest_grid,
    forest_score,
    first_predictions,
    forest_rmse,
    forest_life,
    score_one_record,
    forest_grid_all,
    forest_splits,
    score_compiled_rows,
    json_parse,
    low_value_alerts,
    stream_ingest,
    stream_rejects,
    stream_restart,
    stream_stop,
    stream_score,
    stream_alerts,
    alert_payloads,
    prediction_merge,
    stream_compacted,
    stream_batch_sink,
    stream_recovered,
    live_view,
    alert_spool,
    stream_segments,
    cli_ingest,
]


def _corpus() -> tuple[dict, dict]:
    """Queries and SQL of the optional subpackage; both empty where it is not installed."""
    try:
        import corpus_pipeline
        from wearlog.llm.queries import ORACLE_SQL
        from wearlog.llm.queries import QUERIES as corpus_queries
    except ModuleNotFoundError as error:
        if error.name not in ("corpus_pipeline", "wearlog.llm"):
            raise
        return {}, {}
    whole = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return corpus_queries | {"pipeline": corpus_pipeline.run}, ORACLE_SQL | whole


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in QUERIES} | _corpus()[0]


def oracle_sql() -> dict[str, str]:
    return _sensor_sql() | _corpus()[1]


def _trees_sql(tables: str, models: str, n_bins: int = 32) -> str:
    """CTEs that grow a tree of up to two levels for each row ``m, without, depth, least, leaf`` of ``models``:
    ``grown`` (m, feature and bin of the nodes 1, 2 and 3, null in leaves), ``cuts`` and ``numbered`` (training
    rows with their bins)."""
    lows = ", ".join(f"min({c})" for c in SENSORS)
    highs = ", ".join(f"max({c})" for c in SENSORS)

    def best(node_table: str, keys: str) -> str:
        return f"""
            SELECT {keys}, arg_min(f, (-gain, f, b)) AS f, arg_min(b, (-gain, f, b)) AS b
            FROM (SELECT *, ls * ls / ln + (s - ls) * (s - ls) / (n - ln) - s * s / n AS gain
                  FROM {node_table} WHERE n - ln > 0)
            WHERE n >= least AND ln >= leaf AND n - ln >= leaf AND gain > 1e-9 * q
            GROUP BY {keys}"""

    def sums(histogram: str, keys: str) -> str:
        each = f"PARTITION BY {keys}, f"
        return f"""
            SELECT {keys}, f, b, sum(n) OVER (ORDER_ ROWS UNBOUNDED PRECEDING) AS ln,
                   sum(s) OVER (ORDER_ ROWS UNBOUNDED PRECEDING) AS ls,
                   sum(n) OVER (EACH_) AS n, sum(s) OVER (EACH_) AS s, sum(q) OVER (EACH_) AS q
            FROM {histogram}""".replace("ORDER_", f"{each} ORDER BY b").replace("EACH_", each)

    totals = "count(*)::DOUBLE AS n, sum(RUL)::DOUBLE AS s, sum(RUL * RUL)::DOUBLE AS q"
    return f"""{tables},
        ends AS (SELECT [{lows}] AS lo, [{highs}] AS hi FROM train),
        cuts AS (
            SELECT f, CASE WHEN lo[f] = hi[f] THEN []::DOUBLE[] ELSE list_transform(range(1, {n_bins}),
                       lambda i: lo[f] + (hi[f] - lo[f]) * i / {n_bins}) END AS c
            FROM ends, range(1, 22) AS t(f)),
        folded AS (SELECT *, ntile(3) OVER (ORDER BY engine_id, cycle, event_id) - 1 AS fold FROM train_labelled),
        binned AS (
            SELECT event_id, fold, RUL, f, len(list_filter(c, lambda x: v > x)) AS b
            FROM (SELECT event_id, fold, RUL, unnest([{", ".join(SENSORS)}]) AS v,
                         generate_subscripts([{", ".join(SENSORS)}], 1) AS f FROM folded) JOIN cuts USING (f)),
        numbered AS (
            SELECT event_id, fold, RUL, list(b ORDER BY f) AS bins FROM binned GROUP BY event_id, fold, RUL),
        models AS ({models}),
        roots AS (
            SELECT without, f, b, {totals}
            FROM (SELECT DISTINCT without FROM models) JOIN binned ON fold <> without GROUP BY without, f, b),
        root_sums AS ({sums("roots", "without")}),
        root_best AS ({best("(SELECT * FROM root_sums JOIN models USING (without) WHERE depth > 0)", "m")}),
        sides AS (
            SELECT m, least, leaf, CASE WHEN bins[root_best.f] > root_best.b THEN 3 ELSE 2 END AS node, RUL, bins
            FROM models JOIN root_best USING (m) JOIN numbered ON fold <> without WHERE depth > 1),
        side_bins AS (
            SELECT m, node, any_value(least) AS least, any_value(leaf) AS leaf, f, b, {totals}
            FROM (SELECT m, node, least, leaf, RUL, unnest(bins) AS b, generate_subscripts(bins, 1) AS f FROM sides)
            GROUP BY m, node, f, b),
        side_sums AS ({sums("side_bins", "m, node")}),
        side_best AS ({best("(SELECT * FROM side_sums JOIN models USING (m))", "m, node")}),
        grown AS (
            SELECT models.*, root_best.f AS f1, root_best.b AS b1, low.f AS f2, low.b AS b2, high.f AS f3, high.b AS b3
            FROM models LEFT JOIN root_best USING (m)
            LEFT JOIN side_best low ON low.m = models.m AND low.node = 2
            LEFT JOIN side_best high ON high.m = models.m AND high.node = 3)"""


#: The leaf that a row with ``bins`` comes to.
_LEAF = """CASE WHEN f1 IS NULL THEN 1
    WHEN bins[f1] > b1 THEN CASE WHEN f3 IS NULL THEN 3 WHEN bins[f3] > b3 THEN 7 ELSE 6 END
    ELSE CASE WHEN f2 IS NULL THEN 2 WHEN bins[f2] > b2 THEN 5 ELSE 4 END END"""


def _sensor_sql() -> dict[str, str]:
    def columns(names, table=""):
        return ", ".join(f"{table}{name}" for name in names)

    log = ", ".join(f"{text} AS {name}" for name, text in series.EXPRESSIONS.items())
    cut = f"TIMESTAMP '{series.TEST_FROM}'"
    tables = f"""
        WITH log AS (SELECT event_id, ts, event_type, {log} FROM events),
        train AS (SELECT * FROM log WHERE ts < {cut}),
        test AS (SELECT * FROM log WHERE ts >= {cut}),
        truth AS (SELECT CAST(c_custkey + 1 AS INTEGER) AS engine_id,
                         CAST(floor(c_acctbal) AS INTEGER) AS life FROM customer),
        train_labelled AS (
            SELECT *, CAST(max(cycle) OVER (PARTITION BY engine_id) - cycle AS INTEGER) AS RUL
            FROM train),
        test_labelled AS (
            SELECT t.*, CASE WHEN cycle = max(cycle) OVER (PARTITION BY t.engine_id)
                             THEN life END AS RUL
            FROM test t LEFT JOIN truth ON truth.engine_id = t.engine_id),
        stats AS (SELECT {", ".join(
            f"avg({s}) AS m_{s}, stddev_samp({s}) AS d_{s}" for s in SENSORS)} FROM train),
        ranked AS (SELECT *, row_number() OVER (ORDER BY engine_id, cycle, event_id) AS i
                   FROM train),
        daily AS (
            SELECT *, row_number() OVER (PARTITION BY CAST(ts AS DATE), event_id // 1000000
                                         ORDER BY event_id) AS line
            FROM log)
    """
    def z_scores(names):
        """All sensors, those in ``names`` standardised."""
        z = "CASE WHEN d_{0} <> 0 THEN ({0} - m_{0}) / d_{0} ELSE {0} END"
        return ", ".join(
            f"round({z.format(s) if s in names else s}, 6) + 0.0 AS {s}" for s in SENSORS
        )

    scaled = z_scores(SENSORS)
    sensors = columns(SENSORS)
    gold_train_sql = f"{tables} SELECT {scaled}, RUL FROM train_labelled, stats"
    gold_test_sql = f"{tables} SELECT {scaled}, RUL FROM test_labelled, stats"
    by_type = """(SELECT event_type, avg(RUL) AS life FROM train_labelled GROUP BY event_type)"""
    alerts = f"""{tables}
            SELECT {sensors}, sensor_2 AS predicted_rul,
                   strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS processed_utc
            FROM log WHERE sensor_2 < 20"""
    points = " UNION ALL ".join(
        f"SELECT {i * 3 + fold} AS m, {fold} AS without, {d} AS depth, {s} AS least, {leaf} AS leaf, {t} AS trees"
        for i, (t, d, s, leaf) in enumerate(product(*GRID_16.values()))
        for fold in range(3)
    )
    two_levels = _trees_sql(tables, "SELECT 0 AS m, -1 AS without, 2 AS depth, 2 AS least, 1 AS leaf")
    parsed = {
        "engine_id": "CAST(l_orderkey AS INTEGER)",
        "cycle": "CAST(l_linenumber AS INTEGER)",
        **dict(zip(SETTINGS, ("l_quantity", "l_discount", "l_tax"))),
        "sensor_1": "l_extendedprice",
        "sensor_2": "CAST(l_partkey AS DOUBLE)",
        "sensor_3": "CAST(l_suppkey AS DOUBLE)",
        **{f"sensor_{i}": f"l_quantity * {i}" for i in range(4, 22)},
    }
    stats_sql = (
        f"{tables} SELECT "
        + ", ".join(f"round(m_{s}, 6) AS mean_{s}, round(d_{s}, 6) AS std_{s}" for s in SENSORS)
        + " FROM stats"
    )
    return {
        "landing_parse": "SELECT "
        + ", ".join(f"{text} AS {name}" for name, text in parsed.items())
        + " FROM lineitem",
        "landing_skip_header": f"{tables} SELECT {columns(LOG_COLUMNS)} FROM daily WHERE line > 1",
        "landing_header_blank": f"""{tables}
            SELECT {columns(LOG_COLUMNS)} FROM daily WHERE line > 1 OR day(ts) % 3 = 0""",
        "landing_rejects": f"""
            SELECT {_SPOILED.replace("STRING", "VARCHAR")} AS line,
                   CASE WHEN event_type IN ('view', 'error') THEN 'field_count'
                        WHEN event_type = 'click' OR (event_type = 'purchase' AND event_id % 5 > 2)
                        THEN 'not_a_number'
                        WHEN event_type = 'signup' THEN 'not_finite'
                        ELSE 'not_an_integer' END AS reject_reason,
                   strftime(ts, '%Y-%m-%d') AS day
            FROM events WHERE event_type <> 'purchase' OR event_id % 5 > 0""",
        "truth_line_numbers": """
            SELECT row_number() OVER (ORDER BY event_id) AS line_no,
                   CAST(event_id AS VARCHAR) AS value FROM events""",
        "truth_skip_header": f"""{tables}
            SELECT CAST(row_number() OVER (ORDER BY CAST(ts AS DATE), event_id // 1000000, event_id)
                        AS INTEGER) AS engine_id,
                   CAST(event_id AS INTEGER) AS RUL
            FROM daily WHERE line > 1""",
        "rul_train": f"{tables} SELECT event_id, engine_id, cycle, RUL FROM train_labelled",
        "rul_test_last": f"{tables} SELECT event_id, engine_id, cycle, RUL FROM test_labelled",
        "sensor_stats": stats_sql,
        "sensor_stats_incremental": stats_sql,
        "sensor_quantiles": f"""{tables}
            SELECT sensor, CAST(share AS DOUBLE) AS share, count(*) > 0 AS within
            FROM (SELECT unnest({SENSORS}) AS sensor FROM train), (SELECT unnest([0.01, 0.25, 0.5, 0.75, 0.99]) AS share)
            GROUP BY sensor, share""",
        "sensor_ranges": f"{tables} SELECT "
        + ", ".join(f"min({s}) AS min_{s}, max({s}) AS max_{s}" for s in SENSORS)
        + " FROM train",
        "sensor_zscore": f"""{tables}
            SELECT event_id, {columns(KEYS + SETTINGS)}, {scaled} FROM test, stats""",
        "gold_train": gold_train_sql,
        "gold_test": gold_test_sql,
        "gold_unlabelled": f"""{tables}
            SELECT engine_id, cycle, {sensors}, CAST(NULL AS INTEGER) AS RUL FROM test""",
        "batch_gold_train": gold_train_sql,
        "batch_gold_test": gold_test_sql,
        "cli_batch": gold_test_sql,
        "cli_ingest": f"{tables} SELECT {sensors} FROM log",
        "gold_previews": f"""{tables}
            SELECT 'train' AS name, least(5, count(*)) AS n_rows FROM train
            UNION ALL SELECT 'test', least(5, count(*)) FROM test""",
        "batch_silver_test": f"""{tables}
            SELECT {columns(KEYS + SETTINGS)}, {scaled}, RUL FROM test_labelled, stats""",
        "first_rows": f"""{tables}
            SELECT event_id, {columns(LOG_COLUMNS)} FROM train ORDER BY event_id LIMIT 5""",
        "cv_folds": f"""{tables}
            SELECT engine_id, cycle, event_id,
                   CAST(ntile(3) OVER (ORDER BY engine_id, cycle, event_id) - 1 AS INTEGER) AS fold
            FROM train""",
        "cv_folds_tied": f"""{tables},
            tiles AS (SELECT *, ntile(7) OVER (ORDER BY engine_id, cycle, event_id) - 1 AS tile
                      FROM train),
            firsts AS (SELECT *, row_number() OVER (PARTITION BY tile
                                                    ORDER BY engine_id, cycle, event_id) AS place
                       FROM tiles),
            cuts AS (SELECT engine_id AS e, cycle AS c FROM firsts WHERE place = 1 AND tile > 0)
            SELECT engine_id, cycle, event_id,
                   CAST(count(e) AS INTEGER) AS fold
            FROM train LEFT JOIN cuts
              ON engine_id > e OR (engine_id = e AND cycle >= c)
            GROUP BY engine_id, cycle, event_id""",
        "cv_folds_by_engine": f"""{tables},
            engines AS (SELECT engine_id, ntile(3) OVER (ORDER BY engine_id) - 1 AS fold
                        FROM (SELECT DISTINCT engine_id FROM train))
            SELECT engine_id, cycle, event_id, CAST(fold AS INTEGER) AS fold
            FROM train JOIN engines USING (engine_id)""",
        "cv_folds_as_stored": f"""{tables}
            SELECT event_id, CAST(ntile(7) OVER (ORDER BY event_id) - 1 AS INTEGER) AS fold
            FROM train""",
        "rmse_group_mean": f"""{tables},
            m AS (SELECT *, avg(RUL) OVER (PARTITION BY engine_id) AS p FROM train_labelled)
            SELECT round(sqrt(avg((RUL - p) * (RUL - p))), 6) AS rmse FROM m""",
        "forest_grid": f"""{tables},
            folded AS (SELECT *, ntile(3) OVER (ORDER BY engine_id, cycle, event_id) AS fold
                       FROM train_labelled),
            folds AS (SELECT DISTINCT fold AS f FROM folded),
            flat AS (SELECT f, avg(RUL) AS p FROM folds JOIN folded ON fold <> f GROUP BY f),
            deep AS (SELECT f, event_type, avg(RUL) AS p
                     FROM folds JOIN folded ON fold <> f GROUP BY f, event_type),
            errors AS (
                SELECT 0 AS max_depth, f, sqrt(avg((RUL - p) * (RUL - p))) AS e
                FROM folded JOIN flat ON fold = f GROUP BY f
                UNION ALL
                SELECT 5, f, sqrt(avg((RUL - p) * (RUL - p)))
                FROM folded JOIN deep ON fold = f AND folded.event_type = deep.event_type
                GROUP BY f)
            SELECT CAST(max_depth AS INTEGER) AS max_depth, round(avg(e), 6) AS rmse
            FROM errors GROUP BY max_depth""",
        "forest_score": f"""{tables}
            SELECT engine_id, cycle, event_id, round(life, 6) AS predicted_rul
            FROM test JOIN {by_type} USING (event_type)""",
        "first_predictions": f"""{tables}
            SELECT engine_id, cycle, event_id, round(life, 6) AS predicted_rul
            FROM test JOIN {by_type} USING (event_type)
            ORDER BY engine_id, cycle, event_id LIMIT 100""",
        "forest_rmse": f"""{tables}
            SELECT round(sqrt(avg((RUL - life) * (RUL - life))), 6) AS rmse
            FROM train_labelled JOIN {by_type} USING (event_type)""",
        "forest_life": f"""{tables}
            SELECT engine_id, cycle, RUL, true AS in_range, true AS beats_mean FROM test_labelled""",
        "score_one_record": f"""{tables}
            SELECT event_id, round(life, 6) AS predicted_rul
            FROM test JOIN {by_type} USING (event_type) ORDER BY event_id LIMIT 1""",
        "forest_grid_all": f"""{_trees_sql(tables, points)},
            placed AS (SELECT grown.*, fold, RUL, {_LEAF} AS node FROM grown, numbered),
            leaves AS (
                SELECT m, node, sum(RUL)::DOUBLE / count(*) AS p FROM placed WHERE fold <> without GROUP BY m, node),
            errors AS (
                SELECT m, any_value(trees) AS trees, any_value(depth) AS depth, any_value(least) AS least,
                       any_value(leaf) AS leaf, sqrt(avg((RUL - p) * (RUL - p))) AS e
                FROM placed JOIN leaves USING (m, node) WHERE fold = without GROUP BY m)
            SELECT trees AS n_estimators, depth AS max_depth, least AS min_samples_split,
                   leaf AS min_samples_leaf, round(avg(e), 6) AS rmse
            FROM errors GROUP BY trees, depth, least, leaf""",
        "forest_splits": f"""{two_levels},
            paths AS (SELECT RUL, unnest(CASE WHEN node > 3 THEN [1, node // 2, node]
                                              WHEN node > 1 THEN [1, node] ELSE [1] END) AS node
                      FROM (SELECT RUL, {_LEAF} AS node FROM grown, numbered)),
            nodes AS (SELECT node, sum(RUL)::DOUBLE / count(*) AS value, count(*) AS n_rows FROM paths GROUP BY node),
            split AS (SELECT 1 AS node, f1 AS f, b1 AS b FROM grown
                      UNION ALL SELECT 2, f2, b2 FROM grown UNION ALL SELECT 3, f3, b3 FROM grown)
            SELECT CAST(node AS BIGINT) AS node, 'sensor_' || f AS sensor, round(c[b + 1], 6) AS threshold,
                   round(value, 6) AS value, n_rows
            FROM nodes LEFT JOIN split USING (node) LEFT JOIN cuts USING (f)""",
        "score_compiled_rows": f"""{two_levels},
            leaves AS (SELECT {_LEAF} AS node, sum(RUL)::DOUBLE / count(*) AS value FROM grown, numbered GROUP BY 1),
            rows_to_score AS (
                SELECT engine_id, cycle, event_id, list(len(list_filter(c, lambda x: v > x)) ORDER BY f) AS bins
                FROM (SELECT engine_id, cycle, event_id, unnest([{sensors}]) AS v,
                             generate_subscripts([{sensors}], 1) AS f FROM test) JOIN cuts USING (f)
                GROUP BY engine_id, cycle, event_id)
            SELECT engine_id, cycle, event_id, round(value, 6) AS tree, true AS agrees
            FROM (SELECT engine_id, cycle, event_id, {_LEAF} AS node FROM rows_to_score, grown) JOIN leaves USING (node)""",
        "json_parse": """
            SELECT concat(props, ['', '}', ' x', props, ',"end":1'][event_id % 5 + 1]) AS body,
                   CASE WHEN event_id % 5 = 0 THEN CAST(json_extract(props, '$.k') AS DOUBLE) END AS k,
                   event_id % 5 = 0 AS complete
            FROM events""",
        "low_value_alerts": "SELECT event_id, value AS predicted_rul FROM events WHERE value < 20",
        "stream_ingest": f"{tables} SELECT {sensors} FROM log",
        "stream_rejects": """
            SELECT props AS body FROM events
            UNION ALL
            SELECT ['}}', ' garbage', 'doubled', ',"end":1'][event_id % 4 + 1] FROM events""",
        "stream_restart": f"{tables} SELECT {sensors} FROM log",
        "stream_stop": f"{tables} SELECT {sensors}, true AS stopped FROM log",
        "stream_score": f"""{tables}
            SELECT {z_scores(INDICATORS)}, round(life, 6) AS predicted_rul, true AS timed,
                   CAST(1 AS BIGINT) AS n_times
            FROM log JOIN {by_type} USING (event_type), stats""",
        "stream_compacted": f"""{tables}
            SELECT {z_scores(INDICATORS)}, round(life, 6) AS predicted_rul, true AS intact, 1 AS n_parts
            FROM log JOIN {by_type} USING (event_type), stats""",
        "stream_batch_sink": f"""{tables}
            SELECT sensor_2, sensor_3, sensor_2 AS predicted_rul, CAST(NULL AS VARCHAR) AS model
            FROM log
            UNION ALL SELECT sensor_2, sensor_3, sensor_2, 'second' FROM log""",
        "stream_recovered": f"{tables} SELECT {sensors}, 3 AS in_vain FROM log",
        "alert_spool": f"""{tables}
            SELECT sensor_2 AS predicted_rul,
                   CASE WHEN sensor_2 < 1 THEN 'ValueError: refused' ELSE 'delivered' END AS state
            FROM log WHERE sensor_2 < 20""",
        "stream_segments": f"{tables} SELECT {sensors} FROM log",
        "live_view": f"""{tables}
            SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n_rows, min(sensor_2) AS least,
                   round(avg(sensor_2) * count(*), 2) AS total
            FROM log GROUP BY day""",
        "stream_alerts": alerts,
        "alert_payloads": alerts,
        "prediction_merge": f"""{tables}
            SELECT sensor_2, sensor_3, sensor_2 AS predicted_rul, CAST(NULL AS VARCHAR) AS model
            FROM log
            UNION ALL SELECT sensor_2, sensor_3, sensor_2, 'second' FROM log""",
    }
