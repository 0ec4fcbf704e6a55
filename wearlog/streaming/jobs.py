"""The streaming jobs: events -> parsed events -> predictions -> alerts.

Events are read and parsed once, into one table with the partitions ``complete=true`` (sensor rows) and
``complete=false`` (rejects). Each job is one query into one file sink with its own checkpoint. The
sink's commit log lists the files of every finished batch, so a batch that is run again after a failure
counts once, and the next job, which reads the sink as a stream, never sees a row twice.

With ``table_format="commits"`` a job writes a table of versions (``sources.commits``) instead: its small files
can be merged while others read on, and its batches may bring new columns. ``transform_commits`` and
``score_commits`` read such tables as streams.
"""

import json
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from wearlog.operators.forest import PREDICTION, score
from wearlog.operators.scaling import apply_stats
from wearlog.schema import EVENT_SCHEMA
from wearlog.sources.commits import (
    append_commit,
    follow,
    overwrite_commit,
    read_version,
    version_of,
)
from wearlog.streaming.events import (
    ALERT_THRESHOLD,
    FILES_PER_BATCH,
    features,
    low_life,
    parse_events,
    sensor_rows,
)

INGEST_TRIGGER = "5 seconds"
FILE_FORMATS = {"parquet", "orc", "json"}
COMMITS = "commits"
#: Files of so many partitions a task writes at the same time; only rows of further ones it has to sort.
OPEN_FILES = 4
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"

#: Parsed events as stored; the text is kept of rejects only.
EVENTS_SCHEMA = StructType(
    [
        StructField("body", StringType()),
        *EVENT_SCHEMA.fields,
        StructField("complete", BooleanType()),
    ]
)

PREDICTION_SCHEMA = StructType(
    [
        *EVENT_SCHEMA.fields,
        StructField(PREDICTION, DoubleType()),
        StructField("processed_utc", TimestampType()),
    ]
)


def _open_files(spark: SparkSession) -> None:
    """From now on the session's tasks write the files of ``OPEN_FILES`` partitions at once, or of more if it says
    so already. Else each task would sort all its rows by partition, in memory; a split of short lines has millions.

    The sink looks the setting up in the session at every batch, so it stays.
    """
    if int(spark.conf.get(_OPEN_FILES)) < OPEN_FILES:
        spark.conf.set(_OPEN_FILES, str(OPEN_FILES))


def append_stream(
    rows: DataFrame,
    table: str,
    checkpoint: str,
    name: str,
    every: str | None = None,
    available_now: bool = False,
    table_format: str = "parquet",
    partition_by: tuple[str, ...] = (),
    tasks: int | None = None,
) -> StreamingQuery:
    """Start appending a stream to a table.

    ``every`` is the trigger interval (None: as soon as possible); ``available_now`` stops once
    the data at hand is written. ``table_format`` is any streaming sink that takes a path.

    Each batch leaves a file per task and partition, and a sink of plain files keeps a list of all files it
    ever wrote. ``tasks`` bounds the former: set it to a batch's bytes over the file size wanted. Streams
    that run for months at a short interval want a ``table_format`` that merges its files: ``commits``, or
    e.g. ``delta``.
    """
    rows = rows.coalesce(tasks) if tasks else rows
    if table_format == COMMITS:
        return each_batch(rows, append_to(table, checkpoint), checkpoint, name, every, available_now)
    if partition_by:
        _open_files(rows.sparkSession)
    writer = (
        rows.writeStream.format(table_format)
        .outputMode("append")
        .queryName(name)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start(table)


def writer_id(spark: SparkSession, checkpoint: str) -> str:
    """The name of the query that the checkpoint belongs to; a new checkpoint is a new writer."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/metadata")
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())["id"]
    finally:
        stream.close()


def append_to(
    table: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> Callable[[DataFrame, int], None]:
    """What to do with each batch of a stream: append it, transformed, to a table of versions, once even if
    the batch is run again. The rows may have columns the table did not have before."""

    def one(rows: DataFrame, batch: int) -> None:
        append_commit(transform(rows), table, writer_id(rows.sparkSession, checkpoint), batch)

    return one


def each_batch(
    rows: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    name: str,
    every: str | None = None,
    available_now: bool = False,
    mode: str = "append",
) -> StreamingQuery:
    """Start calling ``handle(rows, batch)`` with each batch of a stream. After a failure the last batch may be
    handled again, with the same rows and number."""
    writer = rows.writeStream.foreachBatch(handle).outputMode(mode).queryName(name)
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def transform_commits(
    spark: SparkSession,
    source: str,
    transform: Callable[[DataFrame], DataFrame],
    table: str,
    checkpoint: str,
    name: str,
    **options,
) -> StreamingQuery:
    """Rows appended to one table of versions, transformed, into another, each once; the source may be
    compacted meanwhile. ``options`` are those of ``follow``."""
    return follow(spark, source, append_to(table, checkpoint, transform), checkpoint, name, **options)


def stream_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    files_per_batch: int = FILES_PER_BATCH,
    table_format: str = "parquet",
) -> DataFrame:
    """The rows appended to a table, as a stream. A backlog is worked off in bounded batches.

    The job that fills a table of files need not have written anything yet: its folder is made.
    Table formats that are more than files know their schema themselves.
    """
    reader = spark.readStream.format(table_format).option("maxFilesPerTrigger", files_per_batch)
    if table_format in FILE_FORMATS:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
        reader = reader.schema(schema)
    return reader.load(path)


def ingest(
    events: DataFrame, table: str, checkpoint: str, name: str = "ingest", **options
) -> StreamingQuery:
    """Parse events into the table of parsed events, of which ``sensor_rows`` and ``rejected_events`` are
    the two partitions. The counts appear in the stream's progress. ``options`` are ``append_stream``'s."""
    options = {"every": INGEST_TRIGGER} | options
    parsed = parse_events(events).observe(
        "events",
        F.count(F.lit(1)).alias("parsed"),
        F.count_if(~F.col("complete")).alias("rejected"),
    )
    text = F.when(~F.col("complete"), F.col("body"))
    rows = parsed.withColumn("body", text)
    return append_stream(rows, table, checkpoint, name, partition_by=("complete",), **options)


def predictions(model: PipelineModel, rows: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Rows with prediction and time of scoring, one time for a whole batch.

    Rows are taken to be standardised already; raw rows need the ``stats`` of the training data.
    """
    inputs = features(rows)
    scaled = inputs if stats is None else apply_stats(inputs, stats)
    return score(model, scaled).withColumn("processed_utc", F.current_timestamp())


def score_stream(
    spark: SparkSession,
    model: PipelineModel,
    events_table: str,
    table: str,
    checkpoint: str,
    stats: DataFrame | None = None,
    name: str = "score",
    files_per_batch: int = FILES_PER_BATCH,
    table_format: str = "parquet",
    **options,
) -> StreamingQuery:
    """Score the complete events of the table of parsed events as they arrive."""
    parsed = stream_table(spark, events_table, EVENTS_SCHEMA, files_per_batch, table_format)
    scored = predictions(model, sensor_rows(parsed), stats)
    return append_stream(scored, table, checkpoint, name, table_format=table_format, **options)


def score_commits(
    spark: SparkSession,
    model: PipelineModel,
    events_table: str,
    table: str,
    checkpoint: str,
    stats: DataFrame | None = None,
    name: str = "score",
    **options,
) -> StreamingQuery:
    """``score_stream`` from a table of versions into another."""
    scored = lambda parsed: predictions(model, sensor_rows(parsed), stats)
    return transform_commits(spark, events_table, scored, table, checkpoint, name, **options)


VIEW = ["n_rows", "least", "mean"]


def live_view(
    rows: DataFrame,
    keys: list[str],
    view: str,
    checkpoint: str,
    value: str = PREDICTION,
    name: str = "live",
    every: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Keep a table of running totals of a stream: of each key the number of rows, the least ``value`` and the
    mean. The totals are the query's state, kept in its checkpoint; each batch sends on the keys that changed,
    and their rows replace those in the view in one commit (``read_version`` shows the last one).

    The view is as large as there are keys, as is the state.
    """
    totals = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(value).alias("least"), F.avg(value).alias("mean")
    )

    def one(changed: DataFrame, batch: int) -> None:
        spark = changed.sparkSession
        both = changed.withColumn("batch", F.lit(1))
        if version_of(spark, view):
            both = both.unionByName(read_version(spark, view).withColumn("batch", F.lit(0)))
        newest = F.max_by(F.struct(*VIEW), "batch").alias("newest")
        now = both.groupBy(*keys).agg(newest).select(*keys, "newest.*")
        overwrite_commit(now, view, writer_id(spark, checkpoint), batch)

    return each_batch(totals, one, checkpoint, name, every, available_now, mode="update")


def alert_stream(
    spark: SparkSession,
    predictions_table: str,
    table: str,
    checkpoint: str,
    threshold: float = ALERT_THRESHOLD,
    name: str = "alert",
    files_per_batch: int = FILES_PER_BATCH,
    table_format: str = "parquet",
    **options,
) -> StreamingQuery:
    """Predictions below the threshold into the alert table, as they arrive."""
    rows = stream_table(spark, predictions_table, PREDICTION_SCHEMA, files_per_batch, table_format)
    low = low_life(rows, threshold)
    return append_stream(low, table, checkpoint, name, table_format=table_format, **options)


def stop_jobs(spark: SparkSession, *names: str) -> None:
    """Stop the active queries of these names; others keep running."""
    for query in spark.streams.active:
        if query.name in names:
            query.stop()
