"""Sensor events: one JSON object of readings per message."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearlog.functions.text import all_finite, utc_text
from wearlog.operators.forest import PREDICTION
from wearlog.schema import EVENT_SCHEMA, SENSORS

ALERT_THRESHOLD = 20.0
FILES_PER_BATCH = 10_000
OFFSETS_PER_BATCH = 10_000_000

_CORRUPT = "_corrupt"


def read_events(
    spark: SparkSession,
    path: str | None = None,
    source: str = "text",
    body: str = "value",
    **options,
) -> DataFrame:
    """A stream with one column ``body``.

    By default the source is a folder of text files with one event per line, a backlog of which
    is worked off in bounded batches. Any streaming source works, e.g. ``source="kafka"`` with
    its options (bounded batches too), or an event hub with ``body="body"``.
    """
    if path:
        options = {"maxFilesPerTrigger": FILES_PER_BATCH} | options
    if source == "kafka":
        options = {"maxOffsetsPerTrigger": OFFSETS_PER_BATCH} | options
    stream = spark.readStream.format(source).options(**options)
    return (stream.load(path) if path else stream.load()).select(F.col(body).alias("body"))


def parse_events(events: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """``body`` as text, the fields of ``schema``, and ``complete``.

    An event is complete if its body is one JSON object, with nothing after it, that has a finite number in
    every field. A field of the wrong type is NULL alone; text that is no such object has NULL in all
    fields.
    """
    names = schema.fieldNames()
    # A parser stops after the first object. Within a list that has to be closed, and before a mark that
    # has to be found and that no body can know, anything after the object shows.
    mark = f"end_{uuid.uuid4().hex}"
    outer = T.StructType(
        [
            T.StructField("event", T.ArrayType(schema)),
            T.StructField(mark, T.IntegerType()),
            T.StructField(_CORRUPT, T.StringType()),
        ]
    )
    text = F.col("body").cast("string")
    wrapped = F.concat(F.lit('{"event":['), text, F.lit(f'],"{mark}":1}}'))
    parsed = F.from_json(wrapped, outer, {"columnNameOfCorruptRecord": _CORRUPT})
    whole = (F.size("data.event") == 1) & (F.col(f"data.{mark}") == 1)
    # Only a body that closes the list could add fields of its own.
    closes = F.contains(F.col("body"), F.lit("]"))
    alone = ~closes | (F.size(F.json_object_keys(wrapped)) == 2)
    expanded = (
        events.select(text.alias("body"))
        .withColumn("data", parsed)
        .select("body", F.when(whole & alone, F.col("data.event")[0]).alias("one"), f"data.{_CORRUPT}")
        .select("body", "one.*", _CORRUPT)
    )
    finite = F.coalesce(all_finite([F.col(name) for name in names]), F.lit(False))
    return expanded.select("body", *names, (F.col(_CORRUPT).isNull() & finite).alias("complete"))


def sensor_rows(parsed: DataFrame) -> DataFrame:
    """The readings of complete events, of ``parse_events`` or of the table that holds its result."""
    return parsed.filter(F.col("complete").cast("boolean")).drop("body", "complete")


def rejected_events(parsed: DataFrame) -> DataFrame:
    """The other events as text."""
    return parsed.filter(~F.col("complete").cast("boolean")).select("body")


def low_life(predictions: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """Predictions strictly below the threshold."""
    return predictions.filter(F.col(PREDICTION) < threshold)


def alert_messages(alerts: DataFrame) -> DataFrame:
    """Alerts as one column ``value`` of JSON, ready for a message sink; times as UTC text."""
    sent = alerts.withColumn("processed_utc", utc_text(F.col("processed_utc")))
    return sent.select(F.to_json(F.struct(*sent.columns)).alias("value"))


def features(rows: DataFrame, sensors: list[str] = SENSORS) -> DataFrame:
    """The model's inputs as doubles."""
    return rows.select(*[F.col(name).cast("double").alias(name) for name in sensors])
