"""Remaining-life labels."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearlog.operators.attach import attach
from wearlog.schema import LABEL

# Names of helper columns; a log keeps any column of its own.
_LAST, _OWNED, _TRUTH = "_last_cycle", "_owned_rows", "_truth"


def engine_spans(log: DataFrame) -> DataFrame:
    """Last cycle and number of rows of each engine.

    An aggregate rather than a window: it is combined before the shuffle, so an engine that
    owns a third of all rows costs one row per task.
    """
    return log.groupBy("engine_id").agg(
        F.max("cycle").alias(_LAST), F.count(F.lit(1)).alias(_OWNED)
    )


def label_run_to_failure(log: DataFrame, **limits: int) -> DataFrame:
    """Every row of a complete life gets the cycles left until its engine's last cycle."""
    with_span = attach(log, engine_spans(log), "engine_id", n_rows=_OWNED, **limits)
    return with_span.withColumn(LABEL, (F.col(_LAST) - F.col("cycle")).cast("int")).drop(_LAST)


def label_from_truth(log: DataFrame, truth: DataFrame, **limits: int) -> DataFrame:
    """The last cycle of a cut-off life gets its engine's true value; other rows stay NULL.

    Truth is joined at one row per engine; an engine that has several is an error. Comparing the cycle with
    the last one then replaces a join back to the log, and labels duplicates of the last row alike.
    """
    values = truth.select("engine_id", F.col(LABEL).alias(_TRUTH)).hint("merge")
    known = engine_spans(log).join(values, "engine_id", "left")
    with_truth = attach(log, known, "engine_id", n_rows=_OWNED, **limits)
    at_end = F.col("cycle") == F.col(_LAST)
    return with_truth.withColumn(LABEL, F.when(at_end, F.col(_TRUTH))).drop(_LAST, _TRUTH)
