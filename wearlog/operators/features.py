"""The model's input table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wearlog.schema import KEYS, LABEL, sensor_columns


def with_label(df: DataFrame) -> DataFrame:
    """The table with a label column; an unknown label is NULL, never a made-up 0."""
    return df if LABEL in df.columns else df.withColumn(LABEL, F.lit(None).cast("int"))


def gold_projection(silver: DataFrame, keep_keys: bool = False) -> DataFrame:
    """Sensors and label, in that order; the keys first if asked for."""
    keys = KEYS if keep_keys else []
    return with_label(silver).select(*keys, *sensor_columns(silver), LABEL)
