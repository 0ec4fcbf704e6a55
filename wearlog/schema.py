"""Names and types of the log columns."""

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The column order of a log line, and the label's name.
SENSORS = [f"sensor_{i}" for i in range(1, 22)]
SETTINGS = [f"op_setting_{i}" for i in range(1, 4)]
KEYS = ["engine_id", "cycle"]
LOG_COLUMNS = KEYS + SETTINGS + SENSORS
LABEL = "RUL"

LOG_TYPES = {**dict.fromkeys(KEYS, "int"), **dict.fromkeys(SETTINGS + SENSORS, "double")}

EVENT_SCHEMA = T.StructType([T.StructField(name, T.DoubleType()) for name in SENSORS])


def sensor_columns(df: DataFrame) -> list[str]:
    """The sensors a table holds, found by prefix, in table order."""
    return [name for name in df.columns if name.startswith("sensor_")]
