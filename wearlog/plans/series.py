"""A run-to-failure log derived from the ``events`` table, and truth from ``customer``.

One engine per user, the hour of the event as cycle, 21 readings computed from the event. The
same definitions exist as SQL, for checking the engine against another one.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearlog.schema import LABEL, LOG_COLUMNS, SENSORS

# Sensors that never change, with their reading.
CONSTANT = {1: "518.67", 5: "14.62", 10: "1.3", 16: "0.03", 18: "2388.0", 19: "100.0"}
# The sensors that say with 1 or 0 whether the event is of a type.
INDICATOR = {4: "error", 6: "click", 7: "view", 8: "purchase", 9: "signup"}
TEST_FROM = "2024-01-21 00:00:00"

_HOUR = "(dayofyear(ts) - 1) * 24 + hour(ts)"


def _sensor(i: int) -> str:
    """SQL text of reading ``i``, the same in Spark and ANSI SQL."""
    if i in CONSTANT:
        return f"CAST({CONSTANT[i]} AS DOUBLE)"
    if i in INDICATOR:
        return f"CAST(CASE WHEN event_type = '{INDICATOR[i]}' THEN 1 ELSE 0 END AS DOUBLE)"
    if i == 3:
        return f"CAST({_HOUR} AS DOUBLE)"
    return "value" if i == 2 else f"value * CAST({i} AS DOUBLE)"


EXPRESSIONS = {
    "engine_id": "CAST(user_id + 1 AS INT)",
    "cycle": f"CAST({_HOUR} AS INT)",
    "op_setting_1": "CAST(hour(ts) AS DOUBLE)",
    "op_setting_2": "CAST(0.5 AS DOUBLE)",
    "op_setting_3": "CAST(100 AS DOUBLE)",
    **{name: _sensor(i) for i, name in enumerate(SENSORS, 1)},
}


def _is_test() -> Column:
    return F.col("ts") >= F.lit(TEST_FROM).cast("timestamp_ntz")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def series(rows: DataFrame, *extra: str) -> DataFrame:
    """Log columns of events, after any ``extra`` event columns."""
    return rows.select(*extra, *[F.expr(EXPRESSIONS[c]).alias(c) for c in LOG_COLUMNS])


def train_log(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    return series(events(spark, sf_dir).filter(~_is_test()), *extra)


def test_log(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    return series(events(spark, sf_dir).filter(_is_test()), *extra)


test_log.__test__ = False


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``engine_id`` and ``RUL`` of every customer."""
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        (F.col("c_custkey") + 1).cast("int").alias("engine_id"),
        F.floor("c_acctbal").cast("int").alias(LABEL),
    )


def to_line(columns: list[str] = LOG_COLUMNS) -> Column:
    """The columns as one log line."""
    return F.concat_ws(" ", *[F.col(c).cast("string") for c in columns]).alias("value")


def write_landing(spark: SparkSession, sf_dir: str, path: str, dataset: str = "FD001") -> None:
    """Train, test and truth as headerless text; the truth files' order is the engines'."""
    for split, log in (("train", train_log(spark, sf_dir)), ("test", test_log(spark, sf_dir))):
        log.select(to_line()).write.mode("overwrite").text(f"{path}/{split}_{dataset}.txt")
    values = truth(spark, sf_dir).orderBy("engine_id").select(F.col(LABEL).cast("string"))
    values.write.mode("overwrite").text(f"{path}/RUL_{dataset}.txt")
