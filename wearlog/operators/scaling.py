"""Standardisation of sensors, fitted on one table and applied to any."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearlog.schema import sensor_columns

# Whole-stage code generation gives up on operators with more than 100 fields, which makes the
# aggregation several times slower. Wide logs are therefore aggregated in groups of sensors; each
# group reads only its own columns.
MAX_FIELDS = 100


def _aggregate(log: DataFrame, measures: dict, fields: int) -> DataFrame:
    """One row of ``measures`` of each sensor; they keep ``fields`` values while aggregating."""
    sensors = sensor_columns(log)
    size = max(1, (MAX_FIELDS - 1) // fields)
    parts = [
        log.agg(*[f(s).alias(f"{name}_{s}") for s in group for name, f in measures.items()])
        for group in (sensors[i : i + size] for i in range(0, len(sensors), size))
    ]
    if len(parts) == 1:
        return parts[0]
    # One row per group, each with NULL in the other groups' columns: max picks the value.
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return rows.agg(*[F.max(c).alias(c) for part in parts for c in part.columns])


def _deviation(name: str) -> Column:
    """Sample deviation, exactly 0 for a constant sensor.

    Combining the deviations of many partitions can leave a rounding error instead of 0, and a
    constant sensor would be divided by it.
    """
    std = F.stddev_samp(name)
    constant = (F.min(name) == F.max(name)) & std.isNotNull()
    return F.when(constant, 0.0).otherwise(std)


def fit_stats(log: DataFrame) -> DataFrame:
    """One row: ``mean_<sensor>`` and sample deviation ``std_<sensor>`` of each sensor."""
    return _aggregate(log, {"mean": F.mean, "std": _deviation}, fields=7)


def range_profile(log: DataFrame) -> DataFrame:
    """One row: ``min_<sensor>`` and ``max_<sensor>`` of each sensor."""
    return _aggregate(log, {"min": F.min, "max": F.max}, fields=2)


def apply_stats(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Sensors as distances from the mean in deviations; works on streams too.

    A sensor whose deviation is 0 or unknown keeps its raw values. The single row of
    statistics is fetched and becomes literals of the plan.
    """
    values = stats.first().asDict()

    def scaled(name: str):
        mean, std = values.get(f"mean_{name}"), values.get(f"std_{name}")
        if not name.startswith("sensor_") or std is None or std == 0:
            return F.col(name)
        return ((F.col(name) - F.lit(mean)) / F.lit(std)).alias(name)

    return df.select(*[scaled(name) for name in df.columns])
