"""Model error as an aggregate expression."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def rmse(label: Column, prediction: Column) -> Column:
    """Root mean squared error; rows without a label or prediction do not count."""
    return F.sqrt(F.avg(F.pow(label - prediction, F.lit(2.0))))
