"""Layer tables: Parquet directories."""

import uuid

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """A layer table. ``merge_schema`` shows the columns of all appends, not of one file."""
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def overwrite_table(df: DataFrame, path: str) -> None:
    """Replace a table. The new one is written beside it and takes its place by two renames: if writing fails,
    the old one stays, and ``df`` may be computed from it. Tables with readers at any time are better kept in
    versions (``sources.commits``)."""
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    place = hadoop.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    beside = f"{path.rstrip('/')}".rsplit("/", 1)
    new, old = (hadoop.Path(f"{beside[0]}/.{beside[1]}-{what}-{uuid.uuid4().hex}") for what in ("new", "old"))
    try:
        df.write.parquet(new.toString())
        had = files.exists(place)
        if had and not files.rename(place, old):
            raise OSError(f"{path} cannot be replaced")
        if not files.rename(new, place):
            if had:
                files.rename(old, place)
            raise OSError(f"{path} cannot be written")
    finally:
        files.delete(new, True)
        if files.exists(place):
            files.delete(old, True)


def append_table(df: DataFrame, path: str) -> None:
    """Append rows; they may have columns the table did not have before."""
    df.write.mode("append").parquet(path)


def preview(df: DataFrame, n: int = 5, order: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows, in ``order`` if given."""
    return (df.orderBy(*order) if order else df).limit(n)


def folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the tables (folders) below a path, in order."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)
    return sorted(status.getPath().getName() for status in found if status.isDirectory())
