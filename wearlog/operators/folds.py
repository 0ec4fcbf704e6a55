"""Contiguous cross-validation folds without a global row number.

Only the ``k - 1`` places where a fold begins are looked up; every row then compares itself
with those literals, so the table itself is neither sorted nor shuffled.
"""

from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearlog.session import stored

FOLD = "fold"
_N = "_n_rows"

#: Counted values that one task sums up in order, at most about.
KEYS_PER_TASK = 1_000_000

# Types whose values travel through Python as they are; the others need an exact form there.
_AS_IS = {"tinyint", "smallint", "int", "bigint", "boolean", "string"}
# Types whose text says the value exactly (NaN included, which as a number would not equal itself).
_AS_TEXT = {"float", "double", "timestamp_ntz"}


def _sent(name: str, kind: str) -> Column:
    """The column's value in a form that no conversion alters."""
    column = F.col(name)
    if kind in _AS_IS:
        return column
    if kind == "timestamp":
        return F.unix_micros(column)
    if kind == "date":
        return F.unix_date(column)
    if kind == "binary":
        return F.hex(column)
    if kind in _AS_TEXT or kind.startswith("decimal"):
        return column.cast("string")
    raise ValueError(f"no folds by a column of type {kind}")


def _literal(value, kind: str) -> Column:
    """The value that ``_sent`` brought here, exactly, as a literal of its type."""
    if value is None:
        return F.lit(None).cast(kind)
    if kind == "timestamp":
        return F.timestamp_micros(F.lit(value).cast("long"))
    if kind == "date":
        return F.date_from_unix_date(F.lit(value))
    if kind == "binary":
        return F.unhex(F.lit(value))
    return F.lit(value).cast(kind)


def _starts(total: int, k: int) -> list[int]:
    """Row index at which folds 1 to k-1 begin; the first ``total % k`` folds get one row more."""
    if not 2 <= k <= total:
        raise ValueError(f"cannot cut {total} rows into {k} folds")
    size, larger = divmod(total, k)
    return [j * size + min(j, larger) for j in range(1, k)]


def _locate(blocks: DataFrame, block: str, starts: list[int]) -> DataFrame:
    """``start``, the ``block`` that holds it and the rows ``before`` that block (k-1 rows).

    ``blocks`` has the row count of each file or partition; it is short enough to be
    summed up in order by one task.
    """
    so_far = F.sum(_N).over(Window.orderBy(block).rowsBetween(Window.unboundedPreceding, 0))
    return (
        blocks.withColumn("upto", so_far)
        .withColumn("before", F.col("upto") - F.col(_N))
        .withColumn("start", F.explode(F.array(*[F.lit(s).cast("long") for s in starts])))
        .filter((F.col("before") <= F.col("start")) & (F.col("start") < F.col("upto")))
        .select("start", block, "before")
    )


def _fold(order: list[str], cuts: list[list[Column]]) -> Column:
    """How many cuts lie at or before the row."""
    here = F.struct(*order)
    at = [F.struct(*[v.alias(c) for v, c in zip(cut, order)]) for cut in cuts]
    return reduce(add, [(here >= cut).cast("int") for cut in at])


def _values_at(counted: DataFrame, order: list[str], starts: list[int]) -> dict[int, tuple]:
    """For each start: the values of ``order`` at that row of the table that ``counted`` sums up (rows per
    value, sorted by ``order``), the rows before that value, and its rows."""
    counted = stored(counted, "counted")
    parts = max(1, -(-counted.count() // KEYS_PER_TASK))
    # Sorted within ranges, the ids grow with the order and their upper bits tell the range.
    ranked = stored(
        counted.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", 33)),
        "ranked",
    )
    blocks = ranked.groupBy("_part").agg(F.sum(_N).alias(_N))
    wanted = _locate(blocks, "_part", starts).withColumnRenamed("_part", "_block")
    # At most k-1 ranges are looked into, each by one task.
    so_far = F.sum(_N).over(
        Window.partitionBy("start").orderBy("_id").rowsBetween(Window.unboundedPreceding, 0)
    )
    kinds = dict(counted.dtypes)
    found = (
        ranked.join(F.broadcast(wanted), F.col("_part") == F.col("_block"))
        .withColumn("upto", F.col("before") + so_far)
        .filter((F.col("upto") - F.col(_N) <= F.col("start")) & (F.col("start") < F.col("upto")))
        .select(
            "start",
            (F.col("upto") - F.col(_N)).alias("first"),
            F.col(_N).alias("n"),
            F.struct(*[_sent(c, kinds[c]).alias(c) for c in order]).alias("at"),
        )
        .collect()
    )
    return {r["start"]: (tuple(r["at"]), r["first"], r["n"]) for r in found}


def assign_folds(df: DataFrame, k: int, order: list[str], by_rows: bool = True) -> DataFrame:
    """Add ``fold`` 0..k-1: contiguous, equally large parts of the table sorted by ``order``.

    Rows that agree in all ``order`` columns share a fold, the last one that begins among them. If
    they outnumber a fold, an earlier one stays empty.
    ``by_rows=False`` counts distinct order values instead of rows: with ``["engine_id"]`` folds
    hold whole engines.

    The places are found a column at a time: first rows are counted per value of the first column, then,
    only within the values in which a fold begins, per value of the second, and so on. What is sorted is
    therefore as long as the longest of these lists, not as the table.
    """
    kinds = dict(df.dtypes)
    rows = df.select(*order) if by_rows else df.select(*order).distinct()
    starts: list[int] = []
    # Per fold that begins: the values found so far and the place of its first row among their rows.
    prefixes: list[tuple] = []
    offsets: list[int] = []
    sizes: dict[tuple, int] = {}
    for depth in range(1, len(order) + 1):
        columns = order[:depth]
        if depth == 1:
            counted = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias(_N))
            counted = stored(counted, "values")
            starts = _starts(counted.agg(F.sum(_N)).first()[0] or 0, k)
            prefixes, offsets, sizes = [()] * len(starts), starts, {(): 0}
        else:
            inside = [
                reduce(and_, [F.col(c).eqNullSafe(_literal(v, kinds[c])) for c, v in zip(order, prefix)])
                for prefix in sizes
            ]
            counted = (
                rows.filter(reduce(or_, inside)).groupBy(*columns).agg(F.count(F.lit(1)).alias(_N))
            )
        # Where the rows of each prefix begin among those looked at; prefixes come in order.
        begins, total = {}, 0
        for prefix, n in sizes.items():
            begins[prefix] = total
            total += n
        places = [begins[prefix] + offset for prefix, offset in zip(prefixes, offsets)]
        found = _values_at(counted, columns, places)
        prefixes = [found[place][0] for place in places]
        offsets = [place - found[place][1] for place in places]
        sizes = {found[place][0]: found[place][2] for place in places}
    cuts = [[_literal(v, kinds[c]) for v, c in zip(prefix, order)] for prefix in prefixes]
    return df.withColumn(FOLD, _fold(order, cuts))


def read_with_folds(spark: SparkSession, path: str, k: int) -> DataFrame:
    """A Parquet table with ``fold`` 0..k-1 over its rows as stored: files by path, then rows.

    For tables without a key. Counting needs no data column, and nothing is sorted.
    """
    order = ["_file", "_row"]
    df = spark.read.parquet(path).select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    files = df.groupBy("_file").agg(F.count(F.lit(1)).alias(_N))
    starts = _starts(files.agg(F.sum(_N)).first()[0] or 0, k)
    cuts = _locate(files, "_file", starts).select("_file", F.col("start") - F.col("before")).collect()
    at = [[F.lit(file), F.lit(row).cast("long")] for file, row in cuts]
    return df.withColumn(FOLD, _fold(order, at)).drop(*order)
