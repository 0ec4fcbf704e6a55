"""Landing text: sensor log lines and truth lines.

``skip_header`` drops the first line of every file, blank or not. It defaults to True, as the batch drop
has always been read that way; a file without a header then loses its first record, and in a
truth file every engine takes its neighbour's value. Pass False for such files.
"""

import logging
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wearlog.functions.text import (
    elements,
    fields,
    is_blank,
    numbers,
    plain_numbers,
    quick_fields,
    to_int,
    without_gaps,
)
from wearlog.operators.attach import attach
from wearlog.schema import LABEL, LOG_COLUMNS, LOG_TYPES
from wearlog.session import stored

log = logging.getLogger(__name__)

#: Where a line stands: its file, the split of it, and an id that grows within the split.
PLACE = ["file", "block", "id"]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value`` of each line and its place. The ids are only meaningful for one particular cut of the
    files into splits: store the rows before the places are compared."""
    return spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
    )


def parse_lines(lines: DataFrame) -> DataFrame:
    """Typed log columns, ``reject_reason`` (NULL for a good line), the raw ``line`` where there is a
    reason, and the place.

    A good line has exactly the expected fields, all of them finite numbers in plain notation, those of
    whole-number columns whole. Blank lines have the reason ``blank``; they are no records.
    """
    n = len(LOG_COLUMNS)
    split = lines.select(F.col("value").alias("line"), *PLACE, quick_fields(F.col("value")).alias("quick"))
    found = split.withColumn("found", numbers(F.col("line"), F.col("quick"), n))
    # NaN comes after all numbers.
    finite = (F.array_max("numbers") < F.lit(float("inf"))) & (F.array_min("numbers") > F.lit(float("-inf")))
    typed = found.withColumn("numbers", without_gaps(F.col("line"), F.col("found"), n)).select(
        *[
            (to_int(value) if LOG_TYPES[name] == "int" else value).alias(name)
            for name, value in zip(LOG_COLUMNS, elements(F.col("numbers"), n))
        ],
        "line",
        *PLACE,
        F.size("numbers").alias("n_fields"),
        F.size(F.array_compact("numbers")).alias("n_numbers"),
        finite.alias("finite"),
    )
    integers = [F.col(name).isNotNull() for name in LOG_COLUMNS if LOG_TYPES[name] == "int"]
    whole = reduce(and_, integers)
    reason = (
        F.when((F.col("n_fields") == n) & (F.col("n_numbers") == n) & F.col("finite") & whole, None)
        .when(is_blank(F.col("line")), "blank")
        .when(F.col("n_fields") != n, "field_count")
        .when(F.col("n_numbers") != n, "not_a_number")
        .when(~F.col("finite"), "not_finite")
        .otherwise("not_an_integer")
    )
    parsed = typed.select(*LOG_COLUMNS, "line", *PLACE, reason.alias("reject_reason"))
    kept = F.when(F.col("reject_reason").isNotNull(), F.col("line")).alias("line")
    return parsed.select(*LOG_COLUMNS, kept, "reject_reason", *PLACE)


def land_log(spark: SparkSession, path: str, skip_header: bool = True) -> DataFrame:
    """``parse_lines`` of a file or a directory of files, without headers and blank lines, stored.

    The text is read and parsed once; good rows and rejects are two filters over the stored table.
    """
    parsed = stored(parse_lines(read_lines(spark, path)), "parsed")
    if skip_header:
        first = F.min(F.when(F.col("block") == 0, F.struct("id", "reject_reason"))).alias("first")
        files = stored(parsed.groupBy("file").agg(first, F.count(F.lit(1)).alias("n_rows")), "files")
        marked = attach(parsed, files.select("file", "n_rows", F.col("first.id").alias("header")), "file")
        is_header = (F.col("block") == 0) & (F.col("id") == F.col("header"))
        _warn(path, files.filter(F.col("first.id").isNotNull() & F.col("first.reject_reason").isNull()))
        parsed = marked.filter(~F.coalesce(is_header, F.lit(False))).drop("header")
    return parsed.filter(F.col("reject_reason").isNull() | (F.col("reject_reason") != "blank"))


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).select(*LOG_COLUMNS)


def rejected_lines(parsed: DataFrame) -> DataFrame:
    """``line, reject_reason, file`` of all but good and blank lines."""
    bad = F.col("reject_reason").isNotNull() & (F.col("reject_reason") != "blank")
    return parsed.filter(bad).select("line", "reject_reason", "file")


def number_lines(spark: SparkSession, path: str, skip_header: bool = True) -> DataFrame:
    """``line_no`` (from 1, over the files in path order) and ``value`` of each line.

    No task ever sees more than one file split: a line's number is its place within its split
    plus the lines of all splits before it.
    """
    stamped = stored(read_lines(spark, path), "lines")
    header = F.when(F.col("block") == 0, 1).otherwise(0) if skip_header else F.lit(0)
    # One row per split (some 100 MB of text), so the ordered window is over a short table.
    earlier = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        stamped.groupBy("file", "block")
        .agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n_rows"))
        .withColumn("header", header)
        .withColumn("before", F.sum(F.col("n_rows") - F.col("header")).over(earlier))
        .withColumn("first_id", F.col("first_id") + F.col("header"))
        .drop("header")
    )
    if skip_header:
        _warn(path, _headers(stamped).filter(_label(F.col("value")).isNotNull()))
    place = F.coalesce("before", F.lit(0)) + F.col("id") - F.col("first_id") + 1
    return (
        attach(stamped, splits, "file", "block")
        .filter(F.col("id") >= F.col("first_id"))
        .select(place.alias("line_no"), "value")
    )


def _headers(stamped: DataFrame) -> DataFrame:
    """The first line of each file."""
    first = stamped.filter("block = 0").groupBy("file").agg(F.min(F.struct("id", "value")).alias("h"))
    return first.select("file", "h.value")


def _warn(path: str, records: DataFrame) -> int:
    """Log a warning for files whose dropped line reads as a record; returns their number."""
    found = records.agg(F.count_distinct("file").alias("n"), F.min("file").alias("example")).first()
    if found["n"]:
        log.warning(
            "%s: the first line of %d files was skipped but looks like data, e.g. in %s; see skip_header",
            path,
            found["n"],
            found["example"],
        )
    return found["n"]


def _label(value: Column) -> Column:
    """The one whole number a truth line holds, else NULL."""
    found = plain_numbers(fields(value))
    return to_int(F.when(F.size(found) == 1, F.get(found, F.lit(0))))


def parse_truth(numbered: DataFrame) -> DataFrame:
    """``engine_id``, ``RUL`` from numbered truth lines: the line's number is the engine.

    A line that is not one whole number keeps its place, with a NULL label.
    """
    return numbered.select(
        F.col("line_no").cast("int").alias("engine_id"), _label(F.col("value")).alias(LABEL)
    )


def rejected_truth(numbered: DataFrame) -> DataFrame:
    return numbered.filter(_label(F.col("value")).isNull())
