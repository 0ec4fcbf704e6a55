"""Column expressions for raw text: fields, numbers, timestamps."""

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A number in plain decimal notation, or one of the words for what is not finite. Casts alone would
#: also take type suffixes and hexadecimal digits ("1d", "0x1p3").
_PLAIN_NUMBER = r"(?i)^[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?$|^[+-]?(nan|inf|infinity)$"
#: What only other notations have.
_ODD_LETTER = r"[dDfFxXpP]"


def _plain(line: Column) -> Column:
    """The line without quotes and outer spaces.

    Quotes go first: a space inside an outer quote would otherwise become an empty first field
    and shift every column.
    """
    return F.trim(F.replace(line, F.lit('"'), F.lit("")))


def fields(line: Column) -> Column:
    """The line's white-space separated fields, quotes removed; one empty field if it is blank."""
    return F.split(F.trim(F.regexp_replace(_plain(line), r"\s+", " ")), " ")


def to_numbers(texts: Column) -> Column:
    """An array of texts as doubles, NULL where one is no number, whatever the ANSI setting."""
    return texts.try_cast("array<double>")


def plain_numbers(texts: Column) -> Column:
    """``to_numbers`` for texts in plain decimal notation; NULL for any other."""
    return to_numbers(F.transform(texts, lambda x: F.when(F.rlike(x, F.lit(_PLAIN_NUMBER)), x)))


def elements(array: Column, n: int) -> list[Column]:
    """The first ``n`` elements, NULL where there are fewer."""
    return [F.get(array, F.lit(i)) for i in range(n)]


def quick_fields(line: Column) -> Column:
    """What lies between single spaces: the line's fields if it has no other white space."""
    return F.split(_plain(line), " ")


def numbers(line: Column, quick: Column, n: int) -> Column:
    """The line's fields as doubles, NULL where one is no number in plain notation.

    Most lines have their ``n`` fields in ``quick`` and no letter that another notation has. Only the others
    need the slower pattern matching. The number of fields is looked at first, as failed casts are the
    slowest way.
    """
    easy = (F.size(quick) == n) & ~F.rlike(line, F.lit(_ODD_LETTER))
    return F.when(easy, to_numbers(quick)).otherwise(plain_numbers(fields(line)))


def without_gaps(line: Column, found: Column, n: int) -> Column:
    """``numbers`` again for lines whose ``n`` quick fields were not all numbers.

    Other white space than spaces may be the reason. Both steps should be columns of their own,
    as expressions they would be computed several times.
    """
    whole = (F.size(found) != n) | (F.size(F.array_compact(found)) == n)
    return F.when(whole, found).otherwise(plain_numbers(fields(line)))


def is_blank(line: Column) -> Column:
    return F.get(fields(line), F.lit(0)) == ""


def to_int(number: Column) -> Column:
    """A double as int, NULL if it is not whole or does not fit. Whole numbers may be written "1.0"."""
    return F.when(number == F.floor(number), number.try_cast("int"))


def all_finite(columns: list[Column]) -> Column:
    """True if every column holds a finite number, NULL if any is NULL, else False.

    ``x * 0`` is 0 for a finite x, NaN for NaN and the infinities, NULL for NULL, so one sum
    answers for all columns.
    """
    return reduce(add, [column * F.lit(0.0) for column in columns]) == F.lit(0.0)


def utc_text(moment: Column) -> Column:
    """A timestamp as ``2024-01-31T23:59:59Z``."""
    utc = F.to_utc_timestamp(moment, F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")
