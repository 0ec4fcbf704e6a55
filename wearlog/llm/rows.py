"""What the operators share on the side of Spark."""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearlog.llm.flat import SLICE_BYTES, slices

UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A word, once A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: What names a row: its id and 64 bits of its text.
DOC = ["doc_id", "text_key"]
#: A broadcast side has this many rows at most, of about 100 bytes.
MOST_BROADCAST_ROWS = 100_000
#: And where rows may have any width: this many bytes.
MOST_BROADCAST_BYTES = 10_000_000
#: A batch of rows on its way to Python has about this many bytes at most, or one longer row.
BATCH_BYTES = 2 * SLICE_BYTES
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BLANK = "\x20\x09\x0a\x0b\x0c\x0d"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else. Pure ASCII takes the fast built-in."""
    pure = F.octet_length(text) == F.char_length(text)
    return F.when(pure, F.lower(text)).otherwise(F.translate(text, UPPER, LOWERED))


def words_of(text: Column) -> Column:
    """The words of a text in order, A-Z lower-cased; null has none."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def measured(table: DataFrame, limit: int = MOST_BROADCAST_ROWS) -> DataFrame:
    """The stored table, to be broadcast if it is small enough."""
    return F.broadcast(table) if table.count() <= limit else table


def row_bytes(table: DataFrame) -> Column:
    """About the bytes of a row: texts and lists as long as they are, other values 8."""

    def of(name: str, kind: str) -> Column:
        column = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            return F.coalesce(F.octet_length(column), F.lit(0)) + 16
        if kind.startswith(("array", "struct", "map")):
            return F.octet_length(F.to_json(F.struct(column))) + 16
        return F.lit(8)

    return sum((of(name, kind) for name, kind in table.dtypes), F.lit(16)).cast("long")


def measured_bytes(table: DataFrame, limit: int | None = None) -> DataFrame:
    """The stored table, to be broadcast if all its rows together are small enough."""
    size = table.agg(F.sum(row_bytes(table))).first()[0] or 0
    return F.broadcast(table) if size <= (MOST_BROADCAST_BYTES if limit is None else limit) else table


def join(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Join on columns of the same name; null ids are equal."""
    renamed = right.select(*[F.col(c).alias(f"{c}_" if c in names else c) for c in right.columns])
    condition = F.lit(True)
    for name in names:
        same = F.col(name).eqNullSafe if name == "doc_id" else F.col(name).__eq__
        condition = condition & same(F.col(f"{name}_"))
    joined = left.join(renamed, condition, how)
    return joined.drop(*[f"{name}_" for name in names])


def unused(docs: DataFrame, name: str) -> str:
    """The name, lengthened until no column has it."""
    taken = {column.lower() for column in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def in_batches(rows: DataFrame) -> DataFrame:
    """The table; from now on its session hands rows to Python in batches of ``BATCH_BYTES``, unless it was
    given such a limit already. By number alone, 10,000 whole texts would be one batch, of any size.

    Spark looks the setting up in the session when a plan runs, so it stays.
    """
    conf = rows.sparkSession.conf
    if conf.get(_BATCH_BYTES, None) is None:
        conf.set(_BATCH_BYTES, str(BATCH_BYTES))
    return rows


def scan(
    docs: DataFrame,
    keep: list[str],
    text: Column,
    work: Callable[[pa.RecordBatch], list[pa.Array]],
    fields: str,
    prefix: str = "",
) -> DataFrame:
    """The columns ``keep`` of every row, then the new ``fields`` that ``work`` computes.

    ``work`` gets slices of batches whose last column is ``text`` (bounded by ``SLICE_BYTES``) and
    returns one array per field. Kept columns travel under neutral names, so none can clash with the
    text's or with one another; a field that would clash gets ``prefix``.
    """
    inner = [F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(keep)]
    kinds = dict(docs.dtypes)
    kept = [f"c{i} {kinds[name]}" for i, name in enumerate(keep)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body"):
                columns = part.columns[:-1] + work(part)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    new = [f"f{i} {field.strip().split(' ', 1)[1]}" for i, field in enumerate(fields.split(";"))]
    names = [x.split(" ")[0] for x in kept + new]
    called = [field.strip().split(" ")[0] for field in fields.split(";")]
    rows = in_batches(docs.select(*inner, text.alias("body")))
    out = rows.mapInArrow(run, ", ".join(kept + new))
    return out.select(
        *[F.col(f"c{i}").alias(name) for i, name in enumerate(keep)],
        *[
            F.col(f"f{i}").alias(prefix + name if name in keep else name)
            for i, name in enumerate(called)
        ],
    )
