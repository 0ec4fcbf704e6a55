"""Join of rows with a one-row-per-key table that holds up when a few keys own most rows."""

from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearlog.session import stored

BROADCAST_BYTES = 64 << 20
HOT_ROWS = 2_000_000
#: Keys that own very many rows are few; up to this size they are broadcast whatever the limit.
HOT_KEY_BYTES = 1 << 20

# Bytes of an entry of the broadcast hash table, on the safe side: per entry, per column, and the
# text itself.
_ENTRY_BYTES = 48
_VALUE_BYTES = 8
_FIXED_WIDTH = {
    "tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "date", "timestamp", "timestamp_ntz",
}
# Values of other widths, in multiples of ``_VALUE_BYTES``: a decimal's number may take 16 bytes.
_WIDE = {"decimal": 3}
_COUNTED = {"string", "binary"}

_OWNED = "_rows_of_key"


def _row_bytes(df: DataFrame) -> Column:
    """A row's size in a broadcast."""
    kinds = {name: kind.split("(")[0] for name, kind in df.dtypes}
    unknown = set(kinds.values()) - _FIXED_WIDTH - _COUNTED - set(_WIDE)
    if unknown:
        raise ValueError(f"no size known for columns of type {sorted(unknown)}")
    values = sum(_WIDE.get(kind, 1) for kind in kinds.values())
    fixed = F.lit(_ENTRY_BYTES + _VALUE_BYTES * values).cast("long")
    counted = [name for name, kind in kinds.items() if kind in _COUNTED]
    return reduce(add, [F.coalesce(F.octet_length(name), F.lit(0)) for name in counted], fixed)


def attach(
    rows: DataFrame,
    per_key: DataFrame,
    *keys: str,
    n_rows: str = "n_rows",
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``rows`` left-joined with ``per_key`` on ``keys`` (NULL matches NULL).

    ``per_key`` has one row per key, which is checked, and says in column ``n_rows`` how many rows the key
    owns; that column is not part of the result. Its other columns must not be columns of ``rows``. Its
    size is measured:

    - up to ``broadcast_bytes`` it is broadcast, and ``rows`` is not shuffled;
    - beyond, keys owning more than ``hot_rows`` rows are broadcast and only the remaining
      rows are shuffled, so no task gets more of one key than that. There are at most
      ``total / hot_rows`` hot keys; the limit is raised until those fit the broadcast, for which
      ``HOT_KEY_BYTES`` are always free.
    """
    names = {key: f"_key_{key}" for key in keys}
    clash = (set(per_key.columns) - set(keys) - {n_rows}) & set(rows.columns)
    if clash:
        raise ValueError(f"columns of both tables: {sorted(clash)}")
    side = stored(per_key.withColumnsRenamed(names | {n_rows: _OWNED}), "per_key")
    size = _row_bytes(side)
    distinct = F.count_distinct(F.struct(*names.values()))
    bytes_, widest, total, n, n_keys = side.agg(
        F.sum(size), F.max(size), F.sum(_OWNED), F.count(F.lit(1)), distinct
    ).first()
    if n != n_keys:
        raise ValueError(f"{n} rows for {n_keys} keys {list(keys)}")

    def joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        same = [F.col(key).eqNullSafe(F.col(name)) for key, name in names.items()]
        return left.join(right, reduce(and_, same), how)

    def done(df: DataFrame) -> DataFrame:
        return df.drop(*names.values(), _OWNED)

    if bytes_ is None or bytes_ <= broadcast_bytes:
        return done(joined(rows, F.broadcast(side), "left"))

    # Spark goes by file sizes, which understate well compressed tables: no broadcast of its own.
    most_hot = max(1, max(broadcast_bytes, HOT_KEY_BYTES) // widest)
    limit = max(hot_rows, -(-total // most_hot))
    hot = side.filter(F.col(_OWNED) > limit)
    if hot.isEmpty():
        return done(joined(rows, side.hint("merge"), "left"))
    cold_rows = joined(rows, F.broadcast(hot.select(*names.values())), "left_anti")
    cold = done(joined(cold_rows, side.filter(F.col(_OWNED) <= limit).hint("merge"), "left"))
    return done(joined(rows, F.broadcast(hot), "inner")).unionByName(cold)
