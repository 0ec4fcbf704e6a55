"""Line dedup (operator 10): a sharded minimal perfect hash over distinct line hashes.

1. Every document yields the hashes of its distinct long lines, stored once.
2. Spark counts documents and the largest id per hash, combining before the shuffle: a line that a
   third of all documents hold is one row per task.
3. Each shard of hashes becomes a minimal perfect hash whose slots index three compact arrays:
   fingerprint, number of documents (a byte, which saturates) and the id that keeps it.
4. Documents probe the arrays: the stored (hash, id) pairs of a shard meet its arrays in groups of at
   most ``GROUP_ROWS`` pairs. Lines are never joined with lines, nor texts with texts.
5. Each document gets the list of its own hashes to drop.

Two lines count as equal if their 64-bit hashes are equal.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wearlog.llm.flat import U64
from wearlog.llm.perfect_hash import PerfectHash, fingerprints
from wearlog.llm.rows import BLANK, in_batches
from wearlog.session import stored

#: Distinct hashes of a shard, about, and pairs that probe it in one group, at most about.
SHARD_HASHES, GROUP_ROWS = 50_000, 100_000
#: Up to so many shards the number of groups of each (12 bytes) is broadcast, else joined by shuffle.
MOST_BROADCAST_SHARDS = 500_000
#: Numbers of documents are kept in a byte.
MOST_COUNTED = 255
STRIPPED = BLANK.encode()


def line_key(line: bytes) -> bytes:
    return line.strip(STRIPPED).lower()


def _points_reach(key: bytes, least: int) -> bool:
    """Whether the key has ``least`` code points."""
    if len(key) < least:
        return False
    return len(key) >= 4 * least or len(key.decode("utf-8", "replace")) >= least


def line_hashes(text: bytes, min_points: int) -> list[int | None]:
    """The signed hash of each line's key, None for keys that are too short."""
    out = []
    for line in text.split(b"\n"):
        key = line_key(line)
        if _points_reach(key, min_points):
            n = xxhash.xxh3_64_intdigest(key)
            out.append(n - (1 << 64) if n >> 63 else n)
        else:
            out.append(None)
    return out


def _pairs(min_points: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, owners = [], []
            for i, text in enumerate(batch.column(2).cast(pa.binary())):
                own = {h for h in line_hashes(text.as_py() or b"", min_points) if h is not None}
                hashes.extend(own)
                owners.extend([i] * len(own))
            rows = pa.array(owners, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes, pa.int64()), batch.column(0).take(rows), batch.column(1).take(rows)],
                names=["hash", "id", "own"],
            )

    return run


def _ids(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values, 0 for null, and which are known."""
    return (
        column.fill_null(0).to_numpy(),
        column.is_valid().to_numpy(),
    )


def _index(key: tuple, group: pa.Table) -> pa.Table:
    """One shard: its perfect hash, and the arrays in the order of the slots."""
    hashes = group["hash"].to_numpy().view(U64)
    keepers, known = _ids(group["keeper"])
    table = PerfectHash.build(hashes)
    slot = table.slots(hashes)
    arrays = {
        "prints": fingerprints(hashes),
        "counts": np.minimum(group["n_docs"].to_numpy(), MOST_COUNTED).astype(np.uint8),
        "keepers": keepers,
        "known": known,
    }
    blobs = {"bits": table.bits, "before": table.before, "rest": table.rest}
    for name, values in arrays.items():
        blobs[name] = np.empty_like(values)
        blobs[name][slot] = values
    return pa.table(
        {"shard": [key[0].as_py()], "sizes": [table.sizes.tolist()]}
        | {name: pa.array([values.tobytes()], pa.binary()) for name, values in blobs.items()}
    )


INDEX_SCHEMA = "shard long, sizes array<long>, " + ", ".join(
    f"{name} binary"
    for name in ("bits", "before", "rest", "prints", "counts", "keepers", "known")
)


def _probe(min_docs: int):
    def run(pairs: pa.Table, index: pa.Table) -> pa.Table:
        if pairs.num_rows == 0:
            return pa.table({name: pa.array([], pa.int64()) for name in ("id", "own", "hash")})
        row = index.to_pylist()[0]
        array = lambda name, kind: np.frombuffer(row[name], kind)
        table = PerfectHash(
            np.array(row["sizes"], np.int64),
            array("bits", np.uint8),
            array("before", np.int64),
            array("rest", U64),
        )
        hashes = pairs["hash"].to_numpy()
        ids, known = _ids(pairs["id"])
        slot = table.slots(hashes.view(U64))
        found = slot >= 0
        found &= array("prints", np.uint32)[slot] == fingerprints(hashes.view(U64))
        kept = (array("known", bool)[slot] == known) & (
            ~known | (array("keepers", np.int64)[slot] == ids)
        )
        drop = np.flatnonzero(found & (array("counts", np.uint8)[slot] >= min_docs) & ~kept)
        rows = pa.array(drop)
        return pa.table({"id": pairs["id"].take(rows), "own": pairs["own"].take(rows), "hash": hashes[drop]})

    return run


def _own(id: Column, text: Column) -> Column:
    return F.when(id.isNull(), F.xxhash64(text)).otherwise(0)


def lines_to_drop(
    docs: DataFrame, id: str, text: str, min_docs: int = 3, min_points: int = 20
) -> DataFrame:
    """``id, own`` and ``drops``, the hashes of the lines that documents of this id lose. Rows without an id
    are told apart by ``own``, 64 bits of their text (0 for all others), so that they are no hot key."""
    if not 1 <= min_docs <= MOST_COUNTED:
        raise ValueError(f"min_docs must be within 1 and {MOST_COUNTED}")
    rows = docs.select(
        F.col(id).cast("long").alias("id"), _own(F.col(id), F.col(text)).alias("own"), F.col(text).alias("text")
    )
    pairs = stored(
        in_batches(rows).mapInArrow(_pairs(min_points), "hash long, id long, own long"), "line-pairs"
    )
    shards = max(1, -(-pairs.count() // SHARD_HASHES))
    shard = F.pmod(F.xxhash64("hash"), F.lit(shards)).alias("shard")
    # Each row of a document holds a line once, so the rows of a hash are its documents.
    lines = pairs.groupBy("hash").agg(
        F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("keeper")
    )
    index = lines.select("*", shard).groupBy("shard").applyInArrow(_index, INDEX_SCHEMA)
    sharded = pairs.select("*", shard)
    # A shard whose lines are held by many documents is probed by several groups.
    groups = sharded.groupBy("shard").agg(
        F.ceil(F.count(F.lit(1)) / GROUP_ROWS).cast("int").alias("n_groups")
    )
    groups = F.broadcast(groups) if shards <= MOST_BROADCAST_SHARDS else groups
    index = index.join(groups, "shard").select(
        "*", F.explode(F.sequence(F.lit(0), F.col("n_groups") - 1)).alias("part")
    )
    part = F.pmod(F.xxhash64("id", "own", "hash"), F.col("n_groups")).cast("int").alias("part")
    dropped = (
        sharded.join(groups, "shard")
        .select("shard", part, "hash", "id", "own")
        .groupBy("shard", "part")
        .cogroup(index.drop("n_groups").groupBy("shard", "part"))
        .applyInArrow(_probe(min_docs), "id long, own long, hash long")
    )
    return dropped.groupBy("id", "own").agg(F.collect_set("hash").alias("drops"))


def _rebuild(at: int, min_points: int, with_counts: bool):
    """``at``: the place of the text; the last column has the hashes to drop."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            for value, drops in zip(
                batch.column(at).cast(pa.binary()), batch.column(batch.num_columns - 1)
            ):
                text = value.as_py()
                lost = set(drops.as_py() or ())
                lines = (text or b"").split(b"\n")
                if lost and text:
                    hashes = line_hashes(text, min_points)
                    left = [line for line, h in zip(lines, hashes) if h is None or h not in lost]
                    text = b"\n".join(left)
                    n_dropped.append(len(lines) - len(left))
                else:
                    n_dropped.append(0)
                texts.append(text)
                n_lines.append(len(lines))
            columns = batch.columns[:-1]
            columns[at] = pa.array(texts, pa.binary()).cast(batch.column(at).type)
            names = batch.schema.names[:-1]
            if with_counts:
                columns += [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
                names = [*names, "n_lines", "n_dropped"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def drop_common_lines(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    min_docs: int = 3,
    min_points: int = 20,
    counts: tuple[str, str] | None = ("n_lines", "n_dropped"),
) -> DataFrame:
    """The documents without the lines that at least ``min_docs`` of them hold.

    A line's key is the line without white space at its ends, A-Z lower-cased. Lines whose key has
    ``min_points`` code points or more and stands in ``min_docs`` rows or more are dropped from every
    document but the one with the largest id that holds the key; there all of them stay.

    - Returns the columns of ``docs`` with the shortened text, and the lines before dropping and those
      dropped under the names ``counts`` (left out for None).
    - ``id`` must be an integer. A null text is one empty line and stays null. A null id counts as a
      document and is smaller than any other id.
    - Repeated rows count as documents of their own; rows that share an id share its decision.
    - An empty table gives an empty table. Other columns pass through, whatever their names.
    """
    names = docs.columns
    columns = [F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(names)]
    at, key = names.index(text), f"c{names.index(id)}"
    lost = lines_to_drop(docs, id, text, min_docs, min_points)
    # The smaller side is hashed; texts are dealt by id but not sorted.
    rows = docs.select(*columns)
    same = rows[key].cast("long").eqNullSafe(lost["id"]) & (_own(rows[key], rows[f"c{at}"]) == lost["own"])
    joined = rows.join(lost.hint("shuffle_hash"), same, "left").drop("id", "own")
    fields = ", ".join(f"c{i} {kind}" for i, (_, kind) in enumerate(docs.dtypes))
    if counts:
        fields += ", n_lines long, n_dropped long"
    kept = in_batches(joined).mapInArrow(_rebuild(at, min_points, bool(counts)), fields)
    renamed = [F.col(f"c{i}").alias(name) for i, name in enumerate(names)]
    extra = [F.col(a).alias(b) for a, b in zip(("n_lines", "n_dropped"), counts or ())]
    return kept.select(*renamed, *extra)
