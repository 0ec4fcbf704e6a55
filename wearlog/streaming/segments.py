"""Event logs in segment files, read as a stream with an offset per partition.

A log is a folder with a folder per partition, which holds append-only segments ``<first>-<n>.seg``: the
records from offset ``first`` on, each four bytes of length and a binary body. A segment appears whole, by a
rename, and never changes, so names alone say how far each partition reaches.

A batch takes at most ``max_records`` records of each partition; every piece of a segment is a task's. The
folder is a path that the driver and all executors mount.
"""

import json
import os
import struct
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from wearlog.streaming.spool import mounted

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_RECORDS = 1_000_000
RECORD = "partition string, offset long, body binary"
_BATCH = 4096


def segments(folder: str, partition: str) -> list[tuple[int, int, str]]:
    """First offset, number of records and path of a partition's segments, in order."""
    found = []
    for name in os.listdir(f"{folder}/{partition}"):
        if name.endswith(".seg"):
            first, n = name[:-4].split("-")
            found.append((int(first), int(n), f"{folder}/{partition}/{name}"))
    return sorted(found)


def log_ends(folder: str) -> dict[str, int]:
    """The offset behind the last record of every partition."""
    ends = {}
    for partition in sorted(os.listdir(folder)) if os.path.isdir(folder) else []:
        if not partition.startswith(".") and os.path.isdir(f"{folder}/{partition}"):
            own = segments(folder, partition)
            ends[partition] = own[-1][0] + own[-1][1] if own else 0
    return ends


def append_segment(folder: str, partition: str, bodies: Iterator[bytes]) -> int:
    """Append records as one segment; returns how many. A partition has one writer at a time."""
    path = f"{mounted(folder)}/{partition}"
    os.makedirs(path, exist_ok=True)
    own = segments(mounted(folder), partition)
    first = own[-1][0] + own[-1][1] if own else 0
    hidden, n = f"{path}/.{uuid.uuid4().hex}", 0
    with open(hidden, "wb") as file:
        for body in bodies:
            file.write(struct.pack("<I", len(body)) + body)
            n += 1
    os.rename(hidden, f"{path}/{first:020d}-{n}.seg") if n else os.unlink(hidden)
    return n


def write_segments(events: DataFrame, folder: str, partitions: int) -> None:
    """Append events (column ``body``) to a log, dealt to its partitions, one segment each. A task that Spark runs
    again appends again, as producers of logs do."""
    path = mounted(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by: dict[int, list[bytes]] = {}
        for batch in batches:
            for number, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by.setdefault(number, []).append(body)
        for number, bodies in by.items():
            yield pa.RecordBatch.from_pydict({"n": [append_segment(path, str(number), iter(bodies))]})

    body = F.col("body").cast("binary")
    dealt = events.select(F.pmod(F.xxhash64(body), F.lit(partitions)).alias("number"), body.alias("body"))
    dealt.repartition(partitions, "number").mapInArrow(run, "n long").agg(F.sum("n")).collect()


@dataclass
class Piece(InputPartition):
    """Records ``start`` to ``end`` of a partition, which lie in one segment from ``first`` on."""

    partition: str
    path: str
    first: int
    start: int
    end: int


def _records(file, n: int) -> Iterator[bytes]:
    for _ in range(n):
        (size,) = struct.unpack("<I", file.read(4))
        yield file.read(size)


class SegmentReader(DataSourceStreamReader):
    def __init__(self, folder: str, progress: str, max_records: int):
        self.folder, self.progress, self.max_records = folder, progress, max_records
        self.last: dict[str, int] | None = None

    def initialOffset(self) -> dict:
        return {}

    def _known(self) -> dict[str, int]:
        """How far the stream has come: of this run, else as the last run noted."""
        if self.last is None:
            self.last = {}
            if os.path.exists(self.progress):
                with open(self.progress, encoding="utf-8") as file:
                    self.last = json.load(file)
        return self.last

    def latestOffset(self) -> dict:
        known = self._known()
        self.last = {
            p: max(known.get(p, 0), min(end, known.get(p, 0) + self.max_records))
            for p, end in log_ends(self.folder).items()
        }
        self._note(self.last)
        return self.last

    def _note(self, offsets: dict) -> None:
        # Before Spark notes the batch, so a later run never goes back behind it; after a failure in between, the
        # next batch takes what two may take.
        os.makedirs(os.path.dirname(self.progress), exist_ok=True)
        hidden = f"{self.progress}.{uuid.uuid4().hex}"
        with open(hidden, "w", encoding="utf-8") as file:
            json.dump(offsets, file)
        os.replace(hidden, self.progress)

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        pieces = []
        for partition, stop in end.items():
            begin = start.get(partition, 0)
            for first, n, path in segments(self.folder, partition) if stop > begin else ():
                low, high = max(begin, first), min(stop, first + n)
                if low < high:
                    pieces.append(Piece(partition, path, first, low, high))
        return pieces

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        with open(partition.path, "rb") as file:
            for _ in range(partition.start - partition.first):
                (size,) = struct.unpack("<I", file.read(4))
                file.seek(size, os.SEEK_CUR)
            for at in range(partition.start, partition.end, _BATCH):
                n = min(_BATCH, partition.end - at)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([partition.partition] * n, pa.string()),
                        pa.array(range(at, at + n), pa.int64()),
                        pa.array(_records(file, n), pa.binary()),
                    ],
                    names=["partition", "offset", "body"],
                )

    def commit(self, end: dict) -> None:
        """Offsets are in the query's checkpoint; segments stay."""


class Segments(DataSource):
    @classmethod
    def name(cls) -> str:
        return "segments"

    def schema(self) -> str:
        return RECORD

    def streamReader(self, schema) -> SegmentReader:
        options = self.options
        limit = int(options.get("maxrecords", MAX_RECORDS))
        return SegmentReader(mounted(options["path"]), mounted(options["progress"]), limit)


def read_segments(
    spark: SparkSession, folder: str, progress: str, max_records: int = MAX_RECORDS
) -> DataFrame:
    """The log as a stream of ``partition, offset, body``. ``progress`` is a file, one for each query, beside
    its checkpoint, that says how far a batch may have been planned."""
    spark.dataSource.register(Segments)
    stream = spark.readStream.format("segments").option("path", folder)
    return stream.option("progress", progress).option("maxRecords", max_records).load()
