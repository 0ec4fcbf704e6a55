"""Hand-over of messages: a streaming sink with commit and abort, bounded retries and a record of failures.

Tasks hand every message to ``send``; what succeeds and what fails after ``attempts`` tries is written to
pending files in the spool folder. When all tasks of a batch are done, its files become one folder
``batch-<number>`` by a rename: a batch that is run again after a failure counts once, an aborted one leaves
nothing. ``send`` itself may see a message again then, so what it does elsewhere must bear repetition.

The spool folder is a path that the driver and all executors mount.
"""

import json
import os
import shutil
import sys
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

# What runs in tasks is sent along whole: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ATTEMPTS = 3
DELIVERED, FAILED = "delivered", "failed"
FAILED_SCHEMA = "value string, error string, attempts int"


def mounted(path: str) -> str:
    """The path as this machine mounts it."""
    plain = path.removeprefix("file://") if path.startswith("file://") else path.removeprefix("file:")
    if "://" in plain:
        raise ValueError(f"{path} is no mounted folder")
    return plain


@dataclass
class Pending(WriterCommitMessage):
    """The files that a task left, and how many messages are in each."""

    files: dict[str, int]


class SpoolWriter(DataSourceStreamWriter):
    def __init__(self, folder: str, send: Callable[[str], None] | None, attempts: int):
        self.folder, self.send, self.attempts = folder, send, attempts

    def _try(self, value: str) -> str | None:
        """Hand over a message; the last error if all attempts fail."""
        error = None
        for _ in range(self.attempts if self.send else 0):
            try:
                self.send(value)
                return None
            except Exception as failure:  # noqa: BLE001
                error = f"{type(failure).__name__}: {failure}"
        return error

    def write(self, iterator: Iterator) -> Pending:
        pending = f"{self.folder}/.pending"
        os.makedirs(pending, exist_ok=True)
        name = uuid.uuid4().hex
        counts = {}
        files = {}
        try:
            for row in iterator:
                error = self._try(row["value"])
                kind = FAILED if error else DELIVERED
                if kind not in files:
                    counts[f"{kind}-{name}.json"] = 0
                    files[kind] = open(f"{pending}/{kind}-{name}.json", "w", encoding="utf-8")
                line = json.dumps({"value": row["value"], "error": error, "attempts": self.attempts}) if error else row["value"]
                files[kind].write(line + "\n")
                counts[f"{kind}-{name}.json"] += 1
        finally:
            for file in files.values():
                file.close()
        return Pending(counts)

    def commit(self, messages: list[Pending | None], batchId: int) -> None:
        final, gathered = f"{self.folder}/batch-{batchId:012d}", f"{self.folder}/.batch-{batchId}-{uuid.uuid4().hex}"
        if os.path.isdir(final):
            self.abort(messages, batchId)
            return
        os.makedirs(gathered)
        for message in messages:
            for name in message.files if message else ():
                os.rename(f"{self.folder}/.pending/{name}", f"{gathered}/{name}")
        os.rename(gathered, final)

    def abort(self, messages: list[Pending | None], batchId: int) -> None:
        for message in messages:
            for name in message.files if message else ():
                if os.path.exists(f"{self.folder}/.pending/{name}"):
                    os.unlink(f"{self.folder}/.pending/{name}")


def spool_format(spark: SparkSession, folder: str, send: Callable[[str], None] | None, attempts: int) -> str:
    """Register a sink for this folder and return the name of its format."""
    # Fixed here, as executors ask for it too.
    called = f"spool_{uuid.uuid4().hex}"

    class Spool(DataSource):
        @classmethod
        def name(cls) -> str:
            return called

        def streamWriter(self, schema, overwrite: bool) -> SpoolWriter:
            return SpoolWriter(folder, send, attempts)

    spark.dataSource.register(Spool)
    return called


def spool_stream(
    messages: DataFrame,
    folder: str,
    checkpoint: str,
    name: str = "spool",
    send: Callable[[str], None] | None = None,
    attempts: int = ATTEMPTS,
    every: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Hand over a stream of messages (column ``value``, text without line breaks, as JSON is).

    Messages that ``send`` takes within ``attempts`` tries are delivered, others recorded as failed with their
    last error; without ``send`` all are delivered, to the folder. One bad message holds up no other.
    """
    path = mounted(folder)
    writer = messages.select("value").writeStream.format(spool_format(messages.sparkSession, path, send, attempts))
    writer = writer.queryName(name).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def delivered(spark: SparkSession, folder: str) -> DataFrame:
    """``value`` of the messages of all finished batches."""
    return _read(spark, folder, DELIVERED, lambda path: spark.read.text(path), "value string")


def failed(spark: SparkSession, folder: str) -> DataFrame:
    """``value, error, attempts`` of those that were given up."""
    return _read(spark, folder, FAILED, lambda path: spark.read.schema(FAILED_SCHEMA).json(path), FAILED_SCHEMA)


def _read(spark: SparkSession, folder: str, kind: str, read: Callable, schema: str) -> DataFrame:
    path = mounted(folder)
    batches = [name for name in (os.listdir(path) if os.path.isdir(path) else []) if name.startswith("batch-")]
    if not any(file.startswith(kind) for name in batches for file in os.listdir(f"{path}/{name}")):
        return spark.createDataFrame([], schema)
    return read(f"file://{os.path.abspath(path)}/batch-*/{kind}-*.json")


def clear_pending(folder: str) -> None:
    """Remove what tasks that were lost have left. Only while no job writes to the folder."""
    shutil.rmtree(f"{mounted(folder)}/.pending", ignore_errors=True)
