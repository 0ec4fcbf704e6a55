"""The shared folder for checkpoints and intermediate tables."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a session whose executors are threads of this process gets a temporary folder without that
    setting; on a cluster (and in ``local-cluster``) a machine-local folder would be lost with its
    executor, so there the setting is required.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="wearlog-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


_SCRATCH = "wearlog.scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path inside the shared folder, or inside that of the scratch block at hand."""
    folder = spark.sparkContext.getLocalProperty(_SCRATCH) or shared_folder(spark)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, keep: bool = False) -> Iterator[None]:
    """Intermediate tables that are made inside the block are removed at its end.

    Everything that reads them must be written by then: data frames that were made inside and are used
    later would miss their files. The block holds for this thread, and for threads it starts with Spark's
    ``inheritable_thread_target``. ``keep`` leaves the tables, for looking into a run. Blocks may be nested.
    """
    context = spark.sparkContext
    before = context.getLocalProperty(_SCRATCH)
    path = scratch_path(spark, "scratch")
    context.setLocalProperty(_SCRATCH, path)
    try:
        yield
    finally:
        context.setLocalProperty(_SCRATCH, before)
        if not keep:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


#: Tasks, and so files, of a stored table per core of the cluster, unless its input is larger.
FILES_PER_CORE = 4


def _most_tasks(df: DataFrame) -> int:
    """A few per core, or one for each split of the data that the table is computed from."""
    spark = df.sparkSession
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    read = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    splits = read // spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    few = FILES_PER_CORE * max(2, spark.sparkContext.defaultParallelism)
    return min(max(few, splits), (1 << 31) - 1)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read back: computed once, safe from lost
    executors, and the same rows (ids included) however often it is read.

    Small tables of many partitions would be more files than rows, so partitions are joined down to
    ``_most_tasks``; each is still computed by itself, one after another.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.coalesce(_most_tasks(df)).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
