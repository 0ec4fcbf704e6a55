"""The shared folder."""

from multiprocessing.pool import ThreadPool
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from wearlog.session import (
    FILES_PER_CORE,
    _most_tasks,
    scratch,
    scratch_path,
    shared_folder,
    stored,
)


def fake(master, setting=None, current=None):
    """A session as far as ``shared_folder`` looks at one."""
    used = []
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: current, setCheckpointDir=used.append
    )
    conf = SimpleNamespace(get=lambda name, default: setting)
    return SimpleNamespace(sparkContext=context, conf=conf), used


def test_the_setting_is_used_everywhere():
    for master in ("local[2]", "spark://host:7077", "yarn"):
        session, used = fake(master, setting="/shared")
        assert shared_folder(session) == "/shared" and used == ["/shared"]


def test_without_the_setting_only_a_local_session_gets_a_folder():
    session, used = fake("local[2]")
    assert [shared_folder(session)] == used
    for master in ("yarn", "local-cluster[2,1,1024]"):
        session, used = fake(master)
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_folder(session)
        assert not used


def test_a_folder_already_in_use_is_kept():
    session, used = fake("yarn", current="hdfs:///checkpoints/1")
    assert shared_folder(session) == "hdfs:///checkpoints/1" and not used


def test_stored_tables_lie_in_the_shared_folder_and_never_change(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    table = stored(spark.range(5).withColumn("r", F.rand()), "random")
    assert table.orderBy("id").collect() == table.orderBy("id").collect()
    assert "Range" not in table._jdf.queryExecution().executedPlan().toString()


def test_a_scratch_block_removes_its_tables(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(folder.iterdir())

    def make(_):
        return stored(spark.range(3), "inner").count()

    with scratch(spark):
        assert stored(spark.range(5), "table").count() == 5
        with scratch(spark, keep=True):
            stored(spark.range(5), "kept")
        with ThreadPool(2) as pool:
            assert pool.map(inheritable_thread_target(spark)(make), [1, 2]) == [3, 3]
        assert len(set(folder.iterdir()) - before) == 1
    assert set(folder.iterdir()) == before
    outside = stored(spark.range(2), "outside")
    assert len(set(folder.iterdir()) - before) == 1 and outside.count() == 2


def test_a_scratch_block_that_fails_removes_its_tables(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(folder.iterdir())
    with pytest.raises(ZeroDivisionError), scratch(spark):
        stored(spark.range(5), "table")
        1 / 0
    assert set(folder.iterdir()) == before


def test_small_tables_are_few_files(spark):
    few = FILES_PER_CORE * spark.sparkContext.defaultParallelism
    table = stored(spark.range(1000).repartition(10 * few), "many")
    assert len(table.inputFiles()) <= few and table.count() == 1000


def test_tables_of_much_data_keep_their_tasks(spark):
    few = FILES_PER_CORE * spark.sparkContext.defaultParallelism
    read = stored(spark.range(20_000), "read")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        assert _most_tasks(read) > few and _most_tasks(read.join(read, "id")) > few
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert _most_tasks(read) == few
