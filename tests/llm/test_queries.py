"""The registered queries against their SQL on DuckDB, and those without SQL against plain versions."""

import os
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from brute import near_classes, repeats
from wearlog.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
KINDS = {
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
}
TABLES = ("documents", "embeddings", "labels", "benchmark", "conversations")


def _view(con, folder, table):
    path = f"{folder}/{table}.parquet"
    con.execute(f"CREATE VIEW {table} AS FROM read_parquet('{path if os.path.isfile(path) else path + '/*.parquet'}')")


def _rows(frame):
    plain = frame.astype(object).where(frame.notna(), None)
    return sorted(map(tuple, plain[sorted(plain.columns)].itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def awkward_folder(spark, tmp_path_factory):
    """The smallest tables with nulls, empty texts and more columns."""
    folder = str(tmp_path_factory.mktemp("awkward"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    third = F.col("doc_id") % 10 == 3
    text = F.when(third, None).when(F.col("doc_id") % 10 == 4, "").otherwise(F.col("text"))
    source = F.when(F.col("doc_id") % 4 == 0, None).otherwise(F.col("source"))
    docs = docs.withColumns({"text": text, "source": source, "words": F.lit(1), "key": F.lit("x")})
    docs.withColumn("lang", F.when(~third, F.col("lang"))).write.parquet(f"{folder}/documents.parquet")
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    bad = F.transform("embedding", lambda x, i: F.when(i > 3, x).cast("float"))
    odd = F.transform("embedding", lambda x, i: F.when(i > 3, x).otherwise(float("nan")).cast("float"))
    some = (
        F.when(F.col("vec_id") % 7 == 1, None)
        .when(F.col("vec_id") % 7 == 2, bad)
        .when(F.col("vec_id") % 7 == 3, odd)
        .otherwise(F.col("embedding"))
    )
    vectors.withColumn("embedding", some).write.parquet(f"{folder}/embeddings.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    items.withColumn("text", F.when(F.col("item_id") % 5 > 0, F.col("text"))).write.parquet(f"{folder}/benchmark.parquet")
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    spoiled = {
        name: F.when(F.pmod(F.xxhash64("conv_id", "turn"), F.lit(n)) > 0, F.col(name))
        for name, n in (("role", 5), ("text", 6))
    }
    first = F.when(F.col("turn") > 0, F.col("turn"))
    turns = turns.withColumns(spoiled | {"turn": first, "words": F.lit(1), "key": F.lit("x")})
    turns.write.parquet(f"{folder}/conversations.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    labels.withColumn("toxic", F.when(F.col("doc_id") % 6 > 0, F.col("toxic"))).write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.fixture(scope="module")
def empty_folder(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for table in TABLES:
        spark.read.parquet(f"{SF}/{table}.parquet").limit(0).write.parquet(f"{folder}/{table}.parquet")
    return folder


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
@pytest.mark.parametrize("kind", ["given", "awkward"])
def test_equals_its_sql(spark, awkward_folder, name, kind):
    folder = SF if kind == "given" else awkward_folder
    con = duckdb.connect()
    for table in TABLES:
        _view(con, folder, table)
    got = QUERIES[name](spark, folder)
    result = con.execute(ORACLE_SQL[name])
    kinds = {column[0]: KINDS[str(column[1])] for column in result.description}
    assert dict(got.dtypes) == kinds
    assert _rows(got.toPandas()) == _rows(result.df())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, empty_folder, name):
    assert QUERIES[name](spark, empty_folder).collect() == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_awkward_tables(spark, awkward_folder, name):
    rows = QUERIES[name](spark, awkward_folder).collect()
    assert len(rows) == spark.read.parquet(f"{awkward_folder}/documents.parquet").count()


def _docs(spark, folder=SF):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}


def test_language_on_held_out_rows(spark):
    docs = _docs(spark)
    rows = QUERIES["op1_language_id"](spark, SF).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in rows if r["held_out"]]
    assert len(rows) == len(docs) and sum(held) >= 0.95 * len(held)


def test_near_duplicates_equal_the_plain_version(spark):
    docs = sorted(_docs(spark).items())
    expected = near_classes([r["text"] for _, r in docs])
    rows = {r["doc_id"]: r["class_id"] for r in QUERIES["op2_near_dedup"](spark, SF).collect()}
    assert rows == {i: docs[c][0] for (i, _), c in zip(docs, expected)}


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op3_toxicity"](spark, folder).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in rows)
    held = [r["predicted"] == labels[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(held) >= 0.9 * len(held)


def test_repeats_equal_the_plain_version(spark):
    docs = sorted(_docs(spark).items())
    expected = repeats([r["text"] for _, r in docs], 400)
    rows = QUERIES["op7_suffix_dedup"](spark, SF).collect()
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows)
    assert got == [(i, *own) for (i, _), own in zip(docs, expected)]


def test_every_operator_is_registered():
    numbers = {int(name[2:].split("_")[0]) for name in QUERIES}
    assert numbers == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(ORACLE_SQL) <= set(contract.oracle_sql())
