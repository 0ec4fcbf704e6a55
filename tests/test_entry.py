"""Every registered query against its SQL, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables")
SQL = contract.oracle_sql()
NAMES = [query.__name__ for query in contract.QUERIES]


@pytest.fixture(scope="module")
def tables():
    db = duckdb.connect()
    for file in SF.glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return db


def plain(rows):
    """Rows with doubles as text of six decimals, sorted."""

    def value(v):
        if isinstance(v, float) and not math.isnan(v):
            return f"{v + 0.0:.6f}"
        return repr(v)

    return sorted(tuple(value(v) for v in row) for row in rows)


KINDS = {
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
}


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, tables, name):
    df = contract.queries()[name](spark, str(SF))
    columns = sorted(df.columns)
    result = tables.execute(f"SELECT {', '.join(columns)} FROM ({SQL[name]})")
    kinds = [KINDS[str(column[1])] for column in result.description]
    assert [kind for _, kind in df.select(*columns).dtypes] == kinds
    expected = result.fetchall()
    assert plain(df.select(*columns).collect()) == plain(expected)
    assert expected


def test_every_query_has_its_sql():
    assert set(NAMES) <= set(SQL) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
