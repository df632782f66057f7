"""Every registered query against DuckDB on the same tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as driver
from numprep.catalog import ORACLES, QUERIES

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP"}


@pytest.fixture(scope="module")
def duck(tables):
    connection = duckdb.connect()
    for path in glob.glob(f"{tables}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"create view {name} as select * from '{path}'")
    yield connection
    connection.close()


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _sorted(rows):
    return sorted([tuple(_plain(v) for v in row) for row in rows], key=lambda row: [(v is None, str(v)) for v in row])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, tables, duck, name):
    df = QUERIES[name](spark, tables)
    columns = sorted(df.columns)
    got = df.select(*[f"`{c}`" for c in columns]).collect()
    sql = ORACLES.get(name)
    if sql is None:
        assert got
        return
    quoted = ", ".join(f'"{c}"' for c in columns)
    expected = duck.sql(f"select {quoted} from ({sql})")
    assert [TYPES[t] for _, t in sorted(df.dtypes)] == [str(t) for t in expected.types]
    assert _sorted(got) == _sorted(expected.fetchall())
    assert got


def test_every_oracle_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(QUERIES) <= set(driver.queries())
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
    assert df.count() > 0
