"""Every registered query against its SQL on the smallest given tables."""

from __future__ import annotations

import datetime
import decimal
import numbers
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_point
from starmart.registry import QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "string": "VARCHAR", "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN",
}
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables are absent")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or value is pd.NaT or value is pd.NA or value != value:
        return None
    if isinstance(value, (datetime.date, pd.Timestamp)):
        return str(pd.Timestamp(value))
    if isinstance(value, (numbers.Number, decimal.Decimal)) and not isinstance(value, bool):
        return repr(float(value))
    return str(value)


def content(df: pd.DataFrame) -> list[tuple]:
    columns = sorted(df.columns)
    return sorted((tuple(map(plain, r)) for r in df[columns].astype(object).values.tolist()), key=repr)


def test_every_query_of_the_registry_has_an_oracle():
    assert set(QUERIES) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query(spark, duck, name):
    result = entry_point.queries()[name](spark, FOLDER)
    expected = duck.execute(entry_point.oracle_sql()[name])
    types = {c[0]: str(c[1]) for c in expected.description}
    assert {c: TYPES.get(k, k.upper()) for c, k in result.dtypes} == types
    assert content(result.toPandas()) == content(expected.fetchdf())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
