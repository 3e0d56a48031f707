"""Every query against its SQL on the smallest driver tables."""

import math
import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from orderlens import oracles
from orderlens import queries as registry

ROOT = os.environ.get("ORDERLENS_TEST_TABLES", "/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}

pytestmark = pytest.mark.skipif(not Path(ROOT).exists(), reason="driver tables not found")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{ROOT}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def test_every_query_has_sql():
    assert set(registry.queries()) == set(oracles.oracle_sql())
    assert set(registry.queries()) <= set(driver.queries())


def test_entry_runs(spark):
    assert driver.entry(spark).count() == 3


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query_equals_its_sql(spark, duck, name):
    df = driver.queries()[name](spark, ROOT)
    expected = duck.sql(driver.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    at = [expected.columns.index(c) for c in columns]
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    assert got == Counter(tuple(plain(r[i]) for i in at) for r in expected.fetchall())
