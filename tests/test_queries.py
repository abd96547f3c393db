"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from haulage import registry

QUERIES = registry.QUERIES
SQL = registry.SQL


@pytest.fixture
def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    yield connection
    connection.close()


def normal(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    if isinstance(value, int) and not isinstance(value, bool):
        return str(value)
    return value if value is None else f"{type(value).__name__}:{value}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(normal(row[i]) for i in order) for row in rows], key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(name, spark, sf_dir, duck):
    result = QUERIES[name](spark, sf_dir)
    expected = duck.execute(SQL[name])
    columns = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(columns)
    wanted = rows_of(columns, expected.fetchall())
    found = rows_of(result.columns, result.collect())
    assert len(found) == len(wanted)
    assert found == wanted
    assert wanted, "a query over whole tables gives rows"


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert entry_points.queries().items() >= QUERIES.items()


def test_entry(spark, sf_dir):
    assert entry_points.entry(spark).count() > 0
