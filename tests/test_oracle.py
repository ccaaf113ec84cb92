"""Every registered query against its SQL counterpart in DuckDB."""

import math
from collections import Counter
from datetime import datetime, timezone
from decimal import Decimal

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from bookpipe.oracle import ORACLE
from bookpipe.queries import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def as_bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query(spark, sf_dir, duck, name):
    result = queries()[name](spark, sf_dir)
    expected = duck.execute(oracle_sql()[name])
    columns = [entry[0] for entry in expected.description]
    assert sorted(result.columns) == sorted(columns)
    rows = [tuple(row) for row in result.collect()]
    assert rows
    assert as_bag(result.columns, rows) == as_bag(columns, expected.fetchall())


def test_entry(spark):
    assert len(entry(spark).collect()) == 10
