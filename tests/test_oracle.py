"""Every registered query against DuckDB on the same tables."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from remitscope.plans import oracles
from remitscope.plans import queries as plans

DEFAULT_DIR = "/root/testdata/sf0.01"
SF_DIR = Path(os.environ.get("TEST_SF_DIR", DEFAULT_DIR))
ORACLES = contract.oracle_sql()
QUERIES = {name: query for name, query in contract.queries().items() if name in ORACLES}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in sorted(SF_DIR.glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(plans.QUERIES) == set(oracles.ORACLES)
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, duck, name):
    found = QUERIES[name](spark, str(SF_DIR))
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    assert {name: DUCK_TYPES[t] for name, t in found.dtypes} == types
    expected = _sorted_rows(columns, cursor.fetchall())
    # A query without rows shows nothing. In the denser tables, though, no interval is stalled.
    assert expected or str(SF_DIR) != DEFAULT_DIR
    rows = _sorted_rows(found.columns, [tuple(r) for r in found.collect()])
    assert len(rows) == len(expected)
    assert rows == expected
