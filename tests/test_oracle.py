"""Every registered query against its SQL in DuckDB: names, types and values, order-insensitive."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_module
from haulmark.queries import ORACLES, QUERIES
from tests.conftest import SF

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def rows_of(names: list[str], rows: list) -> list[tuple]:
    """Columns by name, rows in any order."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


# Spark type -> DuckDB type.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF)
    assert name in ORACLES
    expected = duck.execute(ORACLES[name])
    expected_types = {d[0]: str(d[1]) for d in expected.description}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in result.schema.fields} == expected_types
    want = expected.fetchall()
    got = result.collect()
    assert len(got) == len(want)
    assert len(got) > 0
    assert rows_of(result.columns, got) == rows_of(list(expected_types), want)


def test_all_are_registered():
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
