"""Every registered query against its SQL twin on the same tables, value for value."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as driver
from logtables.plans.catalogue import QUERIES
from logtables.plans.oracle import ORACLE

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
SPARK_TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
               "int": "INTEGER"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    found = driver.queries()[name](spark, SF_DIR)
    sql = driver.oracle_sql()[name]
    described = duck.execute(f"DESCRIBE {sql}").fetchall()
    assert sorted(found.columns) == sorted(r[0] for r in described)
    types = {f.name: SPARK_TYPES[f.dataType.simpleString()] for f in found.schema.fields}
    assert types == {r[0]: r[1] for r in described}
    expected = duck.execute(sql).fetchall()
    assert expected, "the comparison would be empty"
    assert rows_of(found.columns, map(tuple, found.collect())) == rows_of(
        [r[0] for r in described], expected)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() > 0
