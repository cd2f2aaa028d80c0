"""The registered queries whose results SQL can state."""

import duckdb
import pytest

from logtables.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    found = QUERIES[name](spark, SF)
    told = con.execute(ORACLE[name])
    columns = [c[0] for c in told.description]
    assert sorted(columns) == sorted(found.columns)
    assert sorted(map(repr, told.fetchall())) == sorted(
        repr(tuple(r[c] for c in columns)) for r in found.collect())
