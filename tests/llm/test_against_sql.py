"""The numbered queries against their SQL counterparts."""

import duckdb
import pytest

from tallyward.llm.oracle import llm_oracles
from tallyward.llm.queries import llm_queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    expected = connection.execute(llm_oracles()[name])
    names = sorted(d[0] for d in expected.description)
    order = [[d[0] for d in expected.description].index(n) for n in names]
    theirs = sorted(repr(tuple(row[k] for k in order)) for row in expected.fetchall())
    result = llm_queries()[name](spark, SF)
    assert sorted(result.columns) == names
    assert sorted(repr(tuple(r[n] for n in names)) for r in result.collect()) == theirs
