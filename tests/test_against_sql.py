"""Every registered query against its SQL counterpart on a second engine."""

import math
import os
import subprocess
import sys
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from workload.oracle import oracles
from workload.queries import registry

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
QUERIES = registry()
SQL = oracles()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def second_engine():
    connection = duckdb.connect()
    for path in sorted(Path(SF_DIR).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= queries().keys()
    assert SQL.keys() <= oracle_sql().keys() <= queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, second_engine, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = second_engine.execute(SQL[name])
    names = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(names)
    ours = _sorted_rows(result.columns, [tuple(r) for r in result.collect()])
    theirs = _sorted_rows(names, expected.fetchall())
    assert len(ours) == len(theirs)
    assert ours == theirs


def test_entry(spark):
    assert entry(spark).count() > 0


def test_reports_stand_without_the_packages_of_others():
    """A package that only the corpus operators need is missing: their queries are left out, the reports register."""
    code = (
        "import sys; sys.modules['xxhash'] = sys.modules['tokenizers'] = sys.modules['public_tokenizers'] = None; "
        "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    )
    found = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[1], capture_output=True, text=True, check=True)
    assert found.stdout.split() == [str(len(QUERIES)), str(len(SQL))]
