"""Every query beside its SQL, on the smallest given data."""

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import rows_of
from workloads.catalog import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in sorted(Path(SF).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, db, name):
    df = queries()[name](spark, SF)
    result = db.execute(oracle_sql()[name])
    theirs = rows_of([d[0] for d in result.description], result.fetchall())
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == theirs
    assert theirs[0]


def test_entry(spark):
    assert entry(spark).count() > 0


def test_no_python_in_any_plan(spark):
    for name in ("rest_pages", "dom_metadata", "attempt_outcomes"):
        assert "Python" not in queries()[name](spark, SF)._jdf.queryExecution().toString()
