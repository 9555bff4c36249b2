"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalogue import ORACLES, QUERIES
from tools.compare import TABLES, rows_of

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_gives_the_rows_of_its_sql(spark, db, name):
    frame = QUERIES[name](spark, SF_DIR)
    got = rows_of(frame.columns, frame.collect())
    result = db.execute(ORACLES[name])
    want = rows_of([column[0] for column in result.description], result.fetchall())
    assert got == want


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_the_entry_lists_them_all():
    assert set(QUERIES) <= set(queries())
    assert set(ORACLES) <= set(oracle_sql()) <= set(queries())


def test_entry_runs(spark):
    assert entry(spark).count() == 28
