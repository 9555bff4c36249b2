import duckdb
import pytest

from tools.compare import TABLES, rows_of

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def agrees(spark):
    """Compare a query's rows with those of its SQL on the smallest tables."""
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")

    def check(name, query, oracles):
        frame = query(spark, SF_DIR)
        result = db.execute(oracles[name])
        want = rows_of([column[0] for column in result.description], result.fetchall())
        assert rows_of(frame.columns, frame.collect()) == want

    return check
