"""Every query against its SQL text on DuckDB."""

import glob
import os

import duckdb
import pytest

from docloom.suite import ORACLE, QUERIES
from tools.check import rows_of


@pytest.fixture(scope="module")
def db(data):
    connection = duckdb.connect()
    for path in glob.glob(f"{data}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, db, name):
    got = rows_of(QUERIES[name](spark, data).toArrow())
    want = rows_of(db.execute(ORACLE[name]).to_arrow_table())
    assert got == want
