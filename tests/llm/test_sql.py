"""Every query that has SQL against DuckDB."""

import os

import duckdb
import pytest

from docloom.llm.suite import ORACLE, QUERIES
from tools.check import rows_of


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, data, name):
    db = duckdb.connect()
    for table in os.listdir(data):
        db.execute(f"CREATE VIEW {table.split('.')[0]} AS SELECT * FROM '{data}/{table}'")
    want = rows_of(db.execute(ORACLE[name]).to_arrow_table())
    assert rows_of(QUERIES[name](spark, data).toArrow()) == want
