"""Queries that SQL can express, against DuckDB on the smallest given tables."""

from pathlib import Path

import duckdb
import pytest
from support import sf_dir  # noqa: F401

from refinery.llm import queries


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query(spark, sf_dir, name):
    duck = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    found = queries.queries()[name](spark, sf_dir)
    columns = sorted(found.columns)
    oracle = duck.sql(queries.oracle_sql()[name])
    assert sorted(oracle.columns) == columns
    rows = [tuple(row) for row in found.select(*columns).collect()]
    assert rows and sorted(map(repr, rows)) == sorted(map(repr, oracle.select(*columns).fetchall()))
