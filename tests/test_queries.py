"""Every query against its DuckDB text on the smallest given tables; some again with every key taken for a hot one."""

import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from driver_inputs import GIVEN
from refinery.operators import skew

SF_DIR = Path(entry.FLAGSHIP_DIR)
QUERIES, ORACLES = entry.mart_queries(), entry.mart_oracles()
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in GIVEN:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def compare(spark, duck, name):
    found = QUERIES[name](spark, str(SF_DIR))
    columns = sorted(found.columns)
    oracle = duck.sql(ORACLES[name])
    assert sorted(oracle.columns) == columns
    rows = [tuple(row) for row in found.select(*columns).collect()]
    assert rows and sorted(map(repr, rows)) == sorted(map(repr, oracle.select(*columns).fetchall()))


def test_each_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    compare(spark, duck, name)


@pytest.mark.parametrize("name", ["dim_customers", "fact_sales", "order_intervals", "price_history", "sales_as_of_versions", "silver_crm_prd_info", "sales_kpis_category"])
def test_query_with_hot_keys_only(spark, duck, name, monkeypatch):
    for limit, value in {"rows_per_task": 2, "broadcast_bytes": 0}.items():
        monkeypatch.setitem(skew.LIMITS.__dict__, limit, value)
    compare(spark, duck, name)


def test_without_a_library_of_the_training_data_the_mart_is_there(monkeypatch):
    """A name that is None among the modules can't be imported."""
    for name in [name for name in sys.modules if name.startswith("refinery.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "tokenizers", None)
    monkeypatch.setitem(sys.modules, "public_tokenizers", None)
    assert entry.queries().keys() == QUERIES.keys() and entry.oracle_sql().keys() == ORACLES.keys()
