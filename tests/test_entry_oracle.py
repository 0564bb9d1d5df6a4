"""Driver contract and the DuckDB oracle for every registered query (sf0.001)."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import rows_of  # noqa: E402

from sparkmart.adapter import TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["customer_id", "customer_name", "city", "age", "total_orders",
                          "total_spend", "avg_spend_per_order", "is_high_value"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    d_rows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert rows_of(sdf.columns, s_rows) == rows_of(rel.columns, d_rows)
    spark.catalog.clearCache()
