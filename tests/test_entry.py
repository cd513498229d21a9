"""Every registered query against its SQL, and what the contract of the entry module asks for."""

from __future__ import annotations

import decimal

import duckdb
import pytest
from conftest import SF_DIR

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


def bag(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    plain = ([float(v) if isinstance(v, decimal.Decimal) else v for v in row] for row in rows)
    return sorted(repr([row[i] for i in order]) for row in plain)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_matches_its_sql(spark, database, name):
    df = contract.queries()[name](spark, SF_DIR)
    expected = database.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    assert sorted(df.columns) == sorted(columns)
    assert bag(df.columns, [tuple(r) for r in df.collect()]) == bag(columns, expected.fetchall())


def test_every_sql_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_queries_can_be_run_again(spark):
    for name in ("pruned_region", "sales_job_detail", "delimited_orders", "customer_orders_bucketed"):
        first, second = (contract.queries()[name](spark, SF_DIR).count() for _ in range(2))
        assert first == second


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["product_id", "total_sales"] and df.count() > 0
