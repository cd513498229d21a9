from __future__ import annotations

import pytest
from conftest import physical_plan, rows
from pyspark.sql import functions as F

from tallymark import sources
from tallymark.plans import retail
from tallymark.plans.session import build_session, session_settings

CUSTOMERS = [
    (1, "Ann", "a@x", "Oslo", "O", 1),
    (2, "Bob", "b@x", "Bern", "B", 2),
    (3, "Bob", "c@x", "Rome", "R", 3),
    (4, "Cid", "d@x", "Riga", "L", 4),
]
ORDERS = [
    (10, "2024-01-01", 1, "open"),
    (11, "2024-01-02", 1, "done"),
    (12, "2024-01-03", 2, "open"),
    (13, "2024-01-04", 3, "open"),
    (14, "2024-01-05", 4, "open"),
    (15, "2024-01-05", None, "lost"),
    (16, "2024-01-06", 99, "lost"),
]
TRANSACTIONS = [
    (100, "2024-01-15", 1, 10.5),
    (101, "2024-01-16", 2, 20.0),
    (102, "2024-01-17", 3, 30.0),
    (103, None, None, 40.0),
]


@pytest.fixture
def frames(spark):
    return (
        spark.createDataFrame(CUSTOMERS, retail.CUSTOMERS),
        spark.createDataFrame(ORDERS, retail.ORDERS),
        spark.createDataFrame(TRANSACTIONS, retail.TRANSACTIONS),
    )


def test_null_customer_falls_into_the_last_region(frames):
    regions = {r.sale_id: r.region for r in retail.sales_rows(frames[2]).collect()}
    assert regions == {100: "north_america", 101: "north_america", 102: "europe", 103: "europe"}


def test_reports(frames):
    customers, orders, transactions = frames
    sales = retail.sales_rows(transactions)
    assert rows(retail.sales_by_region(sales)) == [("europe", 2, 70.0), ("north_america", 2, 30.5)]
    assert rows(retail.reversed_dates(sales))[0] == (100, "51-10-4202")
    assert rows(retail.customer_orders(customers, orders)) == [
        ("Ann", "Oslo", 10, "open"),
        ("Ann", "Oslo", 11, "done"),
        ("Bob", "Bern", 12, "open"),
        ("Bob", "Rome", 13, "open"),
        ("Cid", "Riga", 14, "open"),
    ]
    # two customers share a name; orders without a customer do not count
    assert rows(retail.frequent_customers(customers, orders)) == [("Ann", 2), ("Bob", 2)]
    assert rows(retail.frequent_customers(customers, orders, more_than=0)) == [("Ann", 2), ("Bob", 2), ("Cid", 1)]


def test_frequent_customers_equals_counting_after_the_join(spark, frames):
    customers, orders = frames[0].union(frames[0].limit(1)), frames[1]
    plain = customers.join(orders, "customer_id").groupBy("customer_name").agg(F.count("order_id").alias("n"))
    assert rows(retail.frequent_customers(customers, orders)) == rows(plain.filter("n > 1"))


def test_a_hot_customer_is_one_row_in_the_join(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    customers = spark.range(10).select(F.col("id").alias("customer_id"), F.lit("n").alias("customer_name"))
    customer = F.when(F.col("id") < 999, F.lit(1)).otherwise(F.lit(2)).cast("long").alias("customer_id")
    orders = spark.range(1000).select(customer, F.col("id").alias("order_id"))
    found = retail.frequent_customers(customers, orders)
    plan = physical_plan(found)
    # the orders are counted below their exchange, hence below the join
    assert "partial_count" in plan.split("SortMergeJoin")[1]
    assert rows(found) == [("n", 1000)]  # all customers have this name


def test_whole_job(spark, frames):
    customers, orders, transactions = frames
    retail.create_tables(spark)
    try:
        sources.append_by_name(customers, "customers")
        sources.append_by_name(orders, "orders")
        sources.append_by_name(transactions, "transactions")
        reports = retail.run(spark)
        assert rows(reports["sales_by_region"]) == [("europe", 2, 70.0), ("north_america", 2, 30.5)]
        assert rows(reports["frequent_customers"]) == [("Ann", 2), ("Bob", 2)]
        assert len(rows(reports["customer_orders"])) == 5
        assert (100, "51-10-4202") in rows(reports["reversed_dates"])
        assert rows(spark.sql("SELECT * FROM frequent_customers")) == [("Ann", 2), ("Bob", 2)]
        europe = spark.table("sales").filter("region = 'europe'")
        assert europe.count() == 2 and all("region=europe" in f for f in europe.inputFiles())
        assert {r[0] for r in spark.sql("SHOW PARTITIONS sales").collect()} == {"region=europe", "region=north_america"}
        assert "buckets" in str(spark.sql("DESCRIBE EXTENDED transactions").collect()).lower()
    finally:
        retail.drop_all(spark)
    assert not spark.catalog.databaseExists(retail.DATABASE)


def test_settings_follow_the_size_of_the_shuffle():
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert key not in session_settings()
    assert session_settings(shuffle_bytes=10 * 2**40, cores=4000)[key] == str(10 * 2**40 // (128 * 2**20))
    assert session_settings(shuffle_bytes=1, cores=8)[key] == "24"
    assert session_settings()["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_build_session_takes_the_session_that_is_there(spark):
    assert build_session().sparkContext is spark.sparkContext
