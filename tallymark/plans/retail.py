"""The retail job: transactions into sales partitioned by region, reports on them, and the frequent customers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.text import register_reverse_string, reversed_text
from tallymark.operators.aggregates import count_and_total_by
from tallymark.sources.catalog import (
    add_partition,
    create_database,
    create_view,
    drop_database,
    drop_tables,
    drop_views,
    use_database,
)
from tallymark.sources.readers import create_delimited_table, read_table
from tallymark.sources.writers import append_by_name

# The schemas and regions of the retail tables.
DATABASE = "retail_db"
CUSTOMERS = (
    "customer_id INT, customer_name STRING, customer_email STRING, "
    "customer_city STRING, customer_state STRING, customer_zipcode INT"
)
ORDERS = "order_id INT, order_date STRING, customer_id INT, order_status STRING"
SALES = "sale_id INT, sale_amount DOUBLE, sale_date STRING, region STRING"
TRANSACTIONS = "transaction_id INT, transaction_date STRING, customer_id INT, amount DOUBLE"
TRANSACTION_BUCKETS = 4
NORTH_AMERICA, EUROPE = "north_america", "europe"
NORTH_AMERICAN_CUSTOMERS = (1, 2)


def create_tables(spark: SparkSession, database: str = DATABASE, location: str | None = None) -> None:
    """Database and empty tables: customers and orders as delimited text, sales by region, transactions in buckets."""
    create_database(spark, database, location)
    use_database(spark, database)
    create_delimited_table(spark, "customers", CUSTOMERS)
    create_delimited_table(spark, "orders", ORDERS)
    spark.sql(f"CREATE TABLE IF NOT EXISTS sales ({SALES}) USING parquet PARTITIONED BY (region)")
    for region in (NORTH_AMERICA, EUROPE):
        add_partition(spark, "sales", region=region)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS transactions ({TRANSACTIONS}) USING parquet "
        f"CLUSTERED BY (customer_id) INTO {TRANSACTION_BUCKETS} BUCKETS"
    )


def drop_all(spark: SparkSession, database: str = DATABASE) -> None:
    drop_views(spark, f"{database}.frequent_customers")
    drop_tables(spark, *(f"{database}.{table}" for table in ("transactions", "sales", "orders", "customers")))
    if spark.catalog.currentDatabase() == database:
        use_database(spark, "default")
    drop_database(spark, database)


def region_of(customer: Column) -> Column:
    """Region of a customer; a NULL customer falls into the last branch like any other."""
    return F.when(customer.isin(*NORTH_AMERICAN_CUSTOMERS), NORTH_AMERICA).otherwise(EUROPE)


def sales_rows(transactions: DataFrame) -> DataFrame:
    """Transactions in the shape of the sales table."""
    return transactions.select(
        F.col("transaction_id").alias("sale_id"),
        F.col("amount").alias("sale_amount"),
        F.col("transaction_date").alias("sale_date"),
        region_of(F.col("customer_id")).alias("region"),
    )


def load_sales(transactions: DataFrame, table: str = "sales") -> None:
    """Append the transactions, each row to the partition of its region. No shuffle, so a large region is no hot spot."""
    append_by_name(sales_rows(transactions), table)


def sales_by_region(sales: DataFrame, *, scale: int | None = None) -> DataFrame:
    return count_and_total_by(sales, ["region"], "sale_amount", scale=scale)


def reversed_dates(sales: DataFrame) -> DataFrame:
    return sales.select("sale_id", reversed_text(F.col("sale_date")).alias("reversed_date"))


def reversed_dates_sql(spark: SparkSession, sales: str = "sales") -> DataFrame:
    """:func:`reversed_dates` through the session's ``reverse_string`` function."""
    register_reverse_string(spark)
    return spark.sql(
        "SELECT sale_id, reverse_string(sale_date) AS reversed_date FROM IDENTIFIER(:sales)", args={"sales": sales}
    )


def customer_orders(customers: DataFrame, orders: DataFrame, *shown: str) -> DataFrame:
    """Orders with their customer."""
    shown = shown or ("customer_name", "customer_city", "order_id", "order_status")
    return customers.join(orders, "customer_id").select(*shown)


def frequent_customers(customers: DataFrame, orders: DataFrame, more_than: int = 1) -> DataFrame:
    """Names with more than ``more_than`` orders.

    Orders are counted per customer before the join, so the join sees one row per customer however many orders one
    customer has. Names that several customers share are added up afterwards.
    """
    per_customer = orders.groupBy("customer_id").agg(F.count("order_id").alias("n_orders"))
    return (
        customers.select("customer_id", "customer_name")
        .join(per_customer, "customer_id")
        .groupBy("customer_name")
        .agg(F.sum("n_orders").alias("total_orders"))
        .filter(F.col("total_orders") > more_than)
    )


FREQUENT_CUSTOMERS_SQL = """
SELECT c.customer_name, SUM(n.n_orders) AS total_orders
FROM customers c
JOIN (SELECT customer_id, COUNT(order_id) AS n_orders FROM orders GROUP BY customer_id) n USING (customer_id)
GROUP BY c.customer_name
HAVING total_orders > 1
"""


def create_frequent_customers_view(spark: SparkSession, name: str = "frequent_customers") -> None:
    create_view(spark, name, FREQUENT_CUSTOMERS_SQL)


def run(spark: SparkSession, transactions: DataFrame | None = None, database: str = DATABASE) -> dict[str, DataFrame]:
    """Load the sales from ``transactions`` (by default the table of that name) and return the reports on the tables."""
    create_tables(spark, database)
    load_sales(read_table(spark, "transactions") if transactions is None else transactions)
    create_frequent_customers_view(spark)
    sales, customers, orders = (read_table(spark, t) for t in ("sales", "customers", "orders"))
    return {
        "customer_orders": customer_orders(customers, orders),
        "sales_by_region": sales_by_region(sales),
        "reversed_dates": reversed_dates_sql(spark),
        "frequent_customers": read_table(spark, "frequent_customers"),
    }
