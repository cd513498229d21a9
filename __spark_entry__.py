"""Registered queries over the test tables, each with the SQL that must give the same rows.

The tables stand in for sales data: ``lineitem`` is the sales table (part, extended price, ship date), ``customer`` and
``orders`` are themselves, and ``orders`` is the transactions table too. Every query reads its tables whole. Where a
comparison needs a second version of a table, it is derived from the same tables by conditions on their data; NULLs, of
which the tables have none, are made the same way.
"""

from __future__ import annotations

import datetime
import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.dates import shift_zone
from tallymark.functions.text import register_reverse_string
from tallymark.operators import aggregates, checksums, filters, heavy, joins, lineage, quality, reconcile, sketches
from tallymark.operators.audit import AuditTrail
from tallymark.plans import retail, sales
from tallymark.sources import catalog, clustered, readers, scope, writers
from tallymark.sources.ledger import Ledger

Query = Callable[[SparkSession, str], DataFrame]

Q1_1998 = ("1998-01-01", "1998-03-31")
DETAIL_SCHEMA = "product_id bigint, total_sales double"

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with its SQL if it has one."""

    def register(function: Query) -> Query:
        name = function.__name__
        _QUERIES[name] = function
        if sql is not None:
            _SQL[name] = " ".join(sql.split())
        return function

    return register


# --- the tables in the shapes the library works on -----------------------------------------------------------------


# The declared schemas of the tables in use.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str, amount: Column | None = None, product: Column | None = None) -> DataFrame:
    """``lineitem`` as ``product_id, sales, sale_date``."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_partkey") if product is None else product).alias("product_id"),
        (F.col("l_extendedprice") if amount is None else amount).alias("sales"),
        F.col("l_shipdate").alias("sale_date"),
    )


def lines_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir, amount=F.when(F.col("l_discount") >= 0.03, F.col("l_extendedprice")))


def totals_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.sales_totals(lines_with_nulls(spark, sf_dir), *Q1_1998, scale=2)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").withColumnsRenamed(
        {"c_custkey": "customer_id", "c_name": "customer_name", "c_mktsegment": "customer_segment"}
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumnsRenamed(
        {"o_orderkey": "order_id", "o_custkey": "customer_id", "o_orderstatus": "order_status"}
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_orderdate").cast("date").cast("string").alias("transaction_date"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("amount"),
    )


def version_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as ``k, v``, and a second version with rows changed, rows missing and rows of its own."""
    rows = table(spark, sf_dir, "orders")
    price = F.col("o_totalprice")
    raised = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P")
    lost = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")
    own = table(spark, sf_dir, "customer").select((-F.col("c_custkey") - 1).alias("k"), F.col("c_acctbal").alias("v"))
    second = rows.filter(~lost).select(F.col("o_orderkey").alias("k"), F.when(raised, price + 1).otherwise(price).alias("v"))
    return rows.select(F.col("o_orderkey").alias("k"), price.alias("v")), second.unionByName(own)


def scratch(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Name of a scratch table of this query and folder; running the query again replaces it."""
    return f"{scope.scratch_database(spark)}.{name}_{hashlib.sha256(sf_dir.encode()).hexdigest()[:12]}"


# --- SQL parts used more than once ---------------------------------------------------------------------------------

_IN_Q1 = "CAST(l_shipdate AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1998-03-31'"
_SUM = "CAST(SUM(CAST({0} AS DECIMAL(18,2))) AS DOUBLE)"
_SALES = _SUM.format("l_extendedprice")
_DISCOUNTED = _SUM.format("CASE WHEN l_discount >= 0.03 THEN l_extendedprice END")
_SUMMARY = f"SELECT l_partkey AS product_id, {_SALES} AS total_sales FROM lineitem WHERE {_IN_Q1} GROUP BY l_partkey"
_SUMMARY_NULLS = (
    f"SELECT l_partkey AS product_id, {_DISCOUNTED} AS total_sales FROM lineitem WHERE {_IN_Q1} GROUP BY l_partkey"
)
_DETAIL = f"{_SUMMARY_NULLS} HAVING {_DISCOUNTED} IS NOT NULL"
_REGION = "CASE WHEN o_custkey IN (1, 2) THEN 'north_america' ELSE 'europe' END"
_CUSTOMER_ORDERS = (
    "SELECT c_name AS customer_name, c_mktsegment AS customer_segment, o_orderkey AS order_id, "
    "o_orderstatus AS order_status FROM customer JOIN orders ON c_custkey = o_custkey"
)
_LEFT = "SELECT o_orderkey AS k, o_totalprice AS v FROM orders"
_RIGHT = """
SELECT o_orderkey AS k,
       CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS v
FROM orders WHERE NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')
UNION ALL SELECT -c_custkey - 1 AS k, c_acctbal AS v FROM customer
"""
_KEY_STATUS = """
CASE WHEN b.k IS NULL THEN 'only_left' WHEN a.k IS NULL THEN 'only_right'
     WHEN a.v = b.v OR (a.v IS NULL AND b.v IS NULL) THEN 'same' ELSE 'changed' END
"""
_KEYED_DIFF = f"""
SELECT COALESCE(a.k, b.k) AS k, {_KEY_STATUS} AS status
FROM ({_LEFT}) a FULL OUTER JOIN ({_RIGHT}) b ON a.k = b.k WHERE {_KEY_STATUS} <> 'same'
"""


# --- sales totals --------------------------------------------------------------------------------------------------


@query(_SUMMARY)
def sales_summary(spark, sf_dir):
    return sales.sales_totals(lines(spark, sf_dir), *Q1_1998, scale=2)


@query(_SUMMARY)
def sales_summary_text_dates(spark, sf_dir):
    as_text = lines(spark, sf_dir).withColumn("sale_date", F.col("sale_date").cast("date").cast("string"))
    return sales.sales_totals(as_text, *Q1_1998, scale=2)


@query(_SUMMARY)
def sales_summary_sql(spark, sf_dir):
    with scope.temp_view(lines(spark, sf_dir), "sales_table_view") as name:
        return sales.sales_totals_sql(spark, *Q1_1998, source=name, scale=2)


@query(_SUMMARY)
def sales_summary_chunked(spark, sf_dir):
    inside = filters.in_period(lines(spark, sf_dir), "sale_date", *Q1_1998)
    amount = inside.withColumn("sales", F.col("sales").cast("decimal(18,2)"))
    monthly = aggregates.total_by(
        amount.withColumn("month", F.trunc("sale_date", "month")), ["product_id", "month"], "sales"
    )
    return aggregates.combine_totals(monthly, ["product_id"]).withColumn("total_sales", F.col("total_sales").cast("double"))


@query(_SUMMARY)
def sales_summary_ordered(spark, sf_dir):
    return aggregates.ordered(sales_summary(spark, sf_dir), "product_id")


@query(_SUMMARY)
def sales_summary_held(spark, sf_dir):
    return scope.checkpointed(sales_summary(spark, sf_dir))


@query(_SUMMARY_NULLS)
def sales_summary_nulls(spark, sf_dir):
    return totals_with_nulls(spark, sf_dir)


@query(_DETAIL)
def detail_copy(spark, sf_dir):
    return sales.detail_rows(totals_with_nulls(spark, sf_dir))


def _load(spark, sf_dir, name: str, source: str, job: Callable[..., bool]) -> dict[str, str]:
    """Run ``job`` on the named sales; the names of the tables it filled."""
    targets = {role: scratch(spark, sf_dir, f"{name}_{role}") for role in ("summary", "detail")}
    for target in targets.values():
        writers.create_empty_table(spark, target, DETAIL_SCHEMA)
    job(*Q1_1998, spark, source=source, scale=2, **targets)
    return targets


@query(_SUMMARY_NULLS)
def sales_job_summary(spark, sf_dir):
    source = scratch(spark, sf_dir, "sales_table")
    lines_with_nulls(spark, sf_dir).write.mode("overwrite").saveAsTable(source)
    return readers.read_table(spark, _load(spark, sf_dir, "job", source, sales.process_sales_data)["summary"])


@query(_DETAIL)
def sales_job_detail(spark, sf_dir):
    with scope.temp_view(lines_with_nulls(spark, sf_dir), "sales_to_validate") as source:
        targets = _load(spark, sf_dir, "job_validated", source, sales.process_sales_data_with_validation)
    return readers.read_table(spark, targets["detail"])


@query(_DETAIL)
def sales_job_optimized(spark, sf_dir):
    with scope.temp_view(lines_with_nulls(spark, sf_dir), "sales_to_stage") as source:
        targets = _load(spark, sf_dir, "job_optimized", source, sales.process_sales_data_optimized)
    return readers.read_table(spark, targets["detail"])


@query(_DETAIL)
def sales_job_sql(spark, sf_dir):
    with scope.temp_view(lines_with_nulls(spark, sf_dir), "sales_for_sql") as source:
        targets = _load(spark, sf_dir, "job_sql", source, sales.process_sales_data_sql_approach)
    return readers.read_table(spark, targets["detail"])


@query(_SUMMARY_NULLS)
def sales_job_sql_summary(spark, sf_dir):
    with scope.temp_view(lines_with_nulls(spark, sf_dir), "sales_for_sql_summary") as source:
        targets = _load(spark, sf_dir, "job_sql_2", source, sales.process_sales_data_sql_approach)
    return readers.read_table(spark, targets["summary"])


@query(_SUMMARY_NULLS)
def sales_job_function(spark, sf_dir):
    with scope.temp_view(lines_with_nulls(spark, sf_dir), "sales_for_function") as source:
        targets = _load(spark, sf_dir, "job_function", source, sales.process_sales_data_function)
    return readers.read_table(spark, targets["summary"])


@query(
    f"""WITH t AS ({_SUMMARY_NULLS}) SELECT product_id, total_sales FROM t WHERE product_id <
    (SELECT COALESCE(MIN(CASE WHEN total_sales IS NULL THEN product_id END), 9223372036854775807) FROM t)"""
)
def rows_before_first_null(spark, sf_dir):
    # read twice, for the first NULL and for the rows before it
    return filters.before_first_null(
        scope.checkpointed(totals_with_nulls(spark, sf_dir)), key="product_id", value="total_sales"
    )


@query(
    f"""SELECT l_partkey AS product_id, {_SALES} AS total_sales FROM lineitem
    WHERE CAST(l_shipdate AS DATE) = DATE '1998-02-10' GROUP BY l_partkey"""
)
def single_day(spark, sf_dir):
    rows = filters.on_day(lines(spark, sf_dir), "sale_date", "1998-02-10")
    return aggregates.total_by(rows, ["product_id"], "sales", scale=2)


@query(
    f"""SELECT l_partkey AS product_id, {_SALES} AS total_sales FROM lineitem
    WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1998-12-31' AND DATE '1998-01-01' GROUP BY l_partkey"""
)
def inverted_range(spark, sf_dir):
    return sales.sales_totals(lines(spark, sf_dir), "1998-12-31", "1998-01-01", scale=2)


@query(
    f"""SELECT CASE WHEN l_returnflag <> 'N' THEN l_partkey END AS product_id, {_SALES} AS total_sales FROM lineitem
    WHERE {_IN_Q1} GROUP BY CASE WHEN l_returnflag <> 'N' THEN l_partkey END"""
)
def null_key_group(spark, sf_dir):
    rows = lines(spark, sf_dir, product=F.when(F.col("l_returnflag") != "N", F.col("l_partkey")))
    return sales.sales_totals(rows, *Q1_1998, scale=2)


_PERIODS = [(1, "1998-01-01", "1998-01-31"), (2, "1998-01-15", "1998-02-15"), (3, "1997-07-01", "1998-12-31")]


@query(
    f"""SELECT r.range_id AS range_id, l_partkey AS product_id, {_SALES} AS total_sales FROM lineitem
    JOIN (VALUES {", ".join(f"({i}, DATE '{s}', DATE '{e}')" for i, s, e in _PERIODS)}) AS r(range_id, s, e)
    ON CAST(l_shipdate AS DATE) BETWEEN r.s AND r.e GROUP BY r.range_id, l_partkey"""
)
def multi_period(spark, sf_dir):
    return sales.sales_totals_per_period(lines(spark, sf_dir), sales.periods_frame(spark, _PERIODS), scale=2)


@query(
    f"""SELECT COUNT(*) AS total_records, COUNT(DISTINCT l_partkey) AS unique_products, {_SALES} AS total_sales_amount
    FROM lineitem WHERE {_IN_Q1}"""
)
def period_stats(spark, sf_dir):
    rows = filters.in_period(lines(spark, sf_dir), "sale_date", *Q1_1998)
    return aggregates.period_statistics(rows, "product_id", "sales", scale=2)


@query(
    f"""SELECT CAST(SUM(s) AS DOUBLE) AS grand_total, CAST(MAX(s) AS DOUBLE) AS max_sales,
    CAST(MIN(s) AS DOUBLE) AS min_sales, ROUND(CAST(SUM(s) AS DOUBLE) / COUNT(s), 2) AS avg_sales,
    COUNT(*) AS total_products
    FROM (SELECT product_id, CAST(total_sales AS DECIMAL(18,2)) AS s FROM ({_SUMMARY_NULLS}) u) t"""
)
def summary_stats(spark, sf_dir):
    return aggregates.summary_statistics(totals_with_nulls(spark, sf_dir), scale=2, round_to=2)


@query("SELECT DISTINCT l_partkey FROM lineitem")
def distinct_products(spark, sf_dir):
    return aggregates.distinct_values(table(spark, sf_dir, "lineitem"), "l_partkey")


@query(
    f"""SELECT event_type, COUNT(*) AS n, {_SUM.format("value")} AS total_value FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-10' GROUP BY event_type"""
)
def events_whole_day(spark, sf_dir):
    rows = filters.in_period(table(spark, sf_dir, "events"), "ts", "2024-01-05", "2024-01-10")
    return aggregates.count_and_total_by(
        rows, ["event_type"], "value", count_name="n", total_name="total_value", scale=2
    )


@query(
    f"""SELECT event_type, COUNT(*) AS n, {_SUM.format("value")} AS total_value FROM events
    WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-10' GROUP BY event_type"""
)
def pruned_days(spark, sf_dir):
    name = scratch(spark, sf_dir, "events_by_day")
    daily = table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    writers.write_partitioned(daily, name, ["day"], compact=True)
    rows = filters.in_period(spark.table(name), "day", "2024-01-05", "2024-01-10")
    return aggregates.count_and_total_by(
        rows, ["event_type"], "value", count_name="n", total_name="total_value", scale=2
    )


@query(
    """SELECT CAST(timezone('UTC', timezone('America/New_York', ts)) AS DATE) AS utc_day, COUNT(*) AS n FROM events
    GROUP BY CAST(timezone('UTC', timezone('America/New_York', ts)) AS DATE)"""
)
def events_per_utc_day(spark, sf_dir):
    day = shift_zone(F.col("ts"), "America/New_York").cast("date")
    return aggregates.count_by(
        table(spark, sf_dir, "events").select("event_id", day.alias("utc_day")), ["utc_day"], "event_id", name="n"
    )


# --- retail --------------------------------------------------------------------------------------------------------

_SHOWN = ("customer_name", "customer_segment", "order_id", "order_status")


@query(_CUSTOMER_ORDERS)
def customer_orders(spark, sf_dir):
    return retail.customer_orders(customers(spark, sf_dir), orders(spark, sf_dir), *_SHOWN)


@query(_CUSTOMER_ORDERS)
def customer_orders_lookup(spark, sf_dir):
    wanted = customers(spark, sf_dir).select("customer_id", "customer_name", "customer_segment")
    return joins.lookup_join(orders(spark, sf_dir), wanted, "customer_id").select(*_SHOWN)


@query(_CUSTOMER_ORDERS)
def customer_orders_bucketed(spark, sf_dir):
    names, frames = {}, {}
    for name, frame in (("customers", customers(spark, sf_dir)), ("orders", orders(spark, sf_dir))):
        names[name] = scratch(spark, sf_dir, f"bucketed_{name}")
        frames[name] = frame.select("customer_id", *(c for c in _SHOWN if c in frame.columns))
    buckets = writers.buckets_for(frames["orders"], bucket_bytes=1024 * 1024)
    for name, frame in frames.items():
        writers.write_bucketed(frame, names[name], "customer_id", buckets)
    return retail.customer_orders(spark.table(names["customers"]), spark.table(names["orders"]), *_SHOWN)


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def delimited_orders(spark, sf_dir):
    columns = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"
    name = scratch(spark, sf_dir, "delimited_orders")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    readers.create_delimited_table(spark, name, columns)
    wanted = table(spark, sf_dir, "orders").select(*spark.table(name).columns)
    writers.append_by_name(wanted, name)
    return readers.read_table(spark, name)


def delimited_copy(spark, sf_dir, name: str) -> DataFrame:
    """A table written as delimited text and read again."""
    path = f"{scope.scratch_root(spark)}/delimited-{name}-{hashlib.sha256(sf_dir.encode()).hexdigest()[:12]}"
    readers.write_delimited(table(spark, sf_dir, name), path, mode="overwrite")
    return readers.read_delimited(spark, path, SCHEMAS[name])


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def delimited_documents(spark, sf_dir):
    return delimited_copy(spark, sf_dir, "documents")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def delimited_moments(spark, sf_dir):
    return delimited_copy(spark, sf_dir, "orders")


@query(
    """SELECT o_orderkey AS k, o_orderpriority || ',' || CASE WHEN o_orderstatus = 'F' THEN 'none'
    ELSE CAST(o_orderkey AS VARCHAR) END AS rest FROM orders WHERE o_orderstatus = 'F'"""
)
def delimited_rejects(spark, sf_dir):
    # of orders of one status the number is a word, so their lines do not fit
    path = f"{scope.scratch_root(spark)}/rejects-{hashlib.sha256(sf_dir.encode()).hexdigest()[:12]}"
    number = F.when(F.col("o_orderstatus") == "F", "none").otherwise(F.col("o_orderkey").cast("string"))
    lines = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", number.alias("n"))
    readers.write_delimited(lines, path, mode="overwrite")
    rejected = readers.rejected_lines(spark, path, "k bigint, priority string, n bigint")
    return rejected.select("k", F.expr("substring(_rejected, instr(_rejected, ',') + 1)").alias("rest"))


@query(f"SELECT o_orderkey AS sale_id, o_totalprice AS sale_amount, {_REGION} AS region FROM orders")
def sales_with_region(spark, sf_dir):
    return retail.sales_rows(transactions(spark, sf_dir)).select("sale_id", "sale_amount", "region")


@query(
    f"""SELECT region, COUNT(*) AS total_sales, {_SUM.format("amount")} AS total_amount
    FROM (SELECT o_totalprice AS amount, {_REGION} AS region FROM orders) t GROUP BY region"""
)
def sales_by_region(spark, sf_dir):
    return retail.sales_by_region(retail.sales_rows(transactions(spark, sf_dir)), scale=2)


@query(f"SELECT o_orderkey AS sale_id, o_totalprice AS sale_amount FROM orders WHERE {_REGION} = 'europe'")
def pruned_region(spark, sf_dir):
    name = scratch(spark, sf_dir, "sales")
    schema = "sale_id bigint, sale_amount double, sale_date string, region string"
    writers.create_empty_table(spark, name, schema, partition_by=["region"])
    retail.load_sales(transactions(spark, sf_dir), name)
    return spark.table(name).filter(F.col("region") == retail.EUROPE).select("sale_id", "sale_amount")


_REVERSED = "SELECT o_orderkey AS sale_id, REVERSE(CAST(CAST(o_orderdate AS DATE) AS STRING)) AS reversed_date FROM orders"


@query(_REVERSED)
def reversed_date(spark, sf_dir):
    return retail.reversed_dates(retail.sales_rows(transactions(spark, sf_dir)))


@query(_REVERSED)
def reversed_date_sql(spark, sf_dir):
    register_reverse_string(spark)
    with scope.temp_view(retail.sales_rows(transactions(spark, sf_dir)), "sales_rows") as name:
        return retail.reversed_dates_sql(spark, name)


@query(
    """SELECT c_name AS customer_name, COUNT(o_orderkey) AS total_orders FROM customer JOIN orders
    ON c_custkey = o_custkey GROUP BY c_name HAVING COUNT(o_orderkey) > 1"""
)
def frequent_customers(spark, sf_dir):
    return retail.frequent_customers(customers(spark, sf_dir), orders(spark, sf_dir))


# --- reconciliation ------------------------------------------------------------------------------------------------


@query(
    f"""SELECT l AS left_count, r AS right_count, l - r AS diff, l = r AS match
    FROM (SELECT (SELECT COUNT(*) FROM ({_LEFT}) a) AS l, (SELECT COUNT(*) FROM ({_RIGHT}) b) AS r) t"""
)
def row_count_check(spark, sf_dir):
    return reconcile.row_counts(*version_pair(spark, sf_dir))


@query(_KEYED_DIFF)
def keyed_diff(spark, sf_dir):
    left, right = version_pair(spark, sf_dir)
    return reconcile.keyed_diff(left, right, ["k"], only_differences=True).select("k", "status")


@query(_KEYED_DIFF)
def keyed_diff_wide(spark, sf_dir):
    left, right = version_pair(spark, sf_dir)
    return reconcile.keyed_diff(left, right, ["k"], only_differences=True, by_hash=True).select("k", "status")


_PARTS_PER_YEAR = f"""
SELECT CASE WHEN l_returnflag <> 'N' THEN l_partkey END AS product_id, {_SALES} AS total_sales FROM lineitem
WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '{{0}}-01-01' AND DATE '{{0}}-02-28'
GROUP BY CASE WHEN l_returnflag <> 'N' THEN l_partkey END
"""


@query(
    f"""SELECT COALESCE(a.product_id, b.product_id) AS product_id, a.total_sales AS left_total_sales,
    b.total_sales AS right_total_sales, a.n IS NOT NULL AS in_left, b.n IS NOT NULL AS in_right
    FROM (SELECT *, 1 AS n FROM ({_PARTS_PER_YEAR.format(1998)}) x) a
    FULL OUTER JOIN (SELECT *, 1 AS n FROM ({_PARTS_PER_YEAR.format(1999)}) y) b
    ON a.product_id IS NOT DISTINCT FROM b.product_id"""
)
def null_safe_full_join(spark, sf_dir):
    rows = lines(spark, sf_dir, product=F.when(F.col("l_returnflag") != "N", F.col("l_partkey")))
    years = [sales.sales_totals(rows, f"{y}-01-01", f"{y}-02-28", scale=2) for y in (1998, 1999)]
    return joins.full_outer_null_safe(*years, ["product_id"])


@query(
    f"""SELECT a.g AS priority, a.t AS left_total, b.t AS right_total,
    CASE WHEN ABS(a.t - b.t) <= 0.01 THEN 'match' ELSE 'mismatch' END AS status
    FROM (SELECT o_orderpriority AS g, {_SUM.format("o_totalprice")} AS t FROM orders GROUP BY o_orderpriority) a
    JOIN (SELECT o_orderpriority AS g,
          {_SUM.format("CASE WHEN o_orderpriority = '5-LOW' THEN o_totalprice + 1 ELSE o_totalprice END")} AS t
          FROM orders GROUP BY o_orderpriority) b ON a.g = b.g"""
)
def aggregate_diff(spark, sf_dir):
    left = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("v"))
    right = left.withColumn("v", F.when(F.col("priority") == "5-LOW", F.col("v") + 1).otherwise(F.col("v")))
    return reconcile.aggregate_diff(left, right, ["priority"], "v", scale=2).select(
        "priority", "left_total", "right_total", "status"
    )


@query(
    f"""SELECT COALESCE(o_orderkey, l_orderkey) AS order_id, o_total AS left_total, l_total AS right_total,
    CASE WHEN l_orderkey IS NULL THEN 'only_left' WHEN o_orderkey IS NULL THEN 'only_right'
         WHEN ABS(o_total - l_total) <= 0.01 THEN 'match' ELSE 'mismatch' END AS status
    FROM (SELECT o_orderkey, {_SUM.format("o_totalprice")} AS o_total FROM orders GROUP BY o_orderkey) o
    FULL OUTER JOIN (SELECT l_orderkey, {_SALES} AS l_total FROM lineitem GROUP BY l_orderkey) l
    ON o_orderkey = l_orderkey"""
)
def order_totals_against_lines(spark, sf_dir):
    heads = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_totalprice").alias("v"))
    details = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_extendedprice").alias("v")
    )
    return reconcile.aggregate_diff(heads, details, ["order_id"], "v", tolerance=0.01, scale=2).drop("abs_diff")


@query(
    """SELECT l_orderkey, l_linenumber, CAST(n_left - n_right AS BIGINT) AS surplus
    FROM (SELECT l_orderkey, l_linenumber, COUNT(*) AS n_left, COUNT(CASE WHEN l_returnflag <> 'R' THEN 1 END) AS n_right
          FROM lineitem GROUP BY l_orderkey, l_linenumber) t WHERE n_left <> n_right"""
)
def bag_diff(spark, sf_dir):
    left = table(spark, sf_dir, "lineitem")
    return reconcile.bag_diff(left, left.filter("l_returnflag <> 'R'"), ["l_orderkey", "l_linenumber"])


@query(
    """SELECT l_orderkey, l_linenumber FROM lineitem
    EXCEPT ALL SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag <> 'R'"""
)
def bag_difference(spark, sf_dir):
    left = table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    return reconcile.bag_difference(left.select(*keys), left.filter("l_returnflag <> 'R'").select(*keys))


@query(
    """SELECT COUNT(CASE WHEN d = DATE '1998-01-01' THEN 1 END) AS at_start,
    COUNT(CASE WHEN d = DATE '1998-12-31' THEN 1 END) AS at_end,
    COUNT(CASE WHEN d BETWEEN DATE '1998-01-01' AND DATE '1998-12-31' THEN 1 END) AS inside,
    COUNT(CASE WHEN d < DATE '1998-01-01' THEN 1 END) AS before_range,
    COUNT(CASE WHEN d > DATE '1998-12-31' THEN 1 END) AS after_range
    FROM (SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem) t"""
)
def boundary_counts(spark, sf_dir):
    return reconcile.boundary_counts(table(spark, sf_dir, "lineitem"), "l_shipdate", "1998-01-01", "1998-12-31")


@query(
    """SELECT 'v' AS column_name, (SELECT COUNT(CASE WHEN o_orderstatus = 'F' THEN 1 END) FROM orders) AS left_nulls,
    (SELECT COUNT(CASE WHEN o_orderstatus = 'O' THEN 1 END) FROM orders) AS right_nulls,
    CASE WHEN (SELECT COUNT(CASE WHEN o_orderstatus = 'F' THEN 1 END) FROM orders)
            = (SELECT COUNT(CASE WHEN o_orderstatus = 'O' THEN 1 END) FROM orders)
         THEN 'match' ELSE 'mismatch' END AS status
    UNION ALL SELECT 'o_orderkey', 0, 0, 'match'"""
)
def null_diff(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    sides = [
        rows.select("o_orderkey", F.when(F.col("o_orderstatus") != status, F.col("o_totalprice")).alias("v"))
        for status in ("F", "O")
    ]
    return reconcile.null_diff(*sides, ["v", "o_orderkey"])


@query(
    f"""SELECT rows_in, rows_kept, rows_out_of_range, rows_null_date, amount_in, amount_kept, amount_out_of_range,
    rows_in = rows_kept + rows_out_of_range + rows_null_date AND amount_in = amount_kept + amount_out_of_range AS balanced
    FROM (SELECT COUNT(*) AS rows_in, COUNT(CASE WHEN {_IN_Q1} THEN 1 END) AS rows_kept,
    COUNT(CASE WHEN NOT ({_IN_Q1}) THEN 1 END) AS rows_out_of_range,
    COUNT(CASE WHEN l_shipdate IS NULL THEN 1 END) AS rows_null_date,
    {_SALES} AS amount_in, {_SUM.format(f"CASE WHEN {_IN_Q1} THEN l_extendedprice END")} AS amount_kept,
    {_SUM.format(f"CASE WHEN NOT ({_IN_Q1}) THEN l_extendedprice END")} AS amount_out_of_range FROM lineitem) t"""
)
def completeness(spark, sf_dir):
    inside = filters.period_condition(F.col("sale_date"), *Q1_1998)
    totals = reconcile.completeness(
        lines(spark, sf_dir),
        inside,
        {"out_of_range": ~inside, "null_date": F.col("sale_date").isNull()},
        amount="sales",
        scale=2,
    )
    amounts = [F.col(c).cast("double").alias(c) for c in ("amount_in", "amount_kept", "amount_out_of_range")]
    return totals.select("rows_in", "rows_kept", "rows_out_of_range", "rows_null_date", *amounts, "balanced")


@query(
    f"""SELECT (SELECT COUNT(*) FROM ({_SUMMARY}) a) AS first_rows, (SELECT COUNT(*) FROM ({_SUMMARY}) b) AS second_rows,
    NOT EXISTS (({_SUMMARY}) EXCEPT ALL ({_SUMMARY})) AS identical"""
)
def repeatability(spark, sf_dir):
    return reconcile.repeatability(sales_summary(spark, sf_dir), sales_summary_chunked(spark, sf_dir))


_BAD_KEYS = f"SELECT COUNT(*) FROM ({_KEYED_DIFF}) d WHERE status"


@query(
    f"""SELECT check_name, item, CAST(l AS VARCHAR) AS left_value, CAST(r AS VARCHAR) AS right_value,
    CASE WHEN l = r AND check_name <> 'differing_rows' THEN 'pass' WHEN l = 0 AND r = 0 THEN 'pass' ELSE 'fail' END AS status
    FROM (
    SELECT 'schema' AS check_name, NULL AS item, 2 AS l, 2 AS r
    UNION ALL SELECT 'row_count', NULL, (SELECT COUNT(*) FROM ({_LEFT}) a), (SELECT COUNT(*) FROM ({_RIGHT}) b)
    UNION ALL SELECT 'null_count', 'k', 0, 0 UNION ALL SELECT 'null_count', 'v', 0, 0
    UNION ALL SELECT 'repeated_keys', NULL, 0, 0
    UNION ALL SELECT 'differing_rows', NULL, ({_BAD_KEYS} <> 'only_right'), ({_BAD_KEYS} <> 'only_left')
    ) t"""
)
def reconciliation_report(spark, sf_dir):
    return reconcile.report(*version_pair(spark, sf_dir), ["k"])


# --- data quality --------------------------------------------------------------------------------------------------


@query(
    """SELECT 'v' AS column_name, COUNT(*) AS n_rows, COUNT(*) - COUNT(v) AS n_nulls
    FROM (SELECT CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS v FROM orders) t
    UNION ALL SELECT 'o_orderstatus' AS column_name, COUNT(*) AS n_rows, COUNT(*) - COUNT(o_orderstatus) AS n_nulls
    FROM orders"""
)
def null_profile(spark, sf_dir):
    value = F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice"))
    return quality.null_profile(table(spark, sf_dir, "orders").select(value.alias("v"), "o_orderstatus"))


@query(
    f"""SELECT COUNT(p_retailprice) AS n, COUNT(DISTINCT p_retailprice) AS n_distinct, MIN(p_retailprice) AS min_value,
    MAX(p_retailprice) AS max_value, ROUND({_SUM.format("p_retailprice")} / COUNT(p_retailprice), 4) AS mean_value
    FROM part"""
)
def column_profile(spark, sf_dir):
    return quality.column_profile(table(spark, sf_dir, "part"), "p_retailprice", scale=2)


def _profile_sql(source: str, columns: dict[str, bool]) -> str:
    parts = (
        f"SELECT '{c}' AS column_name, COUNT(*) AS n_rows, COUNT(*) - COUNT({c}) AS n_nulls, "
        f"COUNT(DISTINCT {c}) AS n_distinct, CAST(MIN({c}) AS VARCHAR) AS min_value, CAST(MAX({c}) AS VARCHAR) AS max_value, "
        f"{f'ROUND(AVG({c}), 4)' if numeric else 'CAST(NULL AS DOUBLE)'} AS mean_value FROM {source}"
        for c, numeric in columns.items()
    )
    return " UNION ALL ".join(parts)


@query(
    _profile_sql(
        "customer", {"c_custkey": True, "c_name": False, "c_nationkey": True, "c_acctbal": True, "c_mktsegment": False}
    )
)
def table_profile(spark, sf_dir):
    profile = quality.table_profile(table(spark, sf_dir, "customer"), exact=True)
    return profile.withColumn("mean_value", F.round("mean_value", 4))


@query("SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1")
def duplicate_keys(spark, sf_dir):
    return quality.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    """SELECT o_orderkey, o_custkey FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal >= 0)"""
)
def orphans(spark, sf_dir):
    solvent = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") >= 0)
    found = joins.orphans(table(spark, sf_dir, "orders"), solvent, "o_custkey", "c_custkey")
    return found.select("o_orderkey", "o_custkey")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def orders_without_lines(spark, sf_dir):
    found = joins.orphans(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"), "o_orderkey", "l_orderkey")
    return found.select("o_orderkey", "o_totalprice")


@query(
    """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders UNION ALL
    SELECT l_orderkey AS o_orderkey, l_linestatus AS o_orderstatus, CAST(NULL AS DOUBLE) AS o_totalprice FROM lineitem"""
)
def aligned_union(spark, sf_dir):
    current = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    older = table(spark, sf_dir, "lineitem").withColumnsRenamed(
        {"l_orderkey": "o_orderkey", "l_linestatus": "o_orderstatus"}
    )
    return quality.aligned_union(current.schema, current, older)


def _mixed_prices(spark, sf_dir) -> DataFrame:
    text = F.when(F.col("p_size") > 25, "n/a").otherwise(F.col("p_retailprice").cast("string"))
    return table(spark, sf_dir, "part").select("p_partkey", text.alias("v"))


_MIXED_PRICES = "SELECT p_partkey, CASE WHEN p_size > 25 THEN 'n/a' ELSE CAST(p_retailprice AS STRING) END AS v FROM part"


@query(
    f"""SELECT COUNT(*) AS n_rows, COUNT(TRY_CAST(v AS DOUBLE)) AS n_valid,
    COUNT(*) - COUNT(TRY_CAST(v AS DOUBLE)) AS n_rejected FROM ({_MIXED_PRICES}) t"""
)
def type_conformity(spark, sf_dir):
    return quality.type_conformity(_mixed_prices(spark, sf_dir), "v")


@query(f"SELECT p_partkey, TRY_CAST(v AS DOUBLE) AS v FROM ({_MIXED_PRICES}) t WHERE TRY_CAST(v AS DOUBLE) IS NOT NULL")
def type_conforming_rows(spark, sf_dir):
    return quality.split_by_type(_mixed_prices(spark, sf_dir), "v")[0]


@query(f"SELECT p_partkey, v FROM ({_MIXED_PRICES}) t WHERE v IS NOT NULL AND TRY_CAST(v AS DOUBLE) IS NULL")
def type_rejected_rows(spark, sf_dir):
    return quality.split_by_type(_mixed_prices(spark, sf_dir), "v")[1]


@query(
    """SELECT COUNT(CASE WHEN TRY_CAST(d AS DATE) IS NOT NULL AND LENGTH(d) = 10 THEN 1 END) AS n_valid,
    COUNT(CASE WHEN d IS NULL OR TRY_CAST(d AS DATE) IS NULL OR LENGTH(d) <> 10 THEN 1 END) AS n_invalid
    FROM (SELECT CASE WHEN o_orderpriority = '5-LOW' THEN '01-01-2023' WHEN o_orderpriority = '2-HIGH' THEN 'invalid'
    WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS d FROM orders) t"""
)
def date_conformity(spark, sf_dir):
    priority = F.col("o_orderpriority")
    text = (
        F.when(priority == "5-LOW", "01-01-2023")
        .when(priority == "2-HIGH", "invalid")
        .when(priority != "1-URGENT", F.col("o_orderdate").cast("date").cast("string"))
    )
    return quality.date_conformity(table(spark, sf_dir, "orders").select(text.alias("d")), "d")


@query(
    """SELECT o_orderkey FROM orders
    JOIN (SELECT o_orderpriority AS g, AVG(o_totalprice) AS m, STDDEV_SAMP(o_totalprice) AS s FROM orders
          GROUP BY o_orderpriority) t ON o_orderpriority = g WHERE ABS(o_totalprice - m) > 1.5 * s"""
)
def outliers(spark, sf_dir):
    return quality.outliers(table(spark, sf_dir, "orders"), ["o_orderpriority"], "o_totalprice", z=1.5).select("o_orderkey")


@query(
    """SELECT lang, COUNT(*) AS n_docs, COUNT(CASE WHEN STRLEN(text) <> LENGTH(text) THEN 1 END) AS n_multibyte,
    CAST(0 AS BIGINT) AS n_invalid FROM documents GROUP BY lang"""
)
def multibyte_by_lang(spark, sf_dir):
    return quality.text_encoding(table(spark, sf_dir, "documents"), "text", ["lang"])


@query(
    """SELECT source, COUNT(*) AS n_docs, COUNT(CASE WHEN lang = 'fr' THEN 1 END) AS n_invalid FROM documents
    GROUP BY source"""
)
def invalid_by_source(spark, sf_dir):
    # French texts end in a byte that begins a character and is not followed by the rest of it
    broken = F.concat(F.coalesce("text", F.lit("")).cast("binary"), F.unhex(F.lit("C3"))).cast("string")
    rows = table(spark, sf_dir, "documents")
    rows = rows.withColumn("text", F.when(F.col("lang") == "fr", broken).otherwise(F.col("text")))
    return quality.text_encoding(rows, "text", ["source"]).drop("n_multibyte")


# Every word gets blanks of its own on both sides, so that neighbours do not share one.
_WORDS = "' ' || regexp_replace(text, '[^A-Za-z0-9_]+', '  ', 'g') || ' '"


def _script_sql() -> str:
    counts = [
        f"CAST(LENGTH(regexp_extract_all({_WORDS}, '(?i) (?:{'|'.join(words)}) ')) AS BIGINT) AS {name}"
        for name, words in quality.SCRIPT_WORDS.items()
    ]
    spaced = r"regexp_replace(text, '(\s)', '\1\1', 'g')"
    phrase = f"(?i)(?:^|[^A-Za-z0-9_]){quality.TEMPORARY_TABLE}(?:$|[^A-Za-z0-9_])"
    tables = r"regexp_extract_all(lower(text), '(?:^|[^a-z0-9_])(?:from|join|into|table)\s+([a-z_][a-z0-9_.]*)', 1)"
    return (
        "SELECT doc_id, CAST(LENGTH(string_split(text, chr(10))) AS BIGINT) AS n_lines, "
        f"{', '.join(counts)}, CAST(LENGTH(regexp_extract_all({spaced}, '{phrase}')) AS BIGINT) AS n_temporary, "
        f"CAST(LENGTH(list_distinct({tables})) AS BIGINT) AS n_tables FROM documents"
    )


# Comments and quoted texts, as in SQL scripts; DuckDB has no possessive forms and needs none.
_NO_CODE = r"""'[^']*(?:'|\z)|"[^"]*(?:"|\z)|--[^\n]*|(?s:/\*.*?(?:\*/|\z))""".replace("'", "''")


@query(
    _script_sql().replace("FROM documents", "FROM (SELECT doc_id, text AS whole, "
    f"regexp_replace(text, '{_NO_CODE}', ' ', 'g') AS text FROM documents) t")
    .replace("string_split(text, chr(10))", "string_split(whole, chr(10))")
)
def script_metrics_of_code(spark, sf_dir):
    return quality.script_metrics(table(spark, sf_dir, "documents").select("doc_id", "text"), code_only=True)


@query(_script_sql())
def script_metrics(spark, sf_dir):
    return quality.script_metrics(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query(
    f"""SELECT 'read' AS step, COUNT(*) AS n_rows FROM lineitem
    UNION ALL SELECT 'period', COUNT(*) FROM lineitem WHERE {_IN_Q1}
    UNION ALL SELECT 'summary', COUNT(*) FROM ({_SUMMARY_NULLS}) s
    UNION ALL SELECT 'detail', COUNT(*) FROM ({_DETAIL}) d"""
)
def audit_trail(spark, sf_dir):
    trail = AuditTrail(spark, run_id="q1-1998")
    rows = trail.step(lines_with_nulls(spark, sf_dir), "read")
    # a filter below a counter could not reach the scan; this trail wants to know the rows before it
    rows = trail.step(filters.in_period(rows, "sale_date", *Q1_1998), "period")
    totals = trail.step(aggregates.total_by(rows, ["product_id"], "sales", scale=2), "summary")
    scope.checkpointed(trail.step(sales.detail_rows(totals), "detail"))
    return trail.rows().select("step", F.col("value").cast("long").alias("n_rows"))


_SLIDING = """SELECT range_id, l_suppkey AS product_id, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_sales
FROM ({periods}) p JOIN lineitem ON CAST(l_shipdate AS DATE) BETWEEN s AND e GROUP BY range_id, l_suppkey"""


def supplier_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir, product=F.col("l_suppkey"))


@query(
    _SLIDING.format(
        periods="""SELECT CAST(i AS INTEGER) AS range_id, CAST(DATE '1998-01-01' + CAST(i AS INTEGER) AS DATE) AS s,
        CAST(DATE '1998-01-01' + CAST(i AS INTEGER) + 89 AS DATE) AS e FROM range(365) t(i)"""
    )
)
def sliding_periods(spark, sf_dir):
    first = datetime.date(1998, 1, 1)
    starts = [first + datetime.timedelta(days=i) for i in range(365)]
    periods = [(i, s, s + datetime.timedelta(days=89)) for i, s in enumerate(starts)]
    return sales.sales_totals_per_period(supplier_lines(spark, sf_dir), sales.periods_frame(spark, periods), scale=2)


@query(
    _SLIDING.format(
        periods="""SELECT * FROM (VALUES (1, DATE '1998-01-01', DATE '1998-02-28'), (1, DATE '1998-06-01', DATE '1998-06-30'),
        (2, DATE '1998-02-01', DATE '1998-06-15'), (3, DATE '1998-03-01', DATE '1998-02-01')) t(range_id, s, e)"""
    )
)
def one_id_in_several_periods(spark, sf_dir):
    periods = [
        (1, "1998-01-01", "1998-02-28"),
        (1, "1998-06-01", "1998-06-30"),
        (2, "1998-02-01", "1998-06-15"),
        (3, "1998-03-01", "1998-02-01"),
    ]
    return sales.sales_totals_per_period(supplier_lines(spark, sf_dir), sales.periods_frame(spark, periods), scale=2)


# --- values of many digits, nested values, catalog operators ----------------------------------------------------------

# The true product has six digits; in a double its last digits are noise, which rounding to six takes away.
_FINE = "CAST(ROUND(l_extendedprice * l_discount * l_tax, 6) AS DECIMAL(18,6))"


def fine_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    product = F.round(F.col("l_extendedprice") * F.col("l_discount") * F.col("l_tax"), 6)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("k"), F.col("l_returnflag").alias("flag"), product.alias("v")
    )


@query(f"SELECT l_partkey AS k, CAST(SUM({_FINE}) AS DOUBLE) AS total FROM lineitem GROUP BY l_partkey")
def fine_totals(spark, sf_dir):
    return aggregates.total_by(fine_lines(spark, sf_dir), ["k"], "v", name="total", scale=6)


@query(
    f"""SELECT l_returnflag AS flag, CAST(SUM({_FINE}) AS DOUBLE) AS left_total,
    CAST(SUM({_FINE} + CASE WHEN l_returnflag = 'R' THEN 0.000001 ELSE 0 END) AS DOUBLE) AS right_total,
    CASE WHEN l_returnflag = 'R' THEN 'mismatch' ELSE 'match' END AS status FROM lineitem GROUP BY l_returnflag"""
)
def fine_aggregate_diff(spark, sf_dir):
    left = fine_lines(spark, sf_dir)
    right = left.withColumn("v", F.when(F.col("flag") == "R", F.round(F.col("v") + 0.000001, 6)).otherwise(F.col("v")))
    found = reconcile.aggregate_diff(left, right, ["flag"], "v", scale=6)
    return found.select("flag", "left_total", "right_total", "status")


@query(
    f"""WITH t AS (SELECT CAST(SUM({_FINE}) AS DOUBLE) AS s FROM lineitem GROUP BY l_partkey)
    SELECT CAST(SUM(CAST(ROUND(s, 6) AS DECIMAL(28,6))) AS DOUBLE) AS grand_total, MAX(s) AS max_sales,
    MIN(s) AS min_sales, COUNT(*) AS total_products FROM t"""
)
def fine_summary_stats(spark, sf_dir):
    totals = aggregates.total_by(fine_lines(spark, sf_dir), ["k"], "v", scale=6)
    return aggregates.summary_statistics(totals, scale=6).drop("avg_sales")


@query(
    f"""SELECT COUNT(*) AS rows_in, CAST(COUNT(*) FILTER (WHERE l_returnflag = 'R') AS BIGINT) AS rows_kept,
    CAST(SUM({_FINE}) AS DOUBLE) AS amount_in,
    CAST(SUM({_FINE}) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) AS amount_kept, TRUE AS balanced FROM lineitem"""
)
def fine_completeness(spark, sf_dir):
    kept = F.col("flag") == "R"
    totals = reconcile.completeness(fine_lines(spark, sf_dir), kept, {"others": ~kept}, amount="v", scale=6)
    return totals.select("rows_in", "rows_kept", "amount_in", "amount_kept", "balanced")


@query(
    f"""SELECT 'total' AS check_name, CAST(SUM({_FINE}) AS DOUBLE) AS left_value,
    CAST(SUM({_FINE}) + 0.000001 * COUNT(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) AS right_value, 'fail' AS status
    FROM lineitem"""
)
def fine_report(spark, sf_dir):
    left = fine_lines(spark, sf_dir).withColumnRenamed("k", "l_partkey")
    right = left.withColumn("v", F.when(F.col("flag") == "R", F.round(F.col("v") + 0.000001, 6)).otherwise(F.col("v")))
    lines = reconcile.report(left, right, ["l_partkey"], value="v", scale=6).filter("check_name = 'total'")
    values = [F.col(c).cast("double").alias(c) for c in ("left_value", "right_value")]
    return lines.select("check_name", *values, "status")


@query(
    """SELECT o_orderpriority AS priority, SUM(CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
        THEN CAST('nan' AS DOUBLE) WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN CAST('inf' AS DOUBLE)
        ELSE CAST(o_custkey AS DOUBLE) END) AS total FROM orders GROUP BY o_orderpriority"""
)
def totals_with_nan_and_infinity(spark, sf_dir):
    odd = F.when(F.col("o_orderpriority") == "1-URGENT", float("nan")).when(
        F.col("o_orderpriority") == "5-LOW", float("inf")
    )
    value = F.coalesce(F.when(F.col("o_orderstatus") == "F", odd), F.col("o_custkey").cast("double"))
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("priority"), value.alias("v"))
    return aggregates.total_by(rows, ["priority"], "v", name="total", scale=2)


@query(
    """SELECT o_orderkey AS k, CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 'changed' ELSE 'same' END
    AS status FROM orders"""
)
def keyed_diff_nested(spark, sf_dir):
    # the second version has the same values in another place of the array
    rows = table(spark, sf_dir, "orders")
    price, none = F.col("o_totalprice"), F.lit(None).cast("double")
    moved = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    left = rows.select(F.col("o_orderkey").alias("k"), F.array(F.array(price, none), F.array(price)).alias("a"))
    right = rows.select(
        F.col("o_orderkey").alias("k"),
        F.when(moved, F.array(F.array(none, price), F.array(price)))
        .otherwise(F.array(F.array(price, none), F.array(price)))
        .alias("a"),
    )
    return reconcile.keyed_diff(left, right, ["k"]).select("k", "status")


@query(
    """SELECT COALESCE(a.column_name, b.column_name) AS column_name, CASE WHEN b.column_name IS NULL THEN 'only_left'
    WHEN a.column_name IS NULL THEN 'only_right' WHEN a.data_type = b.data_type THEN 'same' ELSE 'type_changed' END AS status
    FROM (SELECT column_name, data_type FROM duckdb_columns() WHERE table_name = 'documents') a
    FULL JOIN (SELECT column_name, data_type FROM duckdb_columns() WHERE table_name = 'conversations') b USING (column_name)"""
)
def schema_diff(spark, sf_dir):
    sides = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "conversations"))
    return reconcile.schema_diff(*sides).select("column_name", "status")


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def appended_or_created(spark, sf_dir):
    name = scratch(spark, sf_dir, "appended")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    for part in (F.col("o_orderstatus") == "F", F.col("o_orderstatus") != "F"):
        writers.append_or_create(rows.filter(part), name)
    return readers.read_table(spark, name)


@query("SELECT o_orderkey, o_orderstatus AS status FROM orders WHERE o_orderstatus = 'F'")
def added_partition(spark, sf_dir):
    name = scratch(spark, sf_dir, "added_partition")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} (o_orderkey bigint, status string) USING parquet PARTITIONED BY (status)")
    catalog.add_partition(spark, name, status="F")
    rows = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select("o_orderkey")
    writers.replace_partition(rows, name, status="F")
    return readers.read_table(spark, name)


@query(
    """SELECT c_name AS customer_name, COUNT(o_orderkey) AS total_orders FROM customer JOIN orders ON c_custkey = o_custkey
    GROUP BY c_name HAVING COUNT(o_orderkey) > 1"""
)
def retail_job_view(spark, sf_dir):
    database = f"tallymark_retail_{hashlib.sha256(sf_dir.encode()).hexdigest()[:12]}"
    before = spark.catalog.currentDatabase()
    catalog.create_database(spark, database, f"{scope.scratch_root(spark)}/{database}")
    retail.drop_all(spark, database)
    retail.create_tables(spark, database, f"{scope.scratch_root(spark)}/{database}")
    try:
        none = F.lit(None)
        rows = customers(spark, sf_dir).withColumns(
            {f"customer_{c}": none.cast("string") for c in ("email", "city", "state")} | {"customer_zipcode": none.cast("int")}
        )
        writers.append_by_name(rows.select(*spark.table("customers").columns), "customers", allow_narrowing=True)
        rows = orders(spark, sf_dir).withColumn("order_date", F.col("o_orderdate").cast("date").cast("string"))
        writers.append_by_name(rows.select(*spark.table("orders").columns), "orders", allow_narrowing=True)
        days = transactions(spark, sf_dir).withColumn("transaction_id", F.col("transaction_id").cast("int"))
        retail.run(spark, days, database)
        return readers.read_table(spark, f"{database}.frequent_customers")
    finally:
        catalog.use_database(spark, before)


# --- many periods, checksums ------------------------------------------------------------------------------------------


@query(
    """SELECT range_id, l_suppkey AS product_id, COALESCE(SUM(CASE WHEN l_returnflag = 'A' AND l_linenumber = 7
    THEN CAST('nan' AS DOUBLE) WHEN l_returnflag = 'N' AND l_linenumber = 6 THEN CAST('inf' AS DOUBLE) END),
    COALESCE(SUM(CASE WHEN l_linenumber = 5 THEN CAST(100000000000000000 AS DOUBLE) END), 0)
    + COALESCE(SUM(CASE WHEN l_linenumber <> 5 THEN l_quantity END), 0)) AS total_sales
    FROM (SELECT CAST(i AS INTEGER) AS range_id, CAST(DATE '1995-01-01' + CAST(i AS INTEGER) AS DATE) AS d
    FROM range(2500) t(i)) p JOIN lineitem ON CAST(l_shipdate AS DATE) = d GROUP BY range_id, l_suppkey"""
)
def one_day_periods(spark, sf_dir):
    odd = F.when((F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 7), float("nan"))
    odd = odd.when((F.col("l_returnflag") == "N") & (F.col("l_linenumber") == 6), float("inf"))
    amount = odd.when(F.col("l_linenumber") == 5, 1e17).otherwise(F.col("l_quantity"))
    days = [datetime.date(1995, 1, 1) + datetime.timedelta(days=i) for i in range(2500)]
    periods = sales.periods_frame(spark, [(i, d, d) for i, d in enumerate(days)])
    return sales.sales_totals_per_period(lines(spark, sf_dir, amount, F.col("l_suppkey")), periods, scale=2)


_LINE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(
    f"""SELECT {", ".join(_LINE_KEY)}, CASE WHEN COUNT(*) > 1 THEN 'repeated' ELSE 'changed' END AS status FROM lineitem
    GROUP BY {", ".join(_LINE_KEY)} HAVING MAX(l_extendedprice) = (SELECT MAX(l_extendedprice) FROM lineitem)"""
)
def tree_diff_lines(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    dearest = rows.agg(F.max("l_extendedprice")).first()[0]
    price = F.col("l_extendedprice")
    second = rows.withColumn("l_extendedprice", F.when(price == dearest, price + 1).otherwise(price))
    return checksums.tree_diff(rows, second, _LINE_KEY).select(*_LINE_KEY, "status")


@query("""SELECT doc_id, 'changed' AS status FROM documents WHERE lang = 'es' AND source = 'src1'""")
def tree_diff_maps(spark, sf_dir):
    # the second version has the entries of every map the other way round, and another value in some
    rows = table(spark, sf_dir, "documents")
    lang, source = F.col("lang"), F.col("source")
    other = F.when((lang == "es") & (source == "src1"), F.lit("es?")).otherwise(lang)
    about = F.struct(F.array(source, lang).alias("both"), F.col("n_chars"))
    left = rows.select("doc_id", about.alias("about"), F.create_map(F.lit("lang"), lang, F.lit("source"), source).alias("m"))
    right = rows.select("doc_id", about.alias("about"), F.create_map(F.lit("source"), source, F.lit("lang"), other).alias("m"))
    return checksums.tree_diff(left, right, ["doc_id"]).select("doc_id", "status")


# --- sketches, heavy keys, published loads, robust outliers --------------------------------------------------------------


_PROFILED = ("l_quantity", "l_extendedprice", "l_partkey")


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, COUNT(*) AS n_rows, COUNT(*) - COUNT({c}) AS n_nulls,
        CAST(MIN({c}) AS DOUBLE) AS min_value, CAST(MAX({c}) AS DOUBLE) AS max_value,
        ROUND({_SUM.format(c)} / COUNT({c}), 4) AS mean_value, TRUE AS distinct_within, TRUE AS median_within
        FROM lineitem WHERE {_IN_Q1}"""
        for c in _PROFILED
    )
)
def period_profile_from_sketches(spark, sf_dir):
    name = scratch(spark, sf_dir, "daily_sketches")
    rows = table(spark, sf_dir, "lineitem")
    sketches.daily_sketches(rows, "l_shipdate", _PROFILED).write.mode("overwrite").saveAsTable(name)
    found = sketches.profile_of_period(spark.table(name), *Q1_1998)
    # the estimates against the rows themselves
    medians = {r["column_name"]: r["quantiles"][1] for r in found.collect()}
    inside = filters.in_period(rows, "l_shipdate", *Q1_1998)
    exact = inside.agg(
        *(
            F.struct(
                F.count_distinct(c).alias("n_distinct"),
                F.avg((F.col(c) < medians[c]).cast("double")).alias("below"),
                F.avg((F.col(c) <= medians[c]).cast("double")).alias("upto"),
            ).alias(c)
            for c in _PROFILED
        )
    ).unpivot([], list(_PROFILED), "column_name", "exact")
    off = F.abs(F.col("n_distinct") - F.col("exact.n_distinct")) <= sketches.DISTINCT_BOUND * F.col("exact.n_distinct")
    middle = (F.col("exact.below") - sketches.RANK_BOUND <= 0.5) & (F.col("exact.upto") + sketches.RANK_BOUND >= 0.5)
    figures = ("n_rows", "n_nulls", "min_value", "max_value", F.round("mean_value", 4).alias("mean_value"))
    return found.join(exact, "column_name").select(
        "column_name", *figures, off.alias("distinct_within"), middle.alias("median_within")
    )


@query(
    """SELECT c_name AS customer_name, c_mktsegment AS customer_segment, o_orderkey AS order_id, o_orderstatus AS order_status
    FROM customer JOIN orders ON c_custkey = CASE WHEN o_orderstatus = 'F' THEN 1 ELSE o_custkey END"""
)
def customer_orders_heavy_apart(spark, sf_dir):
    # a third of all orders is of one customer
    key = F.when(F.col("order_status") == "F", 1).otherwise(F.col("customer_id"))
    frames = {"customers": customers(spark, sf_dir), "orders": orders(spark, sf_dir).withColumn("customer_id", key)}
    names = {name: scratch(spark, sf_dir, f"apart_{name}") for name in frames}
    rows = {names[n]: df.select("customer_id", *(c for c in _SHOWN if c in df.columns)) for n, df in frames.items()}
    heavy.write_apart(rows, "customer_id")
    return heavy.join_apart(spark, names["orders"], names["customers"], "customer_id", columns=_SHOWN)


def ledger_of(spark: SparkSession, sf_dir: str) -> tuple[Ledger, dict[str, str]]:
    """A ledger and two targets without rows."""
    names = {n: scratch(spark, sf_dir, f"published_{n}") for n in ("ledger", "summary", "detail", "source")}
    spark.sql(f"DROP TABLE IF EXISTS {names['ledger']}")
    ledger = Ledger(spark, names.pop("ledger"))
    for target in ("summary", "detail"):
        ledger.create_target(names[target], DETAIL_SCHEMA)
    lines_with_nulls(spark, sf_dir).write.mode("overwrite").saveAsTable(names["source"])
    return ledger, names


@query(_DETAIL)
def published_load(spark, sf_dir):
    ledger, names = ledger_of(spark, sf_dir)
    # a run that broke off between its writes, a run that a later one of the same period replaces, and that later run
    broken = sales.sales_totals(spark.table(names["source"]), "1998-01-01", "1998-06-30", scale=2)
    ledger.stage(broken, names["summary"], job="process_sales_data", scope="broken", run_id="r0")
    for run in ("r1", "r2"):
        sales.process_sales_data_published(*Q1_1998, spark, ledger=ledger, run_id=run, **names, scale=2)
    return ledger.read(names["detail"])


@query(
    """SELECT o_orderkey FROM orders JOIN (SELECT o_orderpriority AS g, MEDIAN(o_totalprice) AS m, MAD(o_totalprice) AS d
    FROM orders GROUP BY o_orderpriority) t ON o_orderpriority = g WHERE 0.6745 * ABS(o_totalprice - m) > 1.2 * d"""
)
def robust_outliers(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    return quality.robust_outliers(rows, ["o_orderpriority"], "o_totalprice", cutoff=1.2).select("o_orderkey")


@query("SELECT l_suppkey, l_returnflag, MEDIAN(l_extendedprice) AS median FROM lineitem GROUP BY l_suppkey, l_returnflag")
def exact_medians(spark, sf_dir):
    return quality.exact_medians(table(spark, sf_dir, "lineitem"), ["l_suppkey", "l_returnflag"], "l_extendedprice")


@query(
    f"""SELECT l_suppkey, {_SALES} AS total_sales, {_SALES} AS retraced, COUNT(DISTINCT l_returnflag || l_linestatus) AS n_parts
    FROM lineitem GROUP BY l_suppkey"""
)
def totals_traced_to_files(spark, sf_dir):
    name, keys = scratch(spark, sf_dir, "lines_by_flag"), ["l_suppkey"]
    writers.write_partitioned(table(spark, sf_dir, "lineitem"), name, ["l_returnflag", "l_linestatus"])
    rows = spark.table(name)
    files = lineage.numbered_files(rows)
    totals = scope.checkpointed(lineage.traced_totals(rows, files, keys, "l_extendedprice"))
    again = lineage.retraced_totals(rows, totals, files, keys, "l_extendedprice").drop("sources", "same")
    part = F.regexp_extract("file", "l_returnflag=[^/]*/l_linestatus=[^/]*", 0)
    parts = lineage.sources_of(totals, files, keys).groupBy(*keys).agg(F.count_distinct(part).alias("n_parts"))
    return again.join(parts, keys)


@query(
    f"""SELECT l_suppkey, COUNT(*) AS n, {_SALES} AS total FROM lineitem
    WHERE {_IN_Q1} OR l_partkey BETWEEN 100 AND 120 GROUP BY l_suppkey"""
)
def clustered_lines(spark, sf_dir):
    name = scratch(spark, sf_dir, "lines_clustered")
    clustered.write_clustered(table(spark, sf_dir, "lineitem"), name, ["l_shipdate", "l_partkey"], files=16)
    either = filters.period_condition(F.col("l_shipdate"), *Q1_1998) | F.col("l_partkey").between(100, 120)
    return aggregates.count_and_total_by(
        spark.table(name).where(either), ["l_suppkey"], "l_extendedprice", count_name="n", total_name="total", scale=2
    )


# --- operators of a training-data pipeline, if they are there ---------------------------------------------------------


def _llm() -> tuple[dict[str, Query], dict[str, str]]:
    try:
        import corpus_pipeline
        from tallymark.llm import queries as llm
    except ModuleNotFoundError as missing:
        if missing.name not in ("corpus_pipeline", "tallymark.llm"):
            raise
        return {}, {}
    pipeline_sql = {} if corpus_pipeline.ORACLE_SQL is None else {"pipeline": corpus_pipeline.ORACLE_SQL}
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run}, {**llm.SQL, **pipeline_sql}


# --- contract ------------------------------------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    return sales_summary(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return {**_QUERIES, **_llm()[0]}


def oracle_sql() -> dict[str, str]:
    return {**_SQL, **_llm()[1]}
