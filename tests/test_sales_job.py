from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor

import pytest
from conftest import physical_plan, rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallymark import sources
from tallymark.operators import reconcile
from tallymark.operators.audit import AuditTrail
from tallymark.operators.quality import MissingColumns
from tallymark.plans import sales

JANUARY = ("2024-01-01", "2024-01-31")
TARGET = "product_id string, total_sales double"

JOBS = {
    "default": sales.process_sales_data,
    "validating": sales.process_sales_data_with_validation,
    "optimized": sales.process_sales_data_optimized,
    "sql": sales.process_sales_data_sql_approach,
    "cached": lambda *a, **o: sales.process_sales_data(*a, hold="cache", **o),
}


@pytest.fixture
def tables(spark, database):
    """Targets, and a function that fills the source: text or DATE days, columns in either order."""
    for target in (sales.SUMMARY, sales.DETAIL):
        sources.create_empty_table(spark, target, TARGET)

    def fill(data, *, typed=True, order=("product_id", "sales", "sale_date"), amount="double"):
        df = spark.createDataFrame(list(data), "product_id string, sale_date string, sales double")
        day = F.col("sale_date").cast("date") if typed else F.col("sale_date")
        shaped = df.select("product_id", day.alias("sale_date"), F.col("sales").cast(amount).alias("sales"))
        shaped.select(*order).write.mode("overwrite").saveAsTable(sales.SOURCE)

    return fill


def loaded(spark):
    return rows(spark.table(sales.SUMMARY)), rows(spark.table(sales.DETAIL))


# Rows, periods and expected totals of the documented cases.
CASES = {
    "basic": (
        [("P001", "2024-01-15", 100.0), ("P002", "2024-01-20", 200.0), ("P001", "2024-01-25", 150.0)],
        JANUARY,
        [("P001", 250.0), ("P002", 200.0)],
    ),
    "single day": (
        [("P001", "2024-01-15", 100.0), ("P002", "2024-01-15", 200.0), ("P001", "2024-01-16", 150.0)],
        ("2024-01-15", "2024-01-15"),
        [("P001", 100.0), ("P002", 200.0)],
    ),
    "boundaries": (
        [
            ("P001", "2024-01-01", 100.0),
            ("P002", "2024-01-31", 200.0),
            ("P003", "2023-12-31", 300.0),
            ("P004", "2024-02-01", 400.0),
        ],
        JANUARY,
        [("P001", 100.0), ("P002", 200.0)],
    ),
    "copies": (
        [("P001", "2023-01-15", 100.0), ("P001", "2023-01-15", 100.0), ("P001", "2023-01-16", 150.0)],
        ("2023-01-01", "2023-12-31"),
        [("P001", 350.0)],
    ),
    "null ids": (
        [(None, "2023-01-15", 1.0), ("P001", "2023-01-15", 2.0), (None, "2023-02-15", 3.0)],
        ("2023-01-01", "2023-12-31"),
        [("P001", 2.0), (None, 4.0)],
    ),
    "null days": ([("P001", None, 1.0), ("P001", "2024-01-02", 2.0)], JANUARY, [("P001", 2.0)]),
    "empty table": ([], JANUARY, []),
    "nothing in the period": ([("P001", "2024-01-15", 100.0)], ("2024-06-01", "2024-06-30"), []),
}


@pytest.mark.parametrize("case", CASES)
def test_totals(spark, tables, case):
    data, period, expected = CASES[case]
    for typed in (False, True):
        tables(data, typed=typed)
        df = spark.table(sales.SOURCE)
        for totals in (sales.sales_totals(df, *period), sales.sales_totals_sql(spark, *period)):
            assert rows(totals) == sorted(expected, key=repr)


@pytest.mark.parametrize("job", JOBS)
@pytest.mark.parametrize("case", ["basic", "null ids", "empty table"])
def test_every_form_of_the_job_fills_the_same_tables(spark, tables, job, case):
    data, period, expected = CASES[case]
    tables(data)
    assert JOBS[job](*period, spark) is True
    assert loaded(spark) == (sorted(expected, key=repr),) * 2


@pytest.mark.parametrize("job", JOBS)
def test_products_without_a_total_stay_out_of_the_detail(spark, tables, job):
    tables([("P001", "2024-01-15", 100.0), ("P002", "2024-01-20", None), ("P001", "2024-01-25", 150.0)])
    JOBS[job](*JANUARY, spark)
    assert loaded(spark) == ([("P001", 250.0), ("P002", None)], [("P001", 250.0)])


def test_order_of_the_source_columns_does_not_matter(spark, tables):
    data, period, expected = CASES["basic"]
    tables(data, typed=False, order=("sale_date", "sales", "product_id"))
    sales.process_sales_data(*period, spark)
    assert loaded(spark) == (expected, expected)


def test_running_again_appends_again(spark, tables):
    data, period, expected = CASES["basic"]
    tables(data)
    for _ in range(2):
        sales.process_sales_data(*period, spark)
    assert loaded(spark)[0] == sorted(expected * 2)


def test_a_failure_between_the_writes_is_found(spark, tables):
    tables([("P001", "2024-01-15", 100.0), ("P002", "2024-01-20", None)])
    sales.process_sales_data(*JANUARY, spark)
    assert sales.load_gaps(spark.table(sales.SUMMARY), spark.table(sales.DETAIL)).count() == 0
    sources.append_by_name(sales.sales_totals(spark.table(sales.SOURCE), *JANUARY), sales.SUMMARY)
    assert rows(sales.load_gaps(spark.table(sales.SUMMARY), spark.table(sales.DETAIL))) == [("P001", 100.0, 1)]


@pytest.mark.parametrize("detail", ["no_such_table", "too_narrow", "other_columns"])
def test_unfit_targets_are_found_before_the_first_write(spark, tables, detail):
    tables(CASES["basic"][0])
    sources.create_empty_table(spark, "too_narrow", "product_id string, total_sales float")
    sources.create_empty_table(spark, "other_columns", "product_id string, total double")
    with pytest.raises((AnalysisException, sources.UnsafeInsert)):
        sales.process_sales_data(*JANUARY, spark, detail=detail)
    assert loaded(spark) == ([], [])


def test_running_a_period_again_replaces_it(spark, tables):
    tables(CASES["boundaries"][0])
    for target in (sales.SUMMARY, sales.DETAIL):
        sources.create_empty_table(spark, target, f"{TARGET}, period string", partition_by=["period"])
    for period in (JANUARY, ("2023-12-31", "2024-01-01"), JANUARY):
        assert sales.process_sales_data(*period, spark, period_column="period")
    january, turn = "2024-01-01/2024-01-31", "2023-12-31/2024-01-01"
    expected = [("P001", 100.0, january), ("P001", 100.0, turn), ("P002", 200.0, january), ("P003", 300.0, turn)]
    assert loaded(spark) == (sorted(expected, key=repr),) * 2
    tables([])
    sales.process_sales_data(*turn.split("/"), spark, period_column="period")
    assert {r.period for r in spark.table(sales.SUMMARY).collect()} == {january}


def test_two_runs_give_the_same_rows(spark, tables):
    tables([(f"P{i % 7}", "2024-01-15", i / 4) for i in range(200)])
    totals = [sales.sales_totals(spark.table(sales.SOURCE).repartition(n), *JANUARY, scale=2) for n in (3, 5)]
    assert reconcile.repeatability(*totals).first().identical


@pytest.mark.parametrize(("start", "end"), [("", "2024-01-31"), ("2024-01-01", ""), (None, None)])
def test_both_dates_are_needed(spark, tables, start, end):
    # Fixed value: the message.
    with pytest.raises(ValueError, match="^Start date and end date must be provided$"):
        sales.process_sales_data_with_validation(start, end, spark)


def test_inverted_period(spark, tables):
    tables(CASES["basic"][0])
    with pytest.raises(ValueError, match="^Start date must be less than or equal to end date$"):
        sales.process_sales_data_with_validation("2024-01-31", "2024-01-01", spark)
    assert sales.process_sales_data("2024-01-31", "2024-01-01", spark)
    assert loaded(spark) == ([], [])


@pytest.mark.parametrize("bad", ["invalid-date", "01-01-2024", "2024/01/01", "2024-02-30", "2024-1-1"])
def test_invalid_date(spark, tables, bad):
    tables(CASES["basic"][0])
    with pytest.raises(ValueError, match="yyyy-MM-dd"):
        sales.process_sales_data_with_validation(bad, "2024-01-31", spark)
    assert loaded(spark) == ([], [])


def test_missing_source(spark, tables):
    for job in JOBS.values():
        with pytest.raises(AnalysisException, match="TABLE_OR_VIEW_NOT_FOUND"):
            job(*JANUARY, spark)
    assert loaded(spark) == ([], [])


@pytest.mark.parametrize("missing", ["product_id", "sales", "sale_date"])
def test_missing_column(spark, tables, missing):
    tables([], order=[c for c in ("product_id", "sales", "sale_date") if c != missing])
    with pytest.raises(MissingColumns, match=missing):
        sales.process_sales_data(*JANUARY, spark)


def test_extra_column_is_ignored(spark, tables):
    tables(CASES["basic"][0])
    spark.table(sales.SOURCE).withColumn("note", F.lit("x")).write.saveAsTable("wider")
    sales.process_sales_data(*JANUARY, spark, source="wider")
    assert loaded(spark)[0] == CASES["basic"][2]


def test_float_targets_need_consent(spark, tables):
    tables(CASES["basic"][0], amount="float")
    for target in (sales.SUMMARY, sales.DETAIL):
        sources.create_empty_table(spark, target, "product_id string, total_sales float")
    with pytest.raises(sources.UnsafeInsert, match="double -> float"):
        sales.process_sales_data(*JANUARY, spark)
    assert sales.process_sales_data(*JANUARY, spark, allow_narrowing=True)
    assert loaded(spark)[0] == CASES["basic"][2]


def test_status_instead_of_exception(spark, tables, caplog):
    assert sales.run_job(sales.process_sales_data, *JANUARY, spark) is False
    assert "process_sales_data failed" in caplog.text
    tables(CASES["basic"][0])
    assert sales.run_job(sales.process_sales_data, *JANUARY, spark) is True


def test_function_form(spark, tables):
    assert sales.process_sales_data_function(*JANUARY, spark) is False
    tables(CASES["basic"][0])
    assert sales.process_sales_data_function(*JANUARY, spark) is True
    assert loaded(spark)[1] == CASES["basic"][2]


def test_statistics(spark, tables):
    tables(CASES["boundaries"][0])
    found = sales.get_sales_statistics(*JANUARY, spark)
    assert found == {"total_records": 2, "unique_products": 2, "total_sales_amount": 300.0}
    totals = sales.sales_totals(spark.table(sales.SOURCE), *JANUARY)
    assert sales.get_sales_summary_stats(totals) == {
        "grand_total": 300.0,
        "max_sales": 200.0,
        "min_sales": 100.0,
        "avg_sales": 150.0,
        "total_products": 2,
    }
    assert sales.get_sales_summary_stats(totals.limit(0)) is None


@pytest.mark.parametrize(
    ("text", "valid"),
    [("2023-01-01", True), ("01-01-2023", False), ("2023/01/01", False), ("2024-02-30", False), ("", False), (None, False)],
)
def test_date_format(text, valid):
    assert sales.validate_date_format(text) is valid


def test_processor(spark, tables):
    tables(CASES["basic"][0])
    processor = sales.SalesDataProcessor(spark)
    assert processor.process_sales_data(*JANUARY) is True
    assert processor.process_sales_data("", "2024-01-31") is False
    processor.close()
    assert loaded(spark)[0] == CASES["basic"][2]  # the session is still there
    spark.sql(f"DROP TABLE {sales.SOURCE}")
    assert processor.process_sales_data(*JANUARY) is False


def test_nothing_is_left_behind(spark, tables):
    tables(CASES["basic"][0])
    for job in JOBS.values():
        job(*JANUARY, spark)
    assert not [t.name for t in spark.catalog.listTables() if t.isTemporary]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_figures_are_logged_and_audited(spark, tables, caplog):
    tables([("P001", "2024-01-15", 100.0), ("P002", "2024-01-20", None)])
    trail = AuditTrail(spark, "run")
    with caplog.at_level(logging.INFO, "tallymark"):
        sales.process_sales_data(*JANUARY, spark, audit=trail)
    assert "2 products, 1 with a total" in caplog.text
    found = trail.rows().select("step", "metric", F.col("value").cast("int"))
    assert rows(found) == [("summary", "n_rows", 2), ("summary", "n_without_total", 1)]


def test_parameters_are_values_not_sql(spark, tables):
    tables(CASES["basic"][0], typed=False)
    injected = sales.sales_totals_sql(spark, "2024-01-01", "2024-01-31' OR '1' = '1")
    assert rows(injected.filter("product_id = 'P001'")) == [("P001", 250.0)]
    assert sales.sales_totals_sql(spark, "x' OR '1' = '1", "x").count() == 0


def test_periods_in_parallel(spark, tables):
    days = [f"2024-{m:02d}-10" for m in range(1, 7)]
    tables([("P001", d, float(i)) for i, d in enumerate(days)])

    def run(i):
        targets = {"summary": f"summary_{i}", "detail": f"detail_{i}"}
        for target in targets.values():
            sources.create_empty_table(spark, target, TARGET)
        return sales.process_sales_data_sql_approach(days[i], days[i], spark, **targets)

    with ThreadPoolExecutor(3) as pool:
        assert all(pool.map(run, range(6)))
    assert [rows(spark.table(f"detail_{i}")) for i in range(6)] == [[("P001", float(i))] for i in range(6)]


@pytest.mark.parametrize("job", ["default", "sql"])
def test_parallel_runs_into_the_same_tables(spark, tables, job):
    days = [f"2024-{m:02d}-10" for m in range(1, 9)]
    tables([(f"P{i}", d, float(i)) for i, d in enumerate(days)])
    with ThreadPoolExecutor(4) as pool:
        assert all(pool.map(lambda d: JOBS[job](d, d, spark), days))
    expected = sorted((f"P{i}", float(i)) for i in range(8))
    assert loaded(spark) == (expected, expected)


def test_many_periods_in_one_job(spark, tables):
    tables(CASES["boundaries"][0])
    periods = sales.periods_frame(spark, [(1, *JANUARY), (2, "2023-12-31", "2024-01-01"), (3, "2025-01-01", "2025-01-02")])
    found = sales.sales_totals_per_period(spark.table(sales.SOURCE), periods)
    assert rows(found) == [(1, "P001", 100.0), (1, "P002", 200.0), (2, "P001", 100.0), (2, "P003", 300.0)]


def test_the_source_is_read_once(spark, tables):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    df = spark.createDataFrame([("P001", "2024-01-15", 1.0)] * 50, "product_id string, sale_date string, sales double")
    with sources.temp_view(df.mapInPandas(count, df.schema), "counted_sales"):
        for hold in ("checkpoint", "table", "cache"):
            sales.process_sales_data(*JANUARY, spark, source="counted_sales", hold=hold)
    assert read.value == 150


def test_filter_and_columns_reach_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    totals = sales.sales_totals(
        df, "1998-01-01", "1998-03-31", product="l_partkey", amount="l_extendedprice", date="l_shipdate"
    )
    plan = totals._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate,1998-01-01T00:00), LessThan(l_shipdate,1998-04-01T00:00)" in plan
    assert "ReadSchema: struct<l_partkey:bigint,l_extendedprice:double,l_shipdate:timestamp_ntz>" in plan
    assert "partial_sum" in plan and physical_plan(totals).count("Exchange") == 1
