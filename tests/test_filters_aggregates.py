from __future__ import annotations

import datetime
import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallymark.operators import aggregates, filters

TEXT = "product_id string, sale_date string, sales double"
JANUARY = ("2024-01-01", "2024-01-31")


def sales(spark, *data, schema=TEXT):
    return spark.createDataFrame(list(data), schema)


def with_dates(df):
    return df.withColumn("sale_date", F.col("sale_date").cast("date"))


# Rows of the documented boundary case.
BOUNDARIES = [
    ("P001", "2024-01-01", 100.0),
    ("P002", "2024-01-31", 200.0),
    ("P003", "2023-12-31", 300.0),
    ("P004", "2024-02-01", 400.0),
    ("P005", None, 500.0),
]


@pytest.mark.parametrize("typed", [False, True])
def test_period_includes_both_ends_and_no_null(spark, typed):
    df = sales(spark, *BOUNDARIES)
    found = filters.in_period(with_dates(df) if typed else df, "sale_date", *JANUARY)
    assert {r.product_id for r in found.collect()} == {"P001", "P002"}


def test_period_takes_date_objects(spark):
    df = with_dates(sales(spark, *BOUNDARIES))
    assert filters.in_period(df, "sale_date", datetime.date(2024, 1, 1), datetime.date(2024, 1, 31)).count() == 2


def test_text_dates_compare_letter_by_letter(spark):
    df = sales(spark, ("P001", "2024-1-5", 1.0), ("P002", "2024-01-05", 1.0))
    assert filters.in_period(df, "sale_date", *JANUARY).count() == 1
    assert filters.in_period(df, "sale_date", *JANUARY, as_text=False).count() == 2


def test_end_day_is_inside_as_a_whole(spark):
    df = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ '2024-01-31 23:59:59'), (TIMESTAMP_NTZ '2024-02-01 00:00:00') t(ts)")
    assert filters.in_period(df, "ts", *JANUARY).count() == 1


def test_single_day_and_inverted_period(spark):
    df = with_dates(sales(spark, ("P001", "2024-01-15", 1.0), ("P002", "2024-01-15", 1.0), ("P001", "2024-01-16", 1.0)))
    assert filters.on_day(df, "sale_date", "2024-01-15").count() == 2
    assert filters.in_period(df, "sale_date", "2024-12-31", "2024-01-01").count() == 0


def test_bound_that_is_no_date_raises(spark):
    df = with_dates(sales(spark, *BOUNDARIES))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        filters.in_period(df, "sale_date", "invalid-date", "2024-01-31").collect()


def test_with_value(spark):
    df = spark.createDataFrame([("P001", 250.0), ("P002", None), ("P003", 300.0)], "product_id string, total_sales double")
    assert filters.with_value(df, "total_sales").count() == 2


@pytest.mark.parametrize(
    ("data", "kept"),
    [
        ([("a", 1.0), ("b", None), ("c", 3.0)], {"a"}),
        ([("a", 1.0), ("b", 2.0)], {"a", "b"}),
        ([("a", None), ("b", 2.0)], set()),
        ([(None, 1.0), ("a", 2.0), ("b", None), ("c", 4.0)], {None, "a"}),
        ([(None, None), ("a", 2.0)], set()),
        ([], set()),
    ],
)
def test_before_first_null(spark, data, kept):
    df = spark.createDataFrame(data, "k string, v double").repartition(3)
    assert {r.k for r in filters.before_first_null(df, "k", "v").collect()} == kept


# Rows and expected totals of the documented cases.
SCENARIOS = {
    "several products": (
        [("P003", 300.0), ("P001", 100.0), ("P002", 200.0), ("P001", 150.0), ("P003", 250.0)],
        [("P001", 250.0), ("P002", 200.0), ("P003", 550.0)],
    ),
    "null sales": ([("P001", 100.0), ("P002", None), ("P001", 150.0)], [("P001", 250.0), ("P002", None)]),
    "copies are added": ([("P001", 100.0), ("P001", 100.0), ("P001", 150.0)], [("P001", 350.0)]),
    "null ids are one group": ([(None, 1.0), ("P001", 2.0), (None, 3.0)], [("P001", 2.0), (None, 4.0)]),
    "nothing": ([], []),
}


@pytest.mark.parametrize("name", SCENARIOS)
@pytest.mark.parametrize("scale", [None, 2])
def test_total_by(spark, name, scale):
    data, expected = SCENARIOS[name]
    df = spark.createDataFrame(data, "product_id string, sales double").repartition(3)
    assert rows(aggregates.total_by(df, ["product_id"], "sales", scale=scale)) == sorted(expected, key=repr)


def test_totals_of_float_are_double(spark):
    df = spark.createDataFrame([("a", 0.1), ("a", 0.2)], "product_id string, sales float")
    total = aggregates.total_by(df, ["product_id"], "sales")
    assert total.schema["total_sales"].dataType.simpleString() == "double"
    assert math.isclose(total.first().total_sales, 0.3, abs_tol=1e-6)


def test_precision(spark):
    # The documented rows of many digits.
    df = spark.createDataFrame(
        [("P001", 100.123456789), ("P001", 200.987654321), ("P002", 0.000000001)], "product_id string, sales double"
    )
    totals = dict(rows(aggregates.total_by(df, ["product_id"], "sales", scale=9)))
    assert math.isclose(totals["P001"], 301.11111111, abs_tol=1e-4)
    assert totals["P002"] > 0


def test_sum_of_parts_is_the_sum_of_the_whole(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), (F.col("id") % 10).alias("part"), F.col("id").alias("v"))
    parts = aggregates.total_by(df, ["k", "part"], "v")
    assert rows(aggregates.combine_totals(parts, ["k"])) == rows(aggregates.total_by(df, ["k"], "v"))


def test_counts(spark):
    df = spark.createDataFrame([("eu", 1.0), ("eu", None), ("na", 3.0)], "region string, v double")
    assert rows(aggregates.count_and_total_by(df, ["region"], "v")) == [("eu", 2, 1.0), ("na", 1, 3.0)]
    assert rows(aggregates.count_by(df, ["region"], "v", name="n")) == [("eu", 1), ("na", 1)]
    twice = df.union(df)
    assert rows(aggregates.count_by(twice.filter("region = 'na'").union(df), ["region"], "v", name="n", more_than=1)) == [("na", 3)]


def test_period_statistics_counts_a_null_id_once(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), (None, 3.0), (None, None)], "k string, v double")
    assert rows(aggregates.period_statistics(df, "k", "v")) == [(4, 2, 6.0)]
    assert df.select("k").distinct().count() == 2


def test_period_statistics_of_nothing(spark):
    df = spark.createDataFrame([], "k string, v double")
    assert rows(aggregates.period_statistics(df, "k", "v")) == [(0, 0, None)]


def test_summary_statistics(spark):
    df = spark.createDataFrame([("P001", 100.0), ("P002", 200.0), ("P003", 300.0)], "product_id string, total_sales double")
    assert rows(aggregates.summary_statistics(df)) == [(600.0, 300.0, 100.0, 200.0, 3)]


def test_summary_statistics_counts_products_without_a_total(spark):
    df = spark.createDataFrame([("P001", 100.0), ("P002", None)], "product_id string, total_sales double")
    assert rows(aggregates.summary_statistics(df)) == [(100.0, 100.0, 100.0, 100.0, 2)]


@pytest.mark.parametrize("data", [[], [("P001", None)]])
def test_summary_statistics_of_nothing(spark, data):
    df = spark.createDataFrame(data, "product_id string, total_sales double")
    assert aggregates.summary_statistics(df).count() == 0


def test_distinct_and_order(spark):
    df = spark.createDataFrame([("P003",), ("P001",), ("P002",), ("P001",)], "product_id string")
    shown = aggregates.ordered(aggregates.distinct_values(df, "product_id"), "product_id")
    assert [r[0] for r in shown.collect()] == ["P001", "P002", "P003"]
