from __future__ import annotations

import datetime
import random

import pytest
from conftest import physical_plan, rows
from pyspark.sql import functions as F

from tallymark.functions.numbers import exact_sum
from tallymark.operators import joins
from tallymark.plans.sales import periods_frame


def test_inner_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id int, l string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "id int, r string")
    assert rows(joins.inner_join(left, right, "id")) == [(1, "a", "x"), (1, "a", "y")]


def test_broadcast_only_what_is_proven_small(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    facts = spark.range(1000).withColumn("k", F.col("id") % 10)
    lookup = spark.range(10).select(F.col("id").alias("k"), F.lit("x" * 100).alias("name"))
    assert joins.fits_broadcast(lookup)
    assert not joins.fits_broadcast(lookup, max_rows=9)
    assert not joins.fits_broadcast(lookup, max_bytes=1000)
    small, large = (joins.lookup_join(facts, lookup, "k", max_rows=n) for n in (10, 9))
    assert "BroadcastHashJoin" in physical_plan(small)
    assert "BroadcastHashJoin" not in physical_plan(large)
    assert rows(small) == rows(large)


def test_nested_columns_are_measured(spark):
    df = spark.createDataFrame([(["x" * 500],)], "a array<string>")
    assert joins.fits_broadcast(df, max_bytes=1000)
    assert not joins.fits_broadcast(df, max_bytes=400)


def test_full_outer_null_safe(spark):
    left = spark.createDataFrame([(1, 10), (2, 20), (None, 30)], "k int, v int")
    right = spark.createDataFrame([(2, 21), (3, 31), (None, 41)], "k int, v int")
    assert rows(joins.full_outer_null_safe(left, right, ["k"])) == sorted(
        [
            (1, 10, None, True, False),
            (2, 20, 21, True, True),
            (3, None, 31, False, True),
            (None, 30, 41, True, True),
        ],
        key=repr,
    )


def test_null_safe_join_is_an_equi_join(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    left, right = (spark.range(n).withColumnRenamed("id", "k") for n in (100, 90))
    plan = physical_plan(joins.full_outer_null_safe(left, right, ["k"]))
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_orphans(spark):
    child = spark.createDataFrame([(1, 1), (2, 9), (3, None), (4, 9)], "id int, parent int")
    parent = spark.createDataFrame([(1,), (2,), (None,)], "key int")
    assert rows(joins.orphans(child, parent, "parent", "key")) == [(2, 9), (4, 9)]


def test_few_distinct_parents_are_broadcast(spark):
    child = spark.range(1000).select((F.col("id") % 50).alias("k"))
    parent = spark.range(1000).select((F.col("id") % 40).alias("p"))
    found = joins.orphans(child, parent, "k", "p")
    assert "BroadcastHashJoin" in physical_plan(found)
    assert {r.k for r in found.collect()} == set(range(40, 50))


def test_days_of_periods(spark):
    periods = periods_frame(spark, [(1, "2024-01-30", "2024-02-01"), (2, "2024-03-02", "2024-03-01")])
    assert [str(r.day) for r in joins.days_of_periods(periods).orderBy("day").collect()] == [
        "2024-01-30",
        "2024-01-31",
        "2024-02-01",
    ]


def brute_force(sales, periods):
    totals = {}
    for range_id, start, end in periods:
        for key, day, amount in sales:
            if day is not None and start <= day <= end:
                old = totals.get((range_id, key))
                totals[range_id, key] = old if amount is None else (old or 0) + amount
    return sorted(((i, k, None if v is None else round(v, 2)) for (i, k), v in totals.items()), key=repr)


PERIODS = {
    "overlapping": [(1, "2024-01-01", "2024-01-20"), (2, "2024-01-10", "2024-02-10"), (3, "2024-01-05", "2024-01-05")],
    "same days twice": [(1, "2024-01-01", "2024-01-20"), (2, "2024-01-01", "2024-01-20")],
    "with a gap": [(1, "2024-01-01", "2024-01-03"), (2, "2024-02-20", "2024-02-25")],
    "inverted": [(1, "2024-01-20", "2024-01-01"), (2, "2024-01-02", "2024-01-04")],
    "one id in two parts": [(1, "2024-01-01", "2024-01-10"), (1, "2024-02-01", "2024-02-10")],
    "none": [],
}


@pytest.mark.parametrize("name", PERIODS)
@pytest.mark.parametrize("broadcast", [True, False])
def test_totals_per_period(spark, monkeypatch, name, broadcast):
    if not broadcast:
        monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", -1)
    dice = random.Random(7)
    sales = [
        (
            dice.choice(["a", "b", None]),
            dice.choice([None, f"2024-01-{dice.randint(1, 31):02d}", f"2024-02-{dice.randint(1, 29):02d}"]),
            dice.choice([None, round(dice.uniform(1, 100), 2)]),
        )
        for _ in range(300)
    ]
    df = spark.createDataFrame(sales, "k string, d string, v double").withColumn("d", F.col("d").cast("date"))
    periods = periods_frame(spark, PERIODS[name])
    found = joins.totals_per_period(df, periods, keys=["k"], value="v", date="d", scale=2)
    got = sorted(((r.range_id, r.k, None if r.total_sales is None else round(r.total_sales, 2)) for r in found.collect()), key=repr)
    assert got == brute_force(sales, PERIODS[name])
    assert "NestedLoop" not in physical_plan(found) and "Cartesian" not in physical_plan(found)


@pytest.mark.parametrize("periods", [[(1, "1969-12-20", "1970-01-09")], [(1, "0001-01-01", "9999-12-31"), (2, "2024-02-29", "2024-02-29")]])
def test_intervals_cover_each_day_of_a_period_once(spark, periods):
    cover = joins.cover_of_periods(periods_frame(spark, periods)).collect()
    for i, start, end in periods:
        first, last = (datetime.date.fromisoformat(d).toordinal() - datetime.date(1970, 1, 1).toordinal() for d in (start, end))
        spans = sorted((r.node << r.level, (r.node + 1) << r.level) for r in cover if r.range_id == i)
        assert spans[0][0] == first and spans[-1][1] == last + 1
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        assert len(spans) <= 2 * (last - first + 1).bit_length()


ODD = [0.5, float("nan"), float("inf"), -float("inf"), 1e17, 2e17, 1e20, None, 3.25]


@pytest.mark.parametrize("scale", [None, 2])
def test_odd_values_give_the_totals_of_a_plain_sum(spark, scale):
    rows_ = [(k, f"2024-01-{1 + (i * 7 + k) % 28:02d}", v) for k in range(6) for i, v in enumerate(ODD[k:] + ODD[:k])]
    df = spark.createDataFrame(rows_, "k int, d string, v double").withColumn("d", F.col("d").cast("date"))
    periods = [(i, f"2024-01-{i:02d}", f"2024-01-{min(28, i + i % 9):02d}") for i in range(1, 29)]
    found = joins.totals_per_period(df, periods_frame(spark, periods), keys=["k"], value="v", date="d", scale=scale)
    want = {}
    for i, start, end in periods:
        inside = df.where(F.col("d").between(start, end))
        total = F.sum("v") if scale is None else exact_sum(F.col("v"), scale)
        want |= {(i, r.k): r.t for r in inside.groupBy("k").agg(total.alias("t")).collect()}
    got = {(r.range_id, r.k): r.total_sales for r in found.collect()}
    assert got.keys() == want.keys()
    assert all(repr(got[x]) == repr(want[x]) or got[x] == pytest.approx(want[x], rel=1e-12) for x in want)


def test_sparse_keys_make_no_row_for_each_period(spark):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 300).cast("int"))
    df = spark.range(2000).select("id", day.alias("d"), F.lit(1.5).alias("v"))
    days = [datetime.date(2024, 1, 1) + datetime.timedelta(i) for i in range(300)]
    periods = periods_frame(spark, [(i, d, d) for i, d in enumerate(days)])
    found = joins.totals_per_period(df, periods, keys=["id"], value="v", date="d", scale=2)
    assert found.count() == 2000


def test_hot_key_of_a_join_is_split(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="16",
    )
    orders = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("customer_id"), F.col("id").alias("order_id")
    )
    customers = spark.range(0, 60000, 1, 4).select(F.col("id").alias("customer_id"), F.lit("n").alias("name"))
    joined = joins.inner_join(orders, customers, "customer_id")
    assert len(joined.collect()) == 60000
    assert "skew=true" in physical_plan(joined)


@pytest.mark.parametrize("how", ["anti", "semi"])
def test_hot_key_of_a_child_is_split(spark, conf, monkeypatch, how):
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", 0)
    monkeypatch.setattr(joins.checkpointed_lookup, "__defaults__", (0, 0))
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="16",
    )
    child = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("row")
    )
    parent = spark.range(2, 60000, 1, 4).select(F.col("id").alias("p"))
    if how == "anti":
        found = joins.orphans(child, parent, "k", "p")
        assert found.count() == 20001
    else:
        keys = joins.checkpointed_lookup(parent.distinct())
        found = child.join(keys, F.col("k") == F.col("p"), "left_semi")
    found.collect()
    assert "skew=true" in physical_plan(found)
