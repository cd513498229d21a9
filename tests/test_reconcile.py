from __future__ import annotations

import random
from collections import Counter

import pytest
from conftest import physical_plan, rows
from pyspark.sql import functions as F

from tallymark.operators import reconcile as rec
from tallymark.operators.quality import MissingColumns

KV = "k int, v double"


def frame(spark, *data, schema=KV):
    return spark.createDataFrame(list(data), schema)


def test_row_counts(spark):
    left, right = frame(spark, (1, 1.0), (2, 2.0)), frame(spark, (1, 1.0))
    assert rows(rec.row_counts(left, right)) == [(2, 1, 1, False)]
    assert rows(rec.row_counts(left, left)) == [(2, 2, 0, True)]
    assert rows(rec.row_counts(left.limit(0), left.limit(0))) == [(0, 0, 0, True)]


def test_aggregate_diff(spark):
    left = frame(spark, (1, 1.0), (1, 2.0), (2, 5.0), (3, 1.0), (5, None), (None, 7.0))
    right = frame(spark, (1, 3.005), (2, 5.5), (4, 1.0), (5, None), (None, 7.0))
    found = {r.k: (r.left_total, r.right_total, r.status) for r in rec.aggregate_diff(left, right, ["k"], "v", tolerance=0.01).collect()}
    assert found == {
        1: (3.0, 3.005, "match"),
        2: (5.0, 5.5, "mismatch"),
        3: (1.0, None, "only_left"),
        4: (None, 1.0, "only_right"),
        5: (None, None, "match"),
        None: (7.0, 7.0, "match"),
    }


def test_aggregate_diff_of_a_null_against_a_total(spark):
    found = rec.aggregate_diff(frame(spark, (1, None)), frame(spark, (1, 0.0)), ["k"], "v")
    assert found.first().status == "mismatch"


WIDE = "k int, name string, v double, n int"
LEFT = [(1, "a", 1.0, 1), (2, "b", 2.0, 2), (3, None, 3.0, None), (4, "d", 4.0, 4), (None, "n", 0.0, 0), (7, "x", 1.0, 1), (7, "y", 1.0, 1)]
RIGHT = [(1, "a", 1.0, 1), (2, "B", 2.004, 2), (3, None, None, 3), (5, "e", 5.0, 5), (None, "n", 0.0, 0), (7, "x", 1.0, 1)]
STATUS = {
    1: ("same", []),
    2: ("changed", ["name", "v"]),
    3: ("changed", ["v", "n"]),
    4: ("only_left", None),
    5: ("only_right", None),
    None: ("same", []),
    7: ("repeated", None),
}


def test_keyed_diff(spark):
    left, right = frame(spark, *LEFT, schema=WIDE), frame(spark, *RIGHT, schema=WIDE)
    found = {r.k: (r.status, r.changed_columns) for r in rec.keyed_diff(left, right, ["k"]).collect()}
    assert found == STATUS


def test_keyed_diff_with_tolerance(spark):
    left, right = frame(spark, *LEFT, schema=WIDE), frame(spark, *RIGHT, schema=WIDE)
    for tolerance in (0.01, {"v": 0.01}):
        found = {r.k: r.changed_columns for r in rec.keyed_diff(left, right, ["k"], tolerance=tolerance).collect()}
        assert found[2] == ["name"] and found[3] == ["v", "n"]


def test_keyed_diff_shows_values_of_single_rows(spark):
    left, right = frame(spark, *LEFT, schema=WIDE), frame(spark, *RIGHT, schema=WIDE)
    found = {r.k: r for r in rec.keyed_diff(left, right, ["k"], compare=["v"], with_values=True).collect()}
    assert (found[2].left_v, found[2].right_v) == (2.0, 2.004)
    assert (found[7].left_v, found[7].left_rows, found[7].right_rows) == (None, 2, 1)


def test_keyed_diff_by_keys_alone(spark):
    left, right = frame(spark, (1, 1.0), (2, 1.0)), frame(spark, (2, 9.0))
    found = {r.k: r.status for r in rec.keyed_diff(left.select("k"), right.select("k"), ["k"]).collect()}
    assert found == {1: "only_left", 2: "same"}


@pytest.mark.parametrize("tolerance", [0.0, 0.01])
@pytest.mark.parametrize("only_differences", [True, False])
@pytest.mark.parametrize("with_values", [True, False])
def test_hashes_and_values_find_the_same(spark, tolerance, only_differences, with_values):
    left, right = frame(spark, *LEFT, schema=WIDE), frame(spark, *RIGHT, schema=WIDE)
    options = {"tolerance": tolerance, "only_differences": only_differences}
    by_value, by_hash = (
        rec.keyed_diff(left, right, ["k"], with_values=with_values, by_hash=h, **options) for h in (False, True)
    )
    assert by_value.columns == by_hash.columns
    assert rows(by_hash) == rows(by_value)


def test_sides_of_different_types(spark):
    left = spark.createDataFrame([(1, 1, 1.5), (2, 2, 2.5)], "k int, n int, v double")
    right = spark.createDataFrame([(1, 1, "1.5"), (2, 3, "n/a")], "k bigint, n bigint, v string")
    for by_hash in (None, False, True):
        found = rec.keyed_diff(left, right, ["k"], by_hash=by_hash, tolerance=0.1)
        assert {r.k: r.changed_columns for r in found.collect()} == {1: [], 2: ["n", "v"]}
    found = {(r.check_name, r.item): r.status for r in rec.report(left, right, ["k"]).collect()}
    assert found["schema", None] == "fail" and found["row_count", None] == "pass"
    assert rec.bag_diff(left, right).count() == 2


def test_missing_key_stops_the_comparison(spark):
    left = frame(spark, (1, 1.0))
    for compare in (rec.keyed_diff, rec.report):
        with pytest.raises(MissingColumns, match="k"):
            compare(left, left.withColumnRenamed("k", "key"), ["k"])


def test_two_keys(spark):
    schema = "a int, b string, v int"
    left = frame(spark, (1, None, 1), (1, "x", 1), (None, "x", 1), schema=schema)
    right = frame(spark, (1, None, 2), (1, "x", 1), (None, "x", 1), schema=schema)
    for by_hash in (False, True):
        found = rec.keyed_diff(left, right, ["a", "b"], by_hash=by_hash, only_differences=True)
        assert rows(found.select("a", "b", "status")) == [(1, None, "changed")]


def test_beyond_the_broadcast_bound(spark, monkeypatch):
    from tallymark.operators import joins

    left, right = frame(spark, *LEFT, schema=WIDE), frame(spark, *RIGHT, schema=WIDE)
    expected = rows(rec.keyed_diff(left, right, ["k"], by_hash=True))
    monkeypatch.setattr(joins.broadcast_within, "__defaults__", (-1, -1))
    assert rows(rec.keyed_diff(left, right, ["k"], by_hash=True)) == expected


def test_what_travels_follows_from_the_columns(spark):
    numbers, texts = frame(spark, (1, 1.0)), frame(spark, (1, "a"), schema="k int, v string")
    assert "hash" not in physical_plan(rec.keyed_diff(numbers, numbers, ["k"])).replace("hashpartitioning", "")
    assert "ExistingRDD" in physical_plan(rec.keyed_diff(texts, texts, ["k"]))


def edited(dice, n):
    """Rows, a version with known edits, and what a comparison must find."""
    left = {k: (f"name{k}", round(dice.uniform(0, 100), 2)) for k in range(n)}
    right, expected = dict(left), {}
    for k in dice.sample(range(n), 30):
        kind = dice.choice(["changed", "only_left"])
        expected[k] = kind
        if kind == "changed":
            right[k] = (left[k][0], left[k][1] + 1)
        else:
            del right[k]
    for k in range(n, n + 10):
        right[k], expected[k] = ("new", 0.0), "only_right"
    return left, right, expected


@pytest.mark.parametrize("seed", [1, 2])
def test_random_edits_are_found_exactly(spark, seed):
    left, right, expected = edited(random.Random(seed), 500)
    frames = [
        spark.createDataFrame([(k, *v) for k, v in side.items()], "k int, name string, v double").repartition(5)
        for side in (left, right)
    ]
    for by_hash in (False, True):
        found = rec.keyed_diff(*frames, ["k"], by_hash=by_hash, only_differences=True)
        assert {r.k: r.status for r in found.collect()} == expected
    count = Counter(expected.values())
    surplus = [r.surplus for r in rec.bag_diff(*frames).collect()]
    assert surplus.count(1) == count["changed"] + count["only_left"]
    assert surplus.count(-1) == count["changed"] + count["only_right"]
    assert rec.row_counts(*frames).first()["diff"] == len(left) - len(right)


def test_comparison_is_one_shuffle_without_a_join(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    left, right = (spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * n).alias("v")) for n in (1, 2))
    for result in (rec.keyed_diff(left, right, ["k"]), rec.aggregate_diff(left, right, ["k"], "v"), rec.bag_diff(left, right)):
        plan = physical_plan(result)
        assert plan.count("Exchange") == 1 and "Join" not in plan


def test_a_key_with_a_third_of_the_rows_is_one_row_per_task_in_the_shuffle(spark):
    left = spark.range(0, 90000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.lit("text").alias("v")
    )
    found = {r.k: r for r in rec.keyed_diff(left, left, ["k"]).filter("status <> 'same'").collect()}
    assert list(found) == [-1]
    assert (found[-1].status, found[-1].left_rows, found[-1].right_rows) == ("repeated", 30000, 30000)


def test_bags(spark):
    left = frame(spark, (1, 1.0), (1, 1.0), (2, None), (None, None))
    right = frame(spark, (1, 1.0), (3, 1.0), (None, None))
    assert rows(rec.bag_diff(left, right)) == sorted([(1, 1.0, 1), (2, None, 1), (3, 1.0, -1)], key=repr)
    assert rows(rec.bag_difference(left, right)) == sorted([(1, 1.0), (2, None)], key=repr)
    assert rows(rec.bag_difference(right, left)) == [(3, 1.0)]


@pytest.mark.parametrize("per_task", [1, 3, 100_000])
def test_bag_difference_is_except_all(spark, monkeypatch, per_task):
    monkeypatch.setattr(rec, "COPIES_PER_TASK", per_task)
    dice = random.Random(per_task)
    sides = [[(dice.choice([1, 2, None]), dice.choice([0.5, None])) for _ in range(n)] for n in (60, 20)]
    left, right = (frame(spark, *side).repartition(3) for side in sides)
    expected = sorted((Counter(sides[0]) - Counter(sides[1])).elements(), key=repr)
    assert rows(rec.bag_difference(left, right)) == expected == rows(left.exceptAll(right))


def test_copies_of_a_hot_row_are_dealt_to_several_tasks(spark, monkeypatch, conf):
    monkeypatch.setattr(rec, "COPIES_PER_TASK", 1000)
    conf(spark__sql__adaptive__coalescePartitions__enabled="false", spark__sql__shuffle__partitions="8")
    left = spark.range(20000).select((F.col("id") * 0).alias("k"))
    remaining = rec.bag_difference(left, left.limit(500))
    per_task = remaining.groupBy(F.spark_partition_id()).count()
    assert remaining.count() == 19500
    assert per_task.count() > 3 and per_task.agg(F.max("count")).first()[0] < 10000


def test_schema_diff(spark):
    left = spark.createDataFrame([], "a int, b string, c double")
    right = spark.createDataFrame([], "b string, c decimal(10,2), d date")
    assert {r.column_name: r.status for r in rec.schema_diff(left, right).collect()} == {
        "a": "only_left",
        "b": "same",
        "c": "type_changed",
        "d": "only_right",
    }
    strict = spark.createDataFrame([], "a int not null")
    assert rec.schema_diff(left.select("a"), strict).first().status == "nullability_changed"


def test_boundary_counts(spark):
    days = ["2023-01-01", "2023-12-31", "2022-12-31", "2024-01-01", "2023-06-01", None]
    df = spark.createDataFrame([(d,) for d in days], "d string")
    assert rows(rec.boundary_counts(df, "d", "2023-01-01", "2023-12-31")) == [(1, 1, 3, 1, 1)]


def test_null_diff(spark):
    left, right = frame(spark, (1, None), (None, None)), frame(spark, (1, 1.0), (None, None))
    assert rows(rec.null_diff(left, right, ["k", "v"])) == [("k", 1, 1, "match"), ("v", 2, 1, "mismatch")]


def test_completeness(spark):
    df = frame(spark, (1, 10.0), (2, 20.0), (3, None), (None, 5.0))
    rules = {"large": F.col("k") > 1, "no_key": F.col("k").isNull()}
    found = rec.completeness(df, F.col("k") <= 1, rules, amount="v").first()
    assert (found.rows_in, found.rows_kept, found.rows_large, found.rows_no_key) == (4, 1, 2, 1)
    assert (float(found.amount_in), float(found.amount_large)) == (35.0, 20.0)
    assert found.balanced


def test_completeness_notices_gaps_and_overlaps(spark):
    df = frame(spark, (1, 10.0), (2, 20.0), (3, 30.0))
    gap = rec.completeness(df, F.col("k") == 1, {"two": F.col("k") == 2})
    assert not gap.first().balanced
    both = rec.completeness(df, F.col("k") == 1, {"one_again": F.col("k") == 1, "two": F.col("k") == 2})
    assert both.first().rows_in == 3 and not both.first().balanced


def test_fingerprint_and_repeatability(spark):
    left = spark.range(1000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("v"))
    again = left.repartition(7).orderBy(F.desc("k"))
    assert rows(rec.fingerprint(left)) == rows(rec.fingerprint(again))
    assert rows(rec.repeatability(left, again)) == [(1000, 1000, True)]
    other = left.withColumn("v", F.when(F.col("k") == 500, F.lit(None)).otherwise(F.col("v")))
    assert rec.repeatability(left, other).first().identical is (left.filter("k = 500").first().v is None)
    assert rows(rec.repeatability(left, left.union(left.limit(1)))) == [(1000, 1001, False)]
    assert rows(rec.repeatability(left.limit(0), left.limit(0))) == [(0, 0, True)]


def test_report(spark):
    left = frame(spark, (1, 1.0), (2, 2.0), (3, None))
    right = frame(spark, (1, 1.0), (2, 2.5), (4, 1.0), (4, 1.0))
    found = {(r.check_name, r.item): (r.left_value, r.right_value, r.status) for r in rec.report(left, right, ["k"], value="v").collect()}
    assert found == {
        ("schema", None): ("2", "2", "pass"),
        ("row_count", None): ("3", "4", "fail"),
        ("null_count", "k"): ("0", "0", "pass"),
        ("null_count", "v"): ("1", "0", "fail"),
        ("total", "v"): ("3.0", "5.5", "fail"),
        ("repeated_keys", None): ("0", "1", "fail"),
        ("differing_rows", None): ("2", "1", "fail"),
    }
    assert {r.status for r in rec.report(left, left, ["k"], value="v").collect()} == {"pass"}


def test_pair_with_known_differences(spark):
    """The documented pair at sf0.01: 15,000 against 14,881 rows, 332 differing keys."""
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    left = orders.select(key.alias("k"), price.alias("v"))
    kept = orders.filter(key % 101 != 0).select(key.alias("k"), F.when(key % 97 == 0, price + 1).otherwise(price).alias("v"))
    right = kept.unionByName(orders.filter(key % 500 == 0).select((-key - 1).alias("k"), price.alias("v")))
    assert rows(rec.row_counts(left, right)) == [(15000, 14881, 119, False)]
    assert rec.keyed_diff(left, right, ["k"]).filter("status <> 'same'").count() == 332
