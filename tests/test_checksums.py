"""Comparison by a tree of checksums against the plain comparison, and maps compared by value."""

from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallymark.operators import checksums
from tallymark.operators import reconcile as rec

WIDE = "k int, part string, v double, a array<int>, m map<string,array<double>>, s struct<x: int, m: map<int,string>>"


def wide(n, seed):
    rng = random.Random(seed)
    pick = lambda *values: rng.choice([None, *values])
    entries = [("a", [1.0, None]), ("b", None), ("c", [])]

    def one(k):
        rng.shuffle(entries)
        return (
            pick(k, k % 50), pick("x", "y"), pick(0.5, float("nan")), pick([1, None], [None, 1], []),
            pick(dict(entries), dict(entries[:2])), pick((1, {1: "a", 2: None}), (None, {2: None, 1: "a"}), (1, None)),
        )

    return [one(k) for k in range(n)]


def changed(found):
    return rows(found.select("k", "part", "status"))


@pytest.mark.parametrize("options", [{}, {"bits_per_level": 3, "few_rows": 10}, {"few_rows": 0}])
def test_tree_finds_what_the_plain_comparison_finds(spark, options):
    left = wide(300, 1)
    right = [(*r[:2], 9.5, *r[3:]) if i % 60 == 7 else r for i, r in enumerate(left) if i % 90 != 11] + wide(3, 5)
    a, b = (spark.createDataFrame(r, WIDE).repartition(3) for r in (left, right))
    keys = ["k", "part"]
    plain = rec.keyed_diff(a, b, keys, only_differences=True, by_hash=True)
    tree = checksums.tree_diff(a, b, keys, **options)
    assert tree.columns == plain.columns
    # keys with several, but equal, rows are no difference to the tree
    equal = rows(rec.bag_diff(a, b).select(*keys).distinct())
    assert changed(tree) == [r for r in changed(plain) if r[:2] in equal]
    assert checksums.tree_diff(a, a.repartition(2), keys, **options).count() == 0


def test_one_changed_row_moves_one_range(spark, monkeypatch):
    left = spark.range(40_000).select(F.col("id").alias("k"), (F.col("id") * 1.5).alias("v"))
    right = left.withColumn("v", F.when(F.col("k") == 777, 0.25).otherwise(F.col("v")))
    seen = []
    plain = checksums.keyed_diff
    monkeypatch.setattr(checksums, "keyed_diff", lambda a, b, *x, **y: seen.extend([a.count(), b.count()]) or plain(a, b, *x, **y))
    ranges, bits = checksums._differing_ranges(left, right, ["k"], ["k", "v"], 12, 100)
    assert bits == 12 and ranges.count() == 1
    assert checksums.rows_in_ranges(left, ["k"], ranges, bits).count() < 40
    found = checksums.tree_diff(left, right, ["k"], with_values=True).collect()
    assert [(r.k, r.status, r.left_v, r.right_v) for r in found] == [(777, "changed", 1165.5, 0.25)]
    assert seen == [1, 1]
    assert checksums.tree_diff(left, right, ["k"], tolerance=2000).count() == 0


def test_kept_checksums_tell_what_changed_since(spark):
    before = spark.range(5000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    kept = checksums.range_checksums(before, ["k"], bits=8)
    assert kept.count() == 256 and kept.agg(F.sum("n_rows")).first()[0] == 5000
    after = before.where("k != 12").union(spark.createDataFrame([(None, "new"), (-5, None)], "k long, v string"))
    ranges = checksums.changed_ranges(kept, checksums.range_checksums(after, ["k"], bits=8))
    assert 1 <= ranges.count() <= 3 and ranges.agg(F.sum(F.col("rows_after") - F.col("rows_before"))).first()[0] == 1
    inside = checksums.rows_in_ranges(after, ["k"], ranges, 8)
    assert {r.k for r in inside.where("v is null or v = 'new'").collect()} == {None, -5} and inside.count() < 100
    assert checksums.changed_ranges(kept, checksums.range_checksums(before.repartition(3), ["k"], bits=8)).count() == 0


def test_tables_without_rows(spark):
    none = spark.createDataFrame([], "k int, v string")
    one = spark.createDataFrame([(1, None)], "k int, v string")
    assert checksums.tree_diff(none, none, ["k"]).count() == 0
    assert [r.status for r in checksums.tree_diff(none, one, ["k"]).collect()] == ["only_right"]


# --- maps -----------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("by_hash", [True, False])
def test_maps_are_compared_by_value(spark, by_hash):
    schema = "k int, m map<string,map<int,double>>, s array<struct<m: map<string,int>>>"
    left = [
        (1, {"a": {1: 1.0, 2: None}, "b": None}, [({"x": 1, "y": 2},), None]),
        (2, {"a": {1: 1.0}}, None),
        (3, None, []),
        (4, {}, []),
        (5, {"a": None}, [(None,)]),
    ]
    right = [
        (1, {"b": None, "a": {2: None, 1: 1.0}}, [({"y": 2, "x": 1},), None]),
        (2, {"a": {1: 2.0}}, None),
        (3, {}, []),
        (4, {}, [({},)]),
        (5, {}, [(None,)]),
    ]
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    found = {r.k: (r.status, r.changed_columns) for r in rec.keyed_diff(a, b, ["k"], by_hash=by_hash).collect()}
    assert found == {
        1: ("same", []),
        2: ("changed", ["m"]),
        3: ("changed", ["m"]),
        4: ("changed", ["s"]),
        5: ("changed", ["m"]),
    }
    shown = rec.keyed_diff(a, b, ["k"], by_hash=by_hash, with_values=True).where("k = 2").first()
    assert shown.left_m == {"a": {1: 1.0}} and shown.right_m == {"a": {1: 2.0}}
    surplus = rec.bag_diff(a, b).collect()
    assert sorted((r.k, r.surplus) for r in surplus) == sorted((k, n) for k in (2, 3, 4, 5) for n in (1, -1))
    assert sorted(r.k for r in rec.bag_difference(a, b).collect()) == [2, 3, 4, 5]
    lines = {r.check_name: r.status for r in rec.report(a, b, ["k"]).collect()}
    assert lines["differing_rows"] == "fail" and lines["repeated_keys"] == "pass"
    assert {r.status for r in rec.report(a, a, ["k"]).collect()} == {"pass"}
