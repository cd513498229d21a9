from __future__ import annotations

import random
import statistics

import pytest
from conftest import physical_plan, rows
from pyspark.sql import functions as F

from tallymark.operators import quality
from tallymark.operators.audit import AuditTrail, counted
from tallymark.sources import checkpointed


def test_required_columns(spark):
    df = spark.createDataFrame([], "product_id string, sale_date string")
    assert quality.require_columns(df, "product_id") is df
    with pytest.raises(quality.MissingColumns, match="sales"):
        quality.require_columns(df, "product_id", "sales")


def test_null_profile(spark):
    df = spark.createDataFrame([("a", None), (None, None), ("b", 1)], "s string, n int")
    assert rows(quality.null_profile(df)) == [("n", 3, 2), ("s", 3, 1)]


def test_column_profile(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (None,)], "v double")
    assert rows(quality.column_profile(df, "v")) == [(3, 2, 1.0, 2.0, 1.6667)]
    assert quality.column_profile(df, "v", exact=False).first().n_distinct == 2
    assert rows(quality.column_profile(df.limit(0), "v")) == [(0, 0, None, None, None)]


def test_table_profile(spark):
    df = spark.createDataFrame([(1, "b"), (3, "a"), (None, "a")], "n int, s string")
    assert rows(quality.table_profile(df)) == [("n", 3, 1, 2, "1", "3", 2.0), ("s", 3, 0, 2, "a", "b", None)]


def test_exact_table_profile_counts_each_column_by_itself(spark):
    values = [(1, "b", 0.0), (3, "a", -0.0), (None, "a", float("nan")), (3, None, float("nan")), (1, "b", None)]
    df = spark.createDataFrame(values, "n int, s string, v double")
    found = quality.table_profile(df, exact=True)
    assert {r.column_name: (r.n_rows, r.n_nulls, r.n_distinct) for r in found.collect()} == {
        "n": (5, 1, 2), "s": (5, 1, 2), "v": (5, 1, 2)
    }
    none = quality.table_profile(df.limit(0), exact=True)
    assert rows(none) == [(c, 0, 0, 0, None, None, None) for c in ("n", "s", "v")]
    # one pass for all columns would hold and sort a row per value, all columns wide
    plan = physical_plan(found)
    assert "gid" not in plan and "Sort [" not in plan


def test_duplicates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 1), (None, 1)], "k string, n int")
    assert rows(quality.duplicates(df, ["k", "n"], name="copies")) == sorted([("a", 1, 2), (None, 1, 2)], key=repr)


def test_align(spark):
    target = spark.createDataFrame([], "id bigint, name string, price double").schema
    older = spark.createDataFrame([(1, "a")], "id int, name string")
    newer = spark.createDataFrame([("x", 2, 1.5, "b")], "note string, ID int, price double, Name string")
    assert rows(quality.align(older, target)) == [(1, "a", None)]
    assert quality.align(newer, target).columns == ["id", "name", "price"]
    assert quality.align(newer, target, keep_extra=True).columns == ["id", "name", "price", "note"]
    union = quality.aligned_union(target, older, newer)
    assert rows(union) == [(1, "a", None), (2, "b", 1.5)]
    assert [f.dataType.simpleString() for f in union.schema] == ["bigint", "string", "double"]


def test_types(spark):
    df = spark.createDataFrame([(1, "1.5"), (2, "n/a"), (3, None), (4, "")], "id int, v string")
    good, bad = quality.split_by_type(df, "v")
    assert rows(good) == [(1, 1.5), (3, None)]
    assert rows(bad) == [(2, "n/a"), (4, "")]
    assert rows(quality.type_conformity(df, "v")) == [(4, 1, 3)]


def test_date_conformity(spark):
    dates = ["2023-01-01", "2023-12-31", "01-01-2023", "2023/01/01", "", None]
    df = spark.createDataFrame([(d,) for d in dates], "d string")
    assert rows(quality.date_conformity(df, "d")) == [(2, 4)]


@pytest.mark.parametrize("broadcast", [True, False])
def test_outliers(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(quality, "checkpointed_lookup", checkpointed)
    dice = random.Random(3)
    data = [(dice.choice(["a", "b", None]), round(dice.gauss(0, 1), 6)) for _ in range(400)]
    data += [("a", 50.0), (None, -50.0), ("single", 1.0), ("b", None)]
    found = quality.outliers(spark.createDataFrame(data, "g string, v double"), ["g"], "v", z=2.0)
    expected = []
    for g in ("a", "b", None):
        values = [v for k, v in data if k == g and v is not None]
        mean, deviation = statistics.mean(values), statistics.stdev(values)
        expected += [(g, v) for v in values if abs(v - mean) > 2 * deviation]
    assert rows(found) == sorted(expected, key=repr)


def test_text_encoding(spark):
    df = spark.createDataFrame([("en", "abc"), ("fr", "été"), ("fr", "ete"), ("ja", "日本")], "lang string, t string")
    assert rows(quality.text_encoding(df, "t", ["lang"])) == [("en", 1, 0, 0), ("fr", 2, 1, 0), ("ja", 1, 1, 0)]
    broken = spark.sql("SELECT CAST(X'FF41' AS STRING) AS t")
    assert quality.text_encoding(broken, "t").first().n_invalid == 1


SCRIPT = """CREATE TEMPORARY TABLE totals AS
SELECT id, SUM(v) AS v, COUNT(*) FROM facts
WHERE d BETWEEN 1 AND 2 GROUP BY id;
INSERT INTO summary SELECT t.id, t.v FROM totals t JOIN db.names n ON t.id = n.id
WHERE CASE WHEN t.v > 1 THEN TRUE END;
DROP TABLE totals;"""


def test_script_metrics(spark):
    df = spark.createDataFrame([(1, SCRIPT), (2, "no statements; selection, dropped")], "script_id int, text string")
    found = {r.script_id: r.asDict() for r in quality.script_metrics(df).collect()}
    assert found[1] == {
        "script_id": 1,
        "n_lines": 6,
        "n_select": 2,
        "n_insert": 1,
        "n_create": 1,
        "n_drop": 1,
        "n_join": 1,
        "n_temporary": 1,
        "n_aggregate": 2,
        "n_condition": 3,
        "n_tables": 4,
    }
    assert {v for k, v in found[2].items() if k not in ("script_id", "n_lines")} == {0}


def test_counting_needs_no_job_of_its_own(spark):
    df, seen = counted(spark.range(10), total=F.sum("id"))
    kept = df.filter("id > 3").collect()
    assert len(kept) == 6
    assert seen.get == {"n_rows": 10, "total": 45}


def test_audit_trail(spark, database):
    for run in ("first", "second"):
        trail = AuditTrail(spark, run)
        read = trail.step(spark.range(10), "read")
        trail.step(read.filter("id < 4"), "kept", total=F.sum("id")).collect()
        trail.save("audit")
    expected = [("kept", "n_rows", 4), ("kept", "total", 6), ("read", "n_rows", 10)]
    for run in ("first", "second"):
        found = spark.table("audit").filter(F.col("run_id") == run).select("step", "metric", F.col("value").cast("int"))
        assert rows(found) == expected
