from __future__ import annotations

import pytest
from conftest import physical_plan, rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tallymark import sources


def test_missing_table_raises_before_any_job(spark, database):
    with pytest.raises(AnalysisException, match="TABLE_OR_VIEW_NOT_FOUND"):
        sources.read_table(spark, "sales_table")


def test_delimited_files(spark, tmp_path):
    schema = "order_id int, order_date string, customer_id int, order_status string"
    df = spark.createDataFrame([(1, "2024-01-01", 7, "open"), (2, None, None, "a,b \"c\"")], schema)
    for separator in (",", "|"):
        path = str(tmp_path / f"orders{ord(separator)}")
        sources.write_delimited(df, path, separator)
        again = sources.read_delimited(spark, path, schema, separator)
        assert rows(again) == rows(df) and again.schema == df.schema


def test_delimited_table(spark, database):
    sources.create_delimited_table(spark, "orders", "order_id INT, order_status STRING")
    sources.append_by_name(spark.createDataFrame([("open", 1)], "order_status string, order_id int"), "orders")
    assert rows(sources.read_table(spark, "orders")) == [(1, "open")]


TARGET = "product_id string, total_sales double"


def test_append_matches_by_name_not_by_position(spark, database):
    sources.create_empty_table(spark, "summary_table", "a string, b string")
    for values in (("1", "2"), ("3", "4")):
        sources.append_by_name(spark.createDataFrame([values], "b string, a string"), "summary_table")
    assert rows(spark.table("summary_table")) == [("2", "1"), ("4", "3")]


@pytest.mark.parametrize("schema", ["product_id string", "product_id string, total_sales double, extra int"])
def test_append_refuses_other_columns(spark, database, schema):
    sources.create_empty_table(spark, "summary_table", TARGET)
    with pytest.raises(sources.UnsafeInsert, match="columns do not match"):
        sources.append_by_name(spark.createDataFrame([], schema), "summary_table")


@pytest.mark.parametrize(
    ("source", "target", "fits"),
    [
        ("float", "double", True),
        ("double", "float", False),
        ("int", "bigint", True),
        ("bigint", "int", False),
        ("int", "double", True),
        ("bigint", "double", False),
        ("int", "float", False),
        ("int", "decimal(12,2)", True),
        ("bigint", "decimal(12,2)", False),
        ("decimal(10,2)", "decimal(12,4)", True),
        ("decimal(10,2)", "decimal(10,4)", False),
        ("date", "timestamp", True),
        ("timestamp", "date", False),
        ("string", "date", False),
        ("array<int>", "array<int>", True),
    ],
)
def test_append_refuses_to_narrow(spark, database, source, target, fits):
    sources.create_empty_table(spark, "t", f"v {target}")
    df = spark.createDataFrame([(None,)], f"v {source}")
    if fits:
        sources.append_by_name(df, "t")
    else:
        with pytest.raises(sources.UnsafeInsert, match="narrow"):
            sources.append_by_name(df, "t")
        sources.append_by_name(df, "t", allow_narrowing=True)
    assert rows(spark.table("t")) == [(None,)]


def test_append_or_create(spark, database):
    df = spark.createDataFrame([("P001", 1.0)], TARGET)
    sources.append_or_create(df, "detail")
    sources.append_or_create(df.select("total_sales", "product_id"), "detail")
    assert rows(spark.table("detail")) == [("P001", 1.0)] * 2


def test_empty_table_replaces_rows(spark, database):
    sources.append_or_create(spark.createDataFrame([("P001", 1.0)], TARGET), "t")
    sources.create_empty_table(spark, "t", TARGET)
    assert spark.table("t").count() == 0 and spark.table("t").columns == ["product_id", "total_sales"]


def region_rows(spark):
    return spark.createDataFrame([(1, "eu"), (2, "na"), (3, "eu")], "id int, region string")


@pytest.mark.parametrize("compact", [False, True])
def test_partitioned_table_is_pruned(spark, database, compact):
    sources.write_partitioned(region_rows(spark), "sales", ["region"], compact=compact)
    read = spark.table("sales").filter("region = 'eu'")
    assert rows(read) == [(1, "eu"), (3, "eu")]
    assert "region" in physical_plan(read).split("PartitionFilters: [")[1].split("]")[0]
    assert all("region=eu" in f for f in read.inputFiles())


def test_pruned_read_by_date(spark, database):
    df = spark.range(100).select("id", F.date_add(F.lit("2024-01-01"), (F.col("id") % 50).cast("int")).alias("day"))
    sources.write_partitioned(df, "daily", ["day"])
    read = spark.table("daily").filter(F.col("day").between("2024-01-05", "2024-01-06"))
    assert read.count() == 4
    assert {f.split("day=")[1][:10] for f in read.inputFiles()} == {"2024-01-05", "2024-01-06"}


def test_partitions(spark, database):
    sources.create_empty_table(spark, "sales", "id int, region string", partition_by=["region"])
    sources.add_partition(spark, "sales", region="apac")
    sources.add_partition(spark, "sales", region="apac")
    sources.append_by_name(region_rows(spark), "sales")
    assert {r[0] for r in spark.sql("SHOW PARTITIONS sales").collect()} == {"region=apac", "region=eu", "region=na"}
    newer = spark.createDataFrame([("eu", 9)], "region string, id int")
    for _ in range(2):
        sources.replace_partitions(newer, "sales")
        assert rows(spark.table("sales")) == [(2, "na"), (9, "eu")]


def test_replace_one_partition(spark, database):
    sources.create_empty_table(spark, "sales", "id int, region string", partition_by=["region"])
    sources.append_by_name(region_rows(spark), "sales")
    sources.replace_partition(spark.createDataFrame([(7,)], "id int"), "sales", region="eu")
    assert rows(spark.table("sales")) == [(2, "na"), (7, "eu")]
    sources.replace_partition(spark.createDataFrame([], "id int"), "sales", region="eu")
    sources.replace_partition(spark.createDataFrame([(8,)], "id int"), "sales", region="it's \\ new")
    assert rows(spark.table("sales")) == [(2, "na"), (8, "it's \\ new")]
    with pytest.raises(sources.UnsafeInsert):
        sources.replace_partition(region_rows(spark), "sales", region="eu")


@pytest.mark.parametrize("gather", [False, True])
def test_bucketed_tables_join_without_a_shuffle(spark, database, conf, gather):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    for name, n in (("transactions", 1000), ("customers", 100)):
        df = spark.range(0, n, 1, 3).select((F.col("id") % 100).alias("customer_id"), F.col("id").alias(f"{name}_id"))
        sources.write_bucketed(df, name, "customer_id", 4, gather=gather)
    joined = spark.table("transactions").join(spark.table("customers"), "customer_id")
    assert "Exchange" not in physical_plan(joined)
    assert joined.count() == 1000
    plain = spark.range(1000).withColumn("customer_id", F.col("id") % 100).join(spark.table("customers"), "customer_id")
    assert "Exchange" in physical_plan(plain)


def test_databases_views_and_drops(spark):
    sources.create_database(spark, "shop")
    sources.create_database(spark, "shop")
    sources.use_database(spark, "shop")
    sources.append_or_create(region_rows(spark), "t")
    for _ in range(2):
        sources.create_view(spark, "v", "SELECT id FROM t WHERE region = 'eu'")
    assert rows(spark.table("v")) == [(1,), (3,)]
    with pytest.raises(AnalysisException):
        sources.drop_database(spark, "shop")
    for _ in range(2):
        sources.drop_views(spark, "shop.v")
        sources.drop_tables(spark, "shop.t")
    sources.use_database(spark, "default")
    for _ in range(2):
        sources.drop_database(spark, "shop")
    assert not spark.catalog.databaseExists("shop")


def test_temp_view_is_dropped_after_an_error(spark):
    with pytest.raises(ZeroDivisionError), sources.temp_view(spark.range(3), "three") as name:
        assert spark.table(name).count() == 3
        raise ZeroDivisionError
    assert not spark.catalog.tableExists("three")
    sources.drop_temp_views(spark, "three")


def test_cache_is_released_after_an_error(spark):
    df = spark.range(3).withColumn("x", F.col("id") + 1)
    with pytest.raises(ZeroDivisionError), sources.cached(df) as kept:
        assert kept.count() == 3 and kept.storageLevel != StorageLevel.NONE
        raise ZeroDivisionError
    assert df.storageLevel == StorageLevel.NONE


@pytest.mark.parametrize("how", ["checkpoint", "table", "cache"])
def test_held_result_is_computed_once(spark, how):
    calls = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            calls.add(len(batch))
            yield batch

    df = spark.range(20).mapInPandas(count, "id long")
    with sources.held(df, how) as rows_:
        assert rows_.count() == 20 and rows_.agg(F.sum("id")).first()[0] == 190
    assert calls.value == 20
    if how == "table":
        assert spark.sql("SHOW TABLES IN tallymark_scratch LIKE 'held_*'").count() == 0


def test_unknown_way_to_hold(spark):
    with pytest.raises(ValueError, match="unknown"), sources.held(spark.range(1), "memory"):
        pass


def test_scratch_lies_in_the_shared_folder(spark):
    root = sources.scratch_root(spark)
    assert spark.conf.get("spark.checkpoint.dir") in root
    name = sources.scratch_database(spark)
    assert root.split(":")[-1] in spark.catalog.getDatabase(name).locationUri
