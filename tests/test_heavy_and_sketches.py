"""Profiles from sketches, heavy keys apart, published loads, robust outliers, lineage, clustered files."""

from __future__ import annotations

import glob
import math
import random
import statistics

import pyarrow.parquet as pq
import pytest
from conftest import physical_plan, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallymark.functions.text import code_of
from tallymark.operators import heavy, lineage, quality, sketches
from tallymark.plans import sales
from tallymark.sources import clustered, readers, scope, writers
from tallymark.sources.ledger import Ledger

# --- sketches -------------------------------------------------------------------------------------------------------


def test_profiles_of_periods_from_days(spark):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 20).cast("int"))
    df = spark.range(60_000).select(
        day.alias("d"), (F.col("id") % 3).alias("g"), (F.pmod(F.xxhash64("id"), F.lit(7001)) / 4).alias("v"),
        F.when(F.col("id") % 5 > 0, F.col("id")).alias("w"),
    )
    days = scope.checkpointed(sketches.daily_sketches(df, "d", ["v", "w"], by=["g"]))
    assert days.count() == 20 * 3 * 2
    for start, end in (("2024-01-03", "2024-01-03"), ("2024-01-02", "2024-01-15"), ("2023-01-01", "2025-01-01")):
        inside = df.where(F.col("d").between(start, end))
        found = {(r.g, r.column_name): r for r in sketches.profile_of_period(days, start, end, by=["g"]).collect()}
        assert len(found) == 6
        for (g, c), r in found.items():
            exact = inside.where(F.col("g") == g).agg(
                F.count("*"), F.count_if(F.col(c).isNull()), F.min(c).cast("double"), F.max(c).cast("double"), F.avg(c),
                F.count_distinct(c), *(F.avg((F.col(c) <= q).cast("double")) for q in r.quantiles),
            ).first()
            assert (r.n_rows, r.n_nulls, r.min_value, r.max_value) == tuple(exact)[:4]
            assert r.mean_value == pytest.approx(exact[4], rel=1e-12)
            assert abs(r.n_distinct - exact[5]) <= sketches.DISTINCT_BOUND * exact[5] + 1
            ties = 0.02 if r.n_rows < 2000 else 0.002
            assert all(abs(x - q) <= sketches.RANK_BOUND + ties for x, q in zip(exact[6:], (0.25, 0.5, 0.75), strict=True))


def test_merged_distinct_counts_equal_those_of_the_whole(spark):
    df = spark.range(30_000).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 9).cast("int")).alias("d"), "id")
    days = sketches.daily_sketches(df, "d", ["id"])
    whole = sketches.daily_sketches(df.withColumn("d", F.lit("2024-01-01").cast("date")), "d", ["id"])
    period = ("2024-01-01", "2024-01-31")
    assert sketches.profile_of_period(days, *period).first().n_distinct == sketches.profile_of_period(whole, *period).first().n_distinct


def test_sketches_of_odd_values(spark):
    schema = "d string, v double, w double"
    df = spark.createDataFrame([("2024-01-01", None, math.nan), ("2024-01-01", None, 1.5), (None, 1.0, None), ("2024-01-02", None, math.inf)], schema)
    days = sketches.daily_sketches(df, "d", ["v", "w"])
    found = {r.column_name: r for r in sketches.profile_of_period(days, "2024-01-01", "2024-01-02").collect()}
    assert (found["v"].n_rows, found["v"].n_nulls, found["v"].n_distinct, found["v"].mean_value) == (3, 3, 0, None)
    assert found["v"].quantiles == [None] * 3
    assert (found["w"].n_nulls, found["w"].n_distinct) == (0, 3) and found["w"].quantiles == [1.5] * 3
    assert math.isnan(found["w"].mean_value) and sketches.profile_of_period(days, "2025-01-01", "2025-01-02").count() == 0


# --- heavy keys -----------------------------------------------------------------------------------------------------


def skewed(spark, n=60_000):
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, 8).when(F.col("id") % 10 == 2, None).otherwise(F.col("id") % 5000)
    return spark.range(0, n, 1, 4).select(key.alias("k"), F.col("id").alias("row"))


def test_heavy_keys_are_found(spark):
    assert set(heavy.heavy_keys(skewed(spark), "k", 0.05)) == {7, 8}
    assert heavy.heavy_keys(spark.range(1000), "id", 0.05) == []
    assert heavy.heavy_keys(spark.range(0), "id") == []
    texts = skewed(spark, 3000).select(F.concat(F.lit("t"), F.col("k").cast("string")).alias("k"))
    assert set(heavy.heavy_keys(texts, "k", 0.05)) == {"t7", "t8"}


@pytest.mark.parametrize("how", ["broadcast", "salted"])
def test_join_with_heavy_keys_apart(spark, database, conf, how):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    left = skewed(spark)
    right = spark.range(0, 5000, 1, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    right = right.union(spark.createDataFrame([(7, -1), (None, 0)], "k long, v long"))
    assert set(heavy.write_apart({"l": left, "r": right}, "k", share=0.05, buckets=8)) == {7, 8}
    found = heavy.join_apart(spark, "l", "r", "k", max_rows=1_000_000 if how == "broadcast" else 0, salts=5)
    want = left.join(right, "k")
    assert found.count() == want.count() and found.exceptAll(want).count() == 0
    light = spark.table("l").join(spark.table("r"), "k")
    assert "Exchange" not in physical_plan(light)
    per_task = [r[1] for r in light.groupBy(F.spark_partition_id()).count().collect()]
    assert max(per_task) < 60_000 / 8  # a third of all rows is in one key
    plan = physical_plan(found)
    assert ("BroadcastHashJoin" in plan) == (how == "broadcast")


# --- published loads ------------------------------------------------------------------------------------------------

JANUARY = ("2024-01-01", "2024-01-31")


@pytest.fixture
def ledger(spark, database):
    lines = [("a", 1.5, "2024-01-02"), ("a", 2.0, "2024-01-31"), ("b", None, "2024-01-05"), ("c", 9.0, "2024-02-01")]
    spark.createDataFrame(lines, "product_id string, sales double, sale_date string").write.saveAsTable("sales_table")
    book = Ledger(spark, "ledger")
    for table in ("summary_table", "detailed_sales_summary"):
        book.create_target(table, "product_id string, total_sales double")
    return book


def test_both_tables_become_visible_at_once(spark, ledger, monkeypatch):
    def seen():
        return [rows(ledger.read(t)) for t in ("summary_table", "detailed_sales_summary")]

    assert seen() == [[], []]
    stage, calls = Ledger.stage, []

    def breaks_off(self, df, table, **options):
        if table == "detailed_sales_summary" and not calls:
            calls.append(table)
            raise OSError("lost")
        stage(self, df, table, **options)

    monkeypatch.setattr(Ledger, "stage", breaks_off)
    with pytest.raises(OSError):
        sales.process_sales_data_published(*JANUARY, spark, ledger=ledger, run_id="one")
    assert seen() == [[], []] and rows(ledger.unfinished().select("run_id", "n_staged")) == [("one", 1)]
    assert spark.table("summary_table").count() == 2
    # the source changes before the run is resumed: what was staged stays, and both tables agree
    spark.createDataFrame([("a", 100.0, "2024-01-09")], spark.table("sales_table").schema).write.insertInto("sales_table")
    sales.process_sales_data_published(*JANUARY, spark, ledger=ledger, run_id="one")
    assert seen() == [[("a", 3.5), ("b", None)], [("a", 3.5)]] and ledger.unfinished().count() == 0
    sales.process_sales_data_published(*JANUARY, spark, ledger=ledger, run_id="one")
    assert seen() == [[("a", 3.5), ("b", None)], [("a", 3.5)]]
    # a later run of the period takes its place, another period comes beside it
    sales.process_sales_data_published(*JANUARY, spark, ledger=ledger, run_id="two")
    sales.process_sales_data_published("2024-02-01", "2024-02-29", spark, ledger=ledger, run_id="three")
    assert seen() == [[("a", 103.5), ("b", None), ("c", 9.0)], [("a", 103.5), ("c", 9.0)]]
    assert sales.load_gaps(ledger.read("summary_table"), ledger.read("detailed_sales_summary")).count() == 0


def test_rows_staged_in_part_are_replaced(spark, ledger):
    left_over = spark.createDataFrame([("z", 1.0, "one")], "product_id string, total_sales double, run_id string")
    writers.append_by_name(left_over, "summary_table")
    sales.process_sales_data_published(*JANUARY, spark, ledger=ledger, run_id="one")
    assert rows(ledger.read("summary_table")) == [("a", 3.5), ("b", None)]
    with pytest.raises(writers.UnsafeInsert):
        spark.sql("CREATE TABLE odd (product_id STRING, run_id STRING) USING parquet PARTITIONED BY (run_id)")
        sales.process_sales_data_published(*JANUARY, spark, ledger=ledger, run_id="four", detail="odd")
    assert "staged summary_table" not in ledger.states("four")


# --- robust outliers ------------------------------------------------------------------------------------------------


def grouped_values():
    rng = random.Random(3)
    groups = {g: [rng.choice([None, rng.gauss(0, 1), float(rng.randint(0, 1))]) for _ in range(n)] for g, n in ((1, 1), (2, 2), (3, 500), (None, 501))}
    groups[4], groups[5], groups[6] = [None, None], [5.0] * 9 + [6.0], [math.nan, 1.0, 4.0]
    groups[7] = [float(i) for i in range(20_000)]
    return groups


@pytest.mark.parametrize("band", [0.0005, -0.2])  # the second leaves the middle out, so that the built-in form is used
def test_medians_are_exact(spark, monkeypatch, band):
    monkeypatch.setattr(quality, "_BAND", band)
    data = [(g, v) for g, values in grouped_values().items() for v in values]
    df = spark.createDataFrame(data, "g int, v double").repartition(5)
    found = {r.g: r.median for r in quality.exact_medians(df, ["g"], "v").collect()}
    plain = {g: [v for v in values if v is not None and v == v] for g, values in grouped_values().items()}
    assert found == {g: pytest.approx(statistics.median(v), rel=1e-12) for g, v in plain.items() if v}
    assert quality.exact_medians(df.limit(0), ["g"], "v").count() == 0


def test_one_huge_value_hides_no_other(spark):
    values = [10.0, 11.0, 9.0, 10.5, 9.5, 10.2, 9.8, 30.0, 1e9]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", None), ("b", 1.0)], "g string, v double")
    assert [r.v for r in quality.outliers(df, ["g"], "v", z=2.5).collect()] in ([], [1e9])
    assert sorted(r.v for r in quality.robust_outliers(df, ["g"], "v").collect()) == [30.0, 1e9]
    assert quality.robust_outliers(df, ["g"], "v").columns == ["g", "v"]


# --- words in comments and quotes -----------------------------------------------------------------------------------


def test_only_code_is_counted(spark):
    scripts = {
        "select 'select '' select' from t -- select\n": "select    from t  \n",
        'select "a -- b" /* select \n * / join */ from u': "select     from u",
        "it's -- 'not'": "it not ",
        "/* never ends select": " ",
        "-- '\nselect 'x'": " \nselect  ",
        "a '' b": "a   b",
        "": "",
    }
    df = spark.createDataFrame([(s,) for s in scripts], "text string")
    assert {r.text: r.c for r in df.withColumn("c", code_of(F.col("text"))).collect()} == scripts
    # an apostrophe begins a text whatever follows; a long script does not fill the stack
    long = spark.createDataFrame([("select '" + "''" * 200_000 + "' from t /*" + " *" * 200_000 + "*/ join u",)], "text string")
    counts = quality.script_metrics(long, code_only=True).first()
    assert (counts.n_select, counts.n_join, counts.n_tables) == (1, 1, 2)
    script = "select 1 -- select\n/* drop */ insert 'where'"
    one = spark.createDataFrame([(script,)], "text string")
    assert tuple(quality.script_metrics(one, code_only=True).select("n_lines", "n_select", "n_drop", "n_condition").first()) == (2, 1, 0, 0)
    assert tuple(quality.script_metrics(one).select("n_lines", "n_select", "n_drop", "n_condition").first()) == (2, 2, 1, 1)


# --- delimited catalog tables ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("text", ["a\nb", "a\r"])
def test_a_text_that_could_not_be_read_again_is_refused(spark, database, text):
    readers.create_delimited_table(spark, "lines", "id INT, name STRING")
    good = spark.createDataFrame([(1, 'x,"y'), (2, None)], "id int, name string")
    writers.append_by_name(good, "lines")
    with pytest.raises(PySparkException, match="line break"):
        writers.append_by_name(spark.createDataFrame([(3, text)], "id int, name string"), "lines")
    assert rows(spark.table("lines")) == [(1, 'x,"y'), (2, None)]


# --- lineage --------------------------------------------------------------------------------------------------------


def test_totals_can_be_traced_to_their_files(spark, database):
    df = spark.range(0, 2000).select(
        F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("k"), (F.col("id") / 4).alias("v"), F.expr("id div 25").alias("part")
    )
    df.repartitionByRange(80, "part").write.saveAsTable("t")
    table = spark.table("t")
    files = lineage.numbered_files(table)
    assert files.count() == 80
    totals = scope.checkpointed(lineage.traced_totals(table, files, ["k"], "v"))
    want = {r.k: r.s for r in df.groupBy("k").agg(F.sum("v").alias("s")).collect()}
    assert {r.k: r.total_sales for r in totals.collect()} == want
    held = {(r.k, r.file) for r in table.select("k", F.col("_metadata.file_path").alias("file")).distinct().collect()}
    assert {(r.k, r.file) for r in lineage.sources_of(totals, files, ["k"]).collect()} == held
    again = lineage.retraced_totals(table, totals, files, ["k"], "v").collect()
    assert len(again) == 7 and all(r.same for r in again)
    none = table.where("k = 99")
    assert lineage.traced_totals(none, files, ["k"], "v").count() == 0
    one = lineage.traced_totals(table.where("part = 40 and k = 1"), files, ["k"], "v")
    assert lineage.sources_of(one, files, ["k"]).count() == 1


# --- clustered files ------------------------------------------------------------------------------------------------


def touched(folder, column, low, high):
    """Share of the row groups whose statistics do not rule a range out."""
    hit = total = 0
    for name in glob.glob(f"{folder}/*.parquet"):
        about = pq.ParquetFile(name).metadata
        at = about.schema.names.index(column)
        for i in range(about.num_row_groups):
            s = about.row_group(i).column(at).statistics
            total += 1
            hit += s.min <= high and s.max >= low
    return hit / total


def test_either_column_skips_row_groups(spark, database):
    x, y = (F.pmod(F.xxhash64("id", F.lit(i)), F.lit(10_000)) for i in (1, 2))
    text = F.concat(F.chr((F.col("y") % 26 + 97)), F.lit("-"), F.col("y").cast("string"))
    df = spark.range(0, 40_000, 1, 4).select(x.alias("x"), y.alias("y")).withColumn("text", text)
    df = df.withColumn("x", F.when(F.col("x") < 3000, 50).otherwise(F.col("x")))  # one value in a third of all rows
    clustered.write_clustered(df, "c", ["x", "y"], files=32)
    df.repartition(32).write.saveAsTable("plain")
    assert rows(spark.table("c").groupBy().agg(F.count("*"), F.sum(F.xxhash64("x", "y", "text").cast("decimal(38,0)")))) == rows(
        df.groupBy().agg(F.count("*"), F.sum(F.xxhash64("x", "y", "text").cast("decimal(38,0)")))
    )
    folders = {t: spark.table(t).inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0] for t in ("c", "plain")}
    for column in ("x", "y"):
        assert touched(folders["plain"], column, 7000, 7100) == 1
        assert touched(folders["c"], column, 7000, 7100) < 0.4
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{folders['c']}/*.parquet")]
    assert max(sizes) < 5 * 40_000 / 32
    clustered.write_clustered(df.limit(0), "empty", ["x", "text"])
    assert spark.table("empty").count() == 0
    clustered.write_clustered(df.withColumn("d", F.to_date(F.lit("2024-01-01"))), "mixed", ["text", "d", "x"], files=4)
    assert spark.table("mixed").count() == 40_000
    with pytest.raises(ValueError, match="1 to 60"):
        clustered.write_clustered(df, "c", [])
