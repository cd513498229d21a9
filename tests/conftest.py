from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tallymark-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def database(spark, request):
    """A database of its own for each test."""
    name = "t_" + "".join(c if c.isalnum() else "_" for c in request.node.name.lower())
    spark.sql(f"CREATE DATABASE {name}")
    spark.catalog.setCurrentDatabase(name)
    yield name
    spark.catalog.setCurrentDatabase("default")
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def change(**options):
        for key, value in options.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def rows(df):
    """All rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def physical_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
