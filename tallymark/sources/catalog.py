"""Databases, views and partitions of the catalog."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def use_database(spark: SparkSession, name: str) -> None:
    spark.catalog.setCurrentDatabase(name)


def drop_database(spark: SparkSession, name: str, *, with_tables: bool = False) -> None:
    """Drop the database. Without ``with_tables`` a database that still holds tables is an error, not a loss."""
    spark.sql(f"DROP DATABASE IF EXISTS {name}{' CASCADE' if with_tables else ''}")


def create_view(spark: SparkSession, name: str, query: str) -> None:
    """Persistent view: the text is stored and expanded whenever the view is read."""
    spark.sql(f"CREATE VIEW IF NOT EXISTS {name} AS {query}")


def drop_views(spark: SparkSession, *names: str) -> None:
    for name in names:
        spark.sql(f"DROP VIEW IF EXISTS {name}")


def drop_tables(spark: SparkSession, *names: str) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def drop_temp_views(spark: SparkSession, *names: str) -> None:
    for name in names:
        spark.catalog.dropTempView(name)


def partition_spec(values: Mapping[str, str]) -> str:
    """``PARTITION (column = 'value', …)`` with quotes and backslashes in the values escaped."""
    escaped = {column: str(value).replace("\\", "\\\\").replace("'", "\\'") for column, value in values.items()}
    return f"PARTITION ({', '.join(f"`{column}` = '{value}'" for column, value in escaped.items())})"


def add_partition(spark: SparkSession, table: str, **values: str) -> None:
    """Register a partition that may hold no rows yet."""
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {partition_spec(values)}")
