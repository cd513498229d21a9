"""Aggregates. Spark sums each partition before the shuffle, so a key that holds a third of the rows is one row per task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.numbers import exact_sum


def _sum(value: str, scale: int | None) -> Column:
    return F.sum(value) if scale is None else exact_sum(F.col(value), scale)


def total_by(
    df: DataFrame, keys: Sequence[str], value: str, *, name: str = "total_sales", scale: int | None = None
) -> DataFrame:
    """Sum of ``value`` per key. NULL values are ignored, an all-NULL group sums to NULL, NULL keys form one group.

    With ``scale`` the sum runs in decimals (:func:`exact_sum`), so it does not depend on the order of the rows.
    """
    return df.groupBy(*keys).agg(_sum(value, scale).alias(name))


def count_and_total_by(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    *,
    count_name: str = "total_sales",
    total_name: str = "total_amount",
    scale: int | None = None,
) -> DataFrame:
    """Rows and sum per key."""
    return df.groupBy(*keys).agg(F.count("*").alias(count_name), _sum(value, scale).alias(total_name))


def count_by(df: DataFrame, keys: Sequence[str], column: str, *, name: str, more_than: int | None = None) -> DataFrame:
    """Non-NULL values of ``column`` per key, if asked only groups with ``more_than`` so many."""
    counts = df.groupBy(*keys).agg(F.count(column).alias(name))
    return counts if more_than is None else counts.filter(F.col(name) > more_than)


def combine_totals(parts: DataFrame, keys: Sequence[str], *, name: str = "total_sales") -> DataFrame:
    """Totals of totals: sums of parts (days, files, chunks) to the sum of the whole."""
    return parts.groupBy(*keys).agg(F.sum(name).alias(name))


def period_statistics(df: DataFrame, key: str, value: str, *, scale: int | None = None) -> DataFrame:
    """One row: rows, distinct keys (NULL counts as one) and the total. One pass over the data."""
    distinct = F.count_distinct(F.col(key)) + F.coalesce(F.max(F.col(key).isNull().cast("int")), F.lit(0))
    return df.agg(
        F.count("*").alias("total_records"),
        distinct.cast("long").alias("unique_products"),
        _sum(value, scale).alias("total_sales_amount"),
    )


def summary_statistics(
    totals: DataFrame, value: str = "total_sales", *, scale: int | None = None, round_to: int | None = None
) -> DataFrame:
    """Grand total, extremes and mean over per-key totals, plus the number of keys (NULL totals included).

    No row when there is nothing to sum up. ``scale`` makes the sum independent of the order of the rows.
    """
    grand = _sum(value, scale).cast("double")
    mean = grand / F.nullif(F.count(value), F.lit(0))
    return totals.agg(
        grand.alias("grand_total"),
        F.max(value).cast("double").alias("max_sales"),
        F.min(value).cast("double").alias("min_sales"),
        (mean if round_to is None else F.round(mean, round_to)).alias("avg_sales"),
        F.count("*").alias("total_products"),
    ).filter(F.col("grand_total").isNotNull())


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def ordered(df: DataFrame, *columns: str) -> DataFrame:
    """Total order, for showing a result; tables keep no order."""
    return df.orderBy(*columns)
