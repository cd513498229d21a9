"""Profiles of any period from sketches kept per day, without reading the rows again.

Counts, sums and extremes of a day are exact. Distinct values are kept as an HLL sketch and the distribution as a KLL sketch;
both are merged to those of the period. Merging HLL sketches gives the sketch of the whole; the relative error is about
1.04 / sqrt(2^lg_k) in one of three cases, so 0.8 % for the default, and beyond three times that almost never. A quantile of a
KLL sketch has a rank that is off by about 2.3 / k^0.9 at most in 99 of 100 cases, merged or not: 0.6 % for the default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.numbers import exact_parts, exact_total
from tallymark.operators.filters import Day
from tallymark.operators.quality import require_columns

LG_K, K = 14, 800
#: What the estimates stay within: three standard errors of distinct counts, and of ranks.
DISTINCT_BOUND, RANK_BOUND = 0.025, 0.01

_PARTS = ("low", "high", "large", "odd")


def daily_sketches(
    df: DataFrame, date: str, columns: Sequence[str], *, by: Sequence[str] = (), scale: int = 2, lg_k: int = LG_K, k: int = K
) -> DataFrame:
    """One row per day, group and numeric column: ``n_rows``, ``n_values``, extremes, parts of the sum, two sketches.

    One pass; each task sends one row per day and group. NULL dates form a day of their own. ``scale`` is the number of
    digits that sums keep (see :func:`tallymark.functions.numbers.exact_sum`); NaN and Infinity count as values and in
    sums, but have no place in the distribution.
    """

    def measures(name: str) -> Column:
        value = F.col(f"`{name}`")
        number = value.cast("double")
        finite = F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)
        parts = exact_parts(value, scale)
        return F.struct(
            F.count("*").alias("n_rows"),
            F.count(value).alias("n_values"),
            F.min(number).alias("min_value"),
            F.max(number).alias("max_value"),
            *(parts[p].alias(f"sum_{p}") for p in _PARTS),
            F.hll_sketch_agg(F.when(value.isNotNull(), F.xxhash64(value)), F.lit(lg_k)).alias("distinct"),
            F.kll_sketch_agg_double(finite, F.lit(k)).alias("distribution"),
        ).alias(name)

    rows = require_columns(df, date, *by, *columns)
    days = rows.groupBy(F.col(f"`{date}`").cast("date").alias("day"), *by).agg(*map(measures, columns))
    return days.unpivot(["day", *by], list(columns), "column_name", "_m").select("day", *by, "column_name", "_m.*")


def profile_of_period(
    days: DataFrame,
    start: Day,
    end: Day,
    *,
    by: Sequence[str] = (),
    scale: int = 2,
    quantiles: Sequence[float] = (0.25, 0.5, 0.75),
) -> DataFrame:
    """One row per group and column of the period, both ends included, from :func:`daily_sketches` alone.

    ``n_rows``, ``n_nulls``, ``min_value``, ``max_value`` and ``mean_value`` are exact; ``n_distinct`` and ``quantiles`` are
    estimates. A period without rows gives none.
    """
    inside = days.where(F.col("day").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    merged = inside.groupBy(*by, "column_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_values").alias("n_values"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        *(F.sum(f"sum_{p}").alias(f"_{p}") for p in _PARTS),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("n_distinct"),
        F.kll_merge_agg_double(F.when(F.kll_sketch_get_n_double("distribution") > 0, F.col("distribution"))).alias("_kll"),
    )
    total = exact_total({p: F.col(f"_{p}") for p in _PARTS}, scale)
    some = F.kll_sketch_get_n_double("_kll") > 0
    found = [F.when(some, F.kll_sketch_get_quantile_double("_kll", F.lit(float(q)))) for q in quantiles]
    return merged.select(
        *by,
        "column_name",
        "n_rows",
        (F.col("n_rows") - F.col("n_values")).alias("n_nulls"),
        "n_distinct",
        "min_value",
        "max_value",
        (total / F.nullif("n_values", F.lit(0))).alias("mean_value"),
        F.array(*found).alias("quantiles"),
    )
