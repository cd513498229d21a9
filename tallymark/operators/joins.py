"""Joins.

Spark chooses the physical join. It broadcasts a side by its size, and adaptive execution splits a hot key of an inner,
semi, anti or left join into several tasks. It cannot do so for a full outer join, which is why comparisons of two whole
tables (:mod:`tallymark.operators.reconcile`) group the union of both sides instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.numbers import exact_parts, exact_total
from tallymark.functions.size import row_bytes
from tallymark.operators.audit import counted
from tallymark.sources.scope import checkpointed

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Whether ``df`` is proven small: its rows are counted, and if few enough they are measured.

    The count needs no column, so of a Parquet table it reads the footers only; each task sends one number.
    """
    return df.count() <= max_rows and (df.agg(F.sum(row_bytes(df))).first()[0] or 0) <= max_bytes


def broadcast_within(
    df: DataFrame,
    n_rows: int,
    n_bytes: int | None,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``df``, whose size has been measured, marked for broadcast if it is within the bounds."""
    return F.broadcast(df) if n_rows <= max_rows and (n_bytes or 0) <= max_bytes else df


def checkpointed_lookup(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """A computed lookup table: computed once, kept in the shared folder, measured on the way, broadcast only if small."""
    watched, seen = counted(df, n_bytes=F.sum(row_bytes(df)))
    kept = checkpointed(watched)
    return broadcast_within(kept, seen.get["n_rows"], seen.get["n_bytes"], max_rows, max_bytes)


def broadcast_if_small(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """``df`` marked for broadcast if it is proven small, otherwise ``df`` as it is: Spark then shuffles the join."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def inner_join(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return left.join(right, on, "inner")


def lookup_join(facts: DataFrame, lookup: DataFrame, on: str | Sequence[str], **bounds: int) -> DataFrame:
    """Inner join with a lookup table that is broadcast only if its size has been checked (``max_rows``, ``max_bytes``)."""
    return facts.join(broadcast_if_small(lookup, **bounds), on, "inner")


def same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    """NULL-safe equality of all keys between the DataFrames aliased ``left`` and ``right``; still an equi-join."""
    return reduce(lambda a, b: a & b, (F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys))


def full_outer_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join in which NULL keys meet each other.

    Columns other than the keys are called ``left_<name>`` and ``right_<name>``; ``in_left`` and ``in_right`` tell where
    the row exists, since a NULL key is legal. Keys must be unique on each side (aggregate first): repeated keys would
    pair up with one another.
    """
    sides = {}
    for side, df in (("left", left), ("right", right)):
        renamed = {c: f"{side}_{c}" for c in df.columns if c not in keys}
        sides[side] = df.withColumnsRenamed(renamed).withColumn(f"in_{side}", F.lit(True)).alias(side)
    joined = sides["left"].join(sides["right"], same_keys("left", "right", keys), "full")
    return joined.select(
        # COALESCE is right for NULL keys as well: both sides are NULL then
        *(F.coalesce(F.col(f"left.{k}"), F.col(f"right.{k}")).alias(k) for k in keys),
        *(F.col(f"left_{c}") for c in left.columns if c not in keys),
        *(F.col(f"right_{c}") for c in right.columns if c not in keys),
        F.coalesce("in_left", F.lit(False)).alias("in_left"),
        F.coalesce("in_right", F.lit(False)).alias("in_right"),
    )


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Rows of ``child`` whose key is missing in ``parent``. A NULL key refers to nothing and is no orphan.

    Parent keys are made distinct first and kept in the shared folder: adaptive execution splits a hot key of the child
    only where nothing below the join depends on its partitioning, and it could not split one of the parent. Measured
    while they are written, the keys are broadcast if few.
    """
    keys = parent.select(F.col(parent_key).alias("_parent_key"))
    parents = checkpointed_lookup(keys.filter(F.col("_parent_key").isNotNull()).distinct())
    linked = child.filter(F.col(child_key).isNotNull())
    return linked.join(parents, F.col(child_key) == F.col("_parent_key"), "left_anti")


def days_of_periods(periods: DataFrame, range_id: str = "range_id", start: str = "s", end: str = "e") -> DataFrame:
    """One row per period and calendar day; an inverted period has none."""
    days = F.when(F.col(start) <= F.col(end), F.sequence(F.col(start).cast("date"), F.col(end).cast("date")))
    return periods.select(range_id, F.explode(days).alias("day"))


# Days are numbered from 1970; no two dates of the calendar lie 2^22 days apart.
_LEVELS = 22


def cover_of_periods(periods: DataFrame, range_id: str = "range_id", start: str = "s", end: str = "e") -> DataFrame:
    """``range_id, level, node``: the fewest intervals of 1, 2, 4 … days that make up each period.

    An interval of ``level`` holds the 2^``level`` days whose number shifted by ``level`` is ``node``. A period of ``n`` days
    is made of at most two of each level, fewer than ``2 log2(n) + 2``; an inverted period of none.
    """
    origin = F.lit("1970-01-01").cast("date")
    bounds = periods.filter(F.col(start) <= F.col(end)).select(
        F.col(range_id),
        F.date_diff(F.col(start).cast("date"), origin).alias("_first"),
        (F.date_diff(F.col(end).cast("date"), origin) + 1).alias("_behind"),
    )
    levels = bounds.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(_LEVELS))))
    # whole intervals of the level inside the period: from the rounded-up start to the rounded-down end
    low, high = F.expr("-shiftright(-_first, level)"), F.expr("shiftright(_behind, level)")
    inside = levels.select(range_id, "level", low.alias("_low"), high.alias("_high")).where("_low < _high")
    # those at an odd border have no parent inside the period
    ends = F.array_compact(
        F.array(F.when(F.expr("_low & 1 = 1"), F.col("_low")), F.when(F.expr("_high & 1 = 1"), F.col("_high") - 1))
    )
    return inside.select(range_id, "level", F.explode(ends).alias("node"))


def totals_per_period(
    df: DataFrame,
    periods: DataFrame,
    *,
    keys: Sequence[str],
    value: str,
    date: str,
    range_id: str = "range_id",
    start: str = "s",
    end: str = "e",
    name: str = "total_sales",
    scale: int | None = None,
) -> DataFrame:
    """Sum of ``value`` per period and key for many, possibly overlapping, periods in one read of ``df``.

    A range condition has no key to hash on and would compare every row with every period. Instead days form a hierarchy
    of intervals of 1, 2, 4 … days, and each period is made of a few of them (:func:`cover_of_periods`). Rows are summed
    per key and day, these sums per key and interval, for intervals that some period needs, and the intervals meet the
    periods by equality. So a key costs as much as it has days, times the levels in use, and results, however many periods
    there are and however much they overlap. Totals are only ever added, never subtracted: they are right for doubles,
    NaN and Infinity, and with ``scale`` equal those of :func:`exact_sum`.

    Intervals and periods are broadcast where they are proven small, and joined by a shuffle otherwise. The outer bounds of
    all periods go to the scan as a filter.
    """
    cover = checkpointed(cover_of_periods(periods, range_id, start, end))
    about = periods.agg(F.min(start).cast("date").alias("first"), F.max(end).cast("date").alias("last")).first()
    used = cover.agg(
        F.sort_array(F.collect_set("level")).alias("levels"), F.count("*").alias("n"), F.sum(row_bytes(cover)).alias("bytes")
    ).first()
    day = F.col(date).cast("date")
    rows = df.filter(day.between(F.lit(about["first"]), F.lit(about["last"]))).select(
        *keys, F.date_diff(day, F.lit("1970-01-01").cast("date")).alias("_day"), F.col(value).alias("_amount")
    )
    sums = {"sum": F.sum("_amount")} if scale is None else exact_parts(F.col("_amount"), scale)
    names = {part: f"_{part}" for part in sums}
    merged = [F.sum(c).alias(c) for c in names.values()]
    by_day = rows.groupBy(*keys, "_day").agg(*(sums[part].alias(c) for part, c in names.items()))
    levels = F.explode(F.array(*map(F.lit, used["levels"])) if used["levels"] else F.array().cast("array<int>"))
    nodes = by_day.select(*keys, *names.values(), "_day", levels.alias("level"))
    nodes = nodes.select(*keys, *names.values(), "level", F.expr("shiftright(_day, level)").alias("node"))
    wanted = broadcast_within(cover.select("level", "node").distinct(), used["n"], used["bytes"])
    by_node = nodes.join(wanted, ["level", "node"], "left_semi").groupBy(*keys, "level", "node").agg(*merged)
    parts = by_node.join(broadcast_within(cover, used["n"], used["bytes"]), ["level", "node"])
    totals = parts.groupBy(range_id, *keys).agg(*merged)
    total = F.col("_sum") if scale is None else exact_total({part: F.col(c) for part, c in names.items()}, scale)
    return totals.select(range_id, *keys, total.alias(name))
