"""Comparing tables by a tree of checksums, so that only what differs is shuffled row by row.

The hash of its key puts a row into a range of hashes. The rows of a range are summed up by their number and sums of their
hashes, which do not depend on the order of the rows and are combined before the shuffle: a table costs one aggregate of at
most 2^bits rows. Ranges whose checksums differ are split by further bits of the hash, then by key, and only rows of
the keys that are left are compared by value. Two tables with equal rows cost one pass over each.

:func:`range_checksums` of a table can be kept, to find out later which ranges have changed since.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.compare import row_fingerprint
from tallymark.functions.size import row_bytes
from tallymark.operators.audit import counted
from tallymark.operators.joins import broadcast_within, same_keys
from tallymark.operators.quality import require_columns
from tallymark.operators.reconcile import both_sides, keyed_diff, same_types
from tallymark.sources.scope import checkpointed

BITS_PER_LEVEL = 12
MAX_BITS = 48
#: Ranges that differ and hold no more rows than this are not split further.
FEW_ROWS = 100_000

_SUMS = ("sum0", "sum1", "sum2", "sum3")


def _range_of(hash_: Column, bits: int) -> Column:
    return F.shiftrightunsigned(hash_, 64 - bits)


def _digests(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Four numbers of 24 bits of two hashes of a row: sums of 10^11 of them fit a long."""
    hashes = [row_fingerprint(df.schema, columns, seed) for seed in (0, 1)]
    low = F.lit((1 << 24) - 1).cast("long")
    numbers = [part for h in hashes for part in (h.bitwiseAND(low), F.shiftrightunsigned(h, 40))]
    return [n.alias(name) for n, name in zip(numbers, _SUMS, strict=True)]


def _key_hash(df: DataFrame, keys: Sequence[str]) -> Column:
    return row_fingerprint(df.schema, keys, 2)


def range_checksums(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, bits: int = BITS_PER_LEVEL
) -> DataFrame:
    """``node, n_rows, sum0 … sum3`` of every range of key hashes that holds rows: at most 2^``bits`` rows."""
    columns = list(columns or df.columns)
    rows = require_columns(df, *keys, *columns).select(_key_hash(df, keys).alias("_key"), *_digests(df, columns))
    sums = (F.sum(c).alias(c) for c in _SUMS)
    return rows.groupBy(_range_of(F.col("_key"), bits).alias("node")).agg(F.count("*").alias("n_rows"), *sums)


def changed_ranges(before: DataFrame, after: DataFrame) -> DataFrame:
    """``node, rows_before, rows_after`` of the ranges whose :func:`range_checksums` differ."""
    figures = ("n_rows", *_SUMS)
    sides = before.select("node", *(F.col(c).alias(f"_b{c}") for c in figures)).join(
        after.select("node", *(F.col(c).alias(f"_a{c}") for c in figures)), "node", "full"
    )
    equal = F.lit(True)
    for c in figures:
        equal &= F.col(f"_b{c}").eqNullSafe(F.col(f"_a{c}"))
    counts = (F.coalesce(f"_{side}n_rows", F.lit(0)).alias(name) for side, name in (("b", "rows_before"), ("a", "rows_after")))
    return sides.where(~equal).select("node", *counts)


def rows_in_ranges(df: DataFrame, keys: Sequence[str], ranges: DataFrame, bits: int = BITS_PER_LEVEL) -> DataFrame:
    """The rows of ``df`` in the given ranges; the ranges of one table are at most 2^``bits`` and broadcast if small."""
    ranges = checkpointed(ranges.select("node").distinct())
    n = ranges.count()
    wanted = broadcast_within(ranges, n, 8 * n).withColumnRenamed("node", "_node")
    return df.join(wanted, _range_of(_key_hash(df, keys), bits) == F.col("_node"), "left_semi")


def tree_diff(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    *,
    compare: Sequence[str] | None = None,
    tolerance: float | Mapping[str, float] = 0.0,
    with_values: bool = False,
    bits_per_level: int = BITS_PER_LEVEL,
    few_rows: int = FEW_ROWS,
) -> DataFrame:
    """The keys whose rows differ, as :func:`keyed_diff` gives them.

    Keys with the same rows on both sides are not listed, also where they have several. ``tolerance`` is applied to the keys
    whose hashes differ. Use this form where few rows are expected to differ: each level reads both tables once more, but
    shuffles no rows, and ends as soon as the ranges that differ hold ``few_rows`` rows or more than a quarter of what was
    looked at. Two different rows would have to agree in sums of 96 bits to be missed.
    """
    columns = [c for c in (compare or left.columns) if c not in keys]
    left, right = same_types(*(require_columns(df, *keys, *columns).select(*keys, *columns) for df in (left, right)))
    differing, bits = _differing_ranges(left, right, keys, [*keys, *columns], bits_per_level, few_rows)
    if differing is not None:
        left, right = (rows_in_ranges(df, keys, differing, bits) for df in (left, right))
        suspects = _differing_keys(left, right, keys, [*keys, *columns])
        left, right = (df.alias("d").join(suspects, same_keys("d", "s", keys), "left_semi") for df in (left, right))
    else:
        left, right = left.limit(0), right.limit(0)
    return keyed_diff(
        left, right, keys, compare=columns, tolerance=tolerance, with_values=with_values, only_differences=True
    )


def _signed(rows: DataFrame) -> list[Column]:
    """Aggregates that are all 0 if both sides hold the same rows."""
    sign = F.when(F.col("_is_left"), 1).otherwise(-1)
    return [F.sum(sign).alias("_n"), *(F.sum(F.col(c) * sign).alias(c) for c in _SUMS)]


_DIFFERS = " or ".join(f"{c} != 0" for c in ("_n", *_SUMS))


def _differing_ranges(
    left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str], step: int, few_rows: int
) -> tuple[DataFrame | None, int]:
    """The ranges that differ on the lowest level looked at, none if all are equal, and the bits of that level."""
    bits, ranges = 0, None
    while True:
        sides = [left, right] if ranges is None else [rows_in_ranges(df, keys, ranges, bits) for df in (left, right)]
        bits += step
        rows = both_sides(*(df.select(_key_hash(df, keys).alias("_key"), *_digests(df, columns)) for df in sides))
        sums = rows.groupBy(_range_of(F.col("_key"), bits).alias("node")).agg(F.count("*").alias("_rows"), *_signed(rows))
        watched, seen = counted(sums, n_rows=F.sum("_rows"), n_differing=F.sum(F.when(F.expr(_DIFFERS), F.col("_rows"))))
        ranges = checkpointed(watched.where(_DIFFERS).select("node"))
        all_rows, differing = seen.get["n_rows"] or 0, seen.get["n_differing"] or 0
        if not differing:
            return None, bits
        if differing <= few_rows or differing * 4 > all_rows or bits + step > MAX_BITS:
            return ranges, bits


def _differing_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    rows = both_sides(*(df.select(*(F.col(k) for k in keys), *_digests(df, columns)) for df in (left, right)))
    found = rows.groupBy(*keys).agg(*_signed(rows)).where(_DIFFERS).select(*keys)
    watched, seen = counted(found, n_bytes=F.sum(row_bytes(found)))
    found = checkpointed(watched)
    return broadcast_within(found, found.count(), seen.get["n_bytes"]).alias("s")
