"""Comparing two versions of a table.

The comparisons do not join the two sides. They tag the rows with their side, take the union and group it by key: one
shuffle instead of two, no sort of raw rows for a merge, NULL keys fall together by themselves, and repeated keys
collapse before the shuffle instead of pairing up with one another.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

from tallymark.functions.compare import changed_columns, comparable, holds_map, row_fingerprint, values_match
from tallymark.functions.numbers import exact_sum
from tallymark.operators.audit import counted
from tallymark.operators.filters import Day
from tallymark.functions.size import row_bytes
from tallymark.operators.joins import broadcast_within, same_keys
from tallymark.operators.quality import require_columns
from tallymark.sources.scope import checkpointed


def same_types(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with the types of their union. Text against another type is compared as text."""
    for name in left.columns:
        is_text = [isinstance(df.schema[name].dataType, StringType) for df in (left, right)]
        if any(is_text) and not all(is_text):
            left, right = (df.withColumn(name, F.col(f"`{name}`").cast("string")) for df in (left, right))
    types = left.unionByName(right).schema
    return tuple(df.select(*(F.col(f"`{f.name}`").cast(f.dataType) for f in types)) for df in (left, right))


def both_sides(left: DataFrame, right: DataFrame) -> DataFrame:
    """The rows of both sides, with a column ``_is_left`` that tells the side."""
    return left.withColumn("_is_left", F.lit(True)).unionByName(right.withColumn("_is_left", F.lit(False)))


def _both(left: DataFrame, right: DataFrame, columns: Sequence[Column]) -> DataFrame:
    """The given columns of the rows of both sides, with a column that tells the side."""
    sides = same_types(*(df.select(*columns) for df in (left, right))) if columns else (left.select(), right.select())
    return both_sides(*sides)


def _side(is_left: bool, value: Column) -> Column:
    side = F.col("_is_left")
    return F.when(side if is_left else ~side, value)


def _total(value: Column, scale: int | None) -> Column:
    return F.sum(value).cast("double") if scale is None else exact_sum(value, scale)


def row_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: ``left_count``, ``right_count``, ``diff`` and ``match``."""
    counts = _both(left, right, []).agg(
        F.count(_side(True, F.lit(1))).alias("left_count"), F.count(_side(False, F.lit(1))).alias("right_count")
    )
    diff = F.col("left_count") - F.col("right_count")
    return counts.select("left_count", "right_count", diff.alias("diff"), (diff == 0).alias("match"))


def aggregate_diff(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    value: str,
    *,
    tolerance: float = 0.0,
    scale: int | None = None,
) -> DataFrame:
    """Totals per key on both sides with their distance and a status.

    The status is ``match`` (within ``tolerance``, or both NULL), ``mismatch``, ``only_left`` or ``only_right``.
    Values are summed as they are; with ``scale`` in decimals (:func:`exact_sum`), so that totals of doubles do not
    depend on the order of the rows. Without it, give a ``tolerance`` for their last digits.
    """
    totals = (
        _both(left, right, [*(F.col(k) for k in keys), F.col(value).alias("_value")])
        .groupBy(*keys)
        .agg(
            _total(_side(True, F.col("_value")), scale).alias("left_total"),
            _total(_side(False, F.col("_value")), scale).alias("right_total"),
            F.count(_side(True, F.lit(1))).alias("_in_left"),
            F.count(_side(False, F.lit(1))).alias("_in_right"),
        )
    )
    status = (
        F.when(F.col("_in_right") == 0, "only_left")
        .when(F.col("_in_left") == 0, "only_right")
        .when(values_match(F.col("left_total"), F.col("right_total"), tolerance), "match")
        .otherwise("mismatch")
    )
    return totals.select(
        *keys,
        "left_total",
        "right_total",
        F.abs(F.col("left_total") - F.col("right_total")).alias("abs_diff"),
        status.alias("status"),
    )


# Up to so many numbers, dates or booleans per row travel to their key as they are; more, or texts, as hashes.
VALUES_PER_ROW = 4
_FIXED_WIDTH = (BooleanType, DateType, NumericType, TimestampNTZType, TimestampType)


def keyed_diff(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    *,
    compare: Sequence[str] | None = None,
    tolerance: float | Mapping[str, float] = 0.0,
    with_values: bool = False,
    only_differences: bool = False,
    by_hash: bool | None = None,
) -> DataFrame:
    """Status of every key: ``same``, ``changed``, ``only_left``, ``only_right`` or ``repeated``.

    ``changed_columns`` names the columns that differ, ``left_rows`` and ``right_rows`` count the rows of the key. A key
    with several rows on a side is ``repeated``: it has no single row to compare, and :func:`bag_diff` compares such
    rows as a bag. ``tolerance`` is one number for all numeric columns or one per column. ``with_values`` adds the values
    of both sides of keys that are ``changed``.

    A few numbers per row are grouped as they are. For wider rows, or with ``by_hash``, only the keys and two 64-bit
    hashes of the row are shuffled; whole rows travel just for the keys whose hashes differ, and those are compared by
    value. Two different rows would have to agree in both hashes to be missed.
    """
    columns = [c for c in (compare or left.columns) if c not in keys]
    left, right = same_types(*(require_columns(df, *keys, *columns).select(*keys, *columns) for df in (left, right)))
    types = {c: left.schema[c].dataType for c in columns}
    numeric = [c for c in columns if isinstance(types[c], NumericType)]
    tolerances = tolerance if isinstance(tolerance, Mapping) else dict.fromkeys(numeric, tolerance)
    if by_hash is None:
        by_hash = len(columns) > VALUES_PER_ROW or not all(isinstance(t, _FIXED_WIDTH) for t in types.values())
    if by_hash:
        return _diff_by_hash(left, right, keys, columns, tolerances, with_values, only_differences)
    return _diff_by_value(left, right, keys, columns, tolerances, with_values, only_differences)


def _key_status(differs: Column) -> Column:
    return (
        F.when((F.col("left_rows") > 1) | (F.col("right_rows") > 1), "repeated")
        .when(F.col("right_rows") == 0, "only_left")
        .when(F.col("left_rows") == 0, "only_right")
        .when(differs, "changed")
        .otherwise("same")
    )


def _rows_per_side() -> tuple[Column, Column]:
    return tuple(F.count(_side(s, F.lit(1))).alias(name) for s, name in ((True, "left_rows"), (False, "right_rows")))


def _diff_by_value(left, right, keys, columns, tolerances, with_values, only_differences) -> DataFrame:
    grouped = (
        _both(left, right, [F.col(c) for c in (*keys, *columns)])
        .groupBy(*keys)
        .agg(
            *_rows_per_side(),
            *(F.first(_side(True, F.col(c)), ignorenulls=True).alias(f"left_{c}") for c in columns),
            *(F.first(_side(False, F.col(c)), ignorenulls=True).alias(f"right_{c}") for c in columns),
        )
    )
    single = (F.col("left_rows") == 1) & (F.col("right_rows") == 1)
    kinds = {c: left.schema[c].dataType for c in columns}
    pairs = {c: tuple(comparable(F.col(f"{side}_{c}"), kinds[c]) for side in ("left", "right")) for c in columns}
    changed = F.when(single, changed_columns(pairs, tolerances) if pairs else F.array().cast("array<string>"))
    is_changed = single & (F.size("changed_columns") > 0)
    shown = [F.when(is_changed, F.col(n)).alias(n) for c in columns for n in (f"left_{c}", f"right_{c}")]
    result = grouped.withColumn("changed_columns", changed).select(
        *keys,
        _key_status(F.size("changed_columns") > 0).alias("status"),
        "changed_columns",
        "left_rows",
        "right_rows",
        *(shown if with_values else []),
    )
    return result.filter("status <> 'same'") if only_differences else result


def _diff_by_hash(left, right, keys, columns, tolerances, with_values, only_differences) -> DataFrame:
    hashes = [row_fingerprint(left.schema, columns, seed).alias(f"_hash{seed}") for seed in (0, 1)]
    grouped = (
        _both(left, right, [*(F.col(k) for k in keys), *hashes])
        .groupBy(*keys)
        .agg(
            *_rows_per_side(),
            *(F.min(f"_hash{seed}").alias(f"_low{seed}") for seed in (0, 1)),
            *(F.max(f"_hash{seed}").alias(f"_high{seed}") for seed in (0, 1)),
        )
    )
    differs = (F.col("_low0") != F.col("_high0")) | (F.col("_low1") != F.col("_high1"))
    found = grouped.select(*keys, _key_status(differs).alias("status"), "left_rows", "right_rows")
    if only_differences:
        found = found.filter("status <> 'same'")
    # read three times below, so computed once and kept
    is_changed = F.col("status") == "changed"
    size = F.sum(F.when(is_changed, row_bytes(found.select(*keys))))
    watched, seen = counted(found, n_changed=F.count_if(is_changed), n_bytes=size)
    found = checkpointed(watched)
    suspects = found.filter(is_changed).select(*keys)
    suspects = broadcast_within(suspects, seen.get["n_changed"], seen.get["n_bytes"]).alias("s")

    def rows_of(df: DataFrame) -> DataFrame:
        return df.select(*keys, *columns).alias("d").join(suspects, same_keys("d", "s", keys), "left_semi")

    compared = _diff_by_value(
        rows_of(left), rows_of(right), keys, columns, tolerances, with_values, only_differences
    )
    none = F.when(F.col("status") == "same", F.array().cast("array<string>"))
    settled = found.filter(~is_changed).withColumn("changed_columns", none)
    return compared.unionByName(settled, allowMissingColumns=True)


def bag_diff(left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows whose number of copies differs: ``surplus`` > 0 on the left, < 0 on the right. Both directions in one pass."""
    columns = list(columns or left.columns)
    rows = _both(left, right, [F.col(c) for c in columns])
    maps = {c: rows.schema[c].dataType for c in columns if holds_map(rows.schema[c].dataType)}
    # maps are grouped by their sorted entries
    by = [comparable(F.col(c), maps[c]).alias(f"_by_{c}") if c in maps else F.col(c) for c in columns]
    grouped = rows.groupBy(*by).agg(
        F.sum(F.when(F.col("_is_left"), 1).otherwise(-1)).alias("surplus"), *(F.first(c).alias(c) for c in maps)
    )
    return grouped.filter(F.col("surplus") != 0).select(*columns, "surplus")


# A row with more copies than this is written out by several tasks.
COPIES_PER_TASK = 100_000


def bag_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` that remain after taking away the rows of ``right``, copies counted (``EXCEPT ALL``).

    The copies of a row come from its surplus. Where one row has very many, its copies are dealt to several tasks.
    """
    columns = left.columns
    surplus = bag_diff(left, right).filter(F.col("surplus") > 0)
    ordinary = surplus.filter(F.col("surplus") <= COPIES_PER_TASK).withColumn("_copies", F.col("surplus"))
    first = F.explode(F.sequence(F.lit(0), F.col("surplus") - 1, F.lit(COPIES_PER_TASK).cast("long")))
    hot = (
        surplus.filter(F.col("surplus") > COPIES_PER_TASK)
        .withColumn("_first", first)
        .withColumn("_copies", F.least(F.col("surplus") - F.col("_first"), F.lit(COPIES_PER_TASK)))
        .repartition(row_fingerprint(surplus.schema, columns), "_first")
        .drop("_first")
    )
    copies = F.explode(F.sequence(F.lit(1), F.col("_copies")))
    return ordinary.unionByName(hot).select(*columns, copies.alias("_copy")).drop("_copy")


def schema_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row per column of either side; reads metadata only.

    The status is ``same``, ``only_left``, ``only_right``, ``type_changed`` or ``nullability_changed``.
    """
    sides = [{f.name: (f.dataType.simpleString(), f.nullable) for f in df.schema} for df in (left, right)]

    def status(a: tuple | None, b: tuple | None) -> str:
        if a is None or b is None:
            return "only_right" if a is None else "only_left"
        return "same" if a == b else "type_changed" if a[0] != b[0] else "nullability_changed"

    rows = []
    for name in dict.fromkeys((*sides[0], *sides[1])):
        a, b = sides[0].get(name), sides[1].get(name)
        rows.append((name, *(a or (None, None)), *(b or (None, None)), status(a, b)))
    return left.sparkSession.createDataFrame(
        rows,
        "column_name string, left_type string, left_nullable boolean, right_type string, right_nullable boolean, "
        "status string",
    )


def boundary_counts(df: DataFrame, column: str, start: Day, end: Day) -> DataFrame:
    """One row: how many rows lie on the first day, on the last day, inside, before and after the period."""
    day = F.col(column).cast("date")
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    return df.agg(
        F.count_if(day == first).alias("at_start"),
        F.count_if(day == last).alias("at_end"),
        F.count_if(day.between(first, last)).alias("inside"),
        F.count_if(day < first).alias("before_range"),
        F.count_if(day > last).alias("after_range"),
    )


def null_diff(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs per column on both sides, in one pass over each."""
    counts = _both(left, right, [F.col(c) for c in columns]).agg(
        *(
            F.struct(
                F.count(_side(True, F.when(F.col(c).isNull(), 1))).alias("left_nulls"),
                F.count(_side(False, F.when(F.col(c).isNull(), 1))).alias("right_nulls"),
            ).alias(c)
            for c in columns
        )
    )
    return (
        counts.unpivot([], list(columns), "column_name", "n")
        .select("column_name", "n.left_nulls", "n.right_nulls")
        .withColumn("status", F.when(F.col("left_nulls") == F.col("right_nulls"), "match").otherwise("mismatch"))
    )


def completeness(
    df: DataFrame,
    kept: Column,
    rejected: Mapping[str, Column],
    *,
    amount: str | None = None,
    scale: int | None = None,
) -> DataFrame:
    """Control totals: rows in, rows kept, rows rejected by each rule, and whether they add up.

    A condition that is NULL does not hold. Rules may not overlap: a row counted twice or not at all makes
    ``balanced`` false. With ``amount`` the sum of that column is accounted for in the same way, up to the last digits
    that sums of doubles lose (a relative 1e-9). ``scale`` makes those sums independent of the order of the rows.
    """
    rules = {"kept": kept, **rejected}
    measures = [F.count("*").alias("rows_in")]
    measures += [F.count_if(rule).alias(f"rows_{name}") for name, rule in rules.items()]
    balanced = F.col("rows_in") == reduce(lambda a, b: a + b, (F.col(f"rows_{name}") for name in rules))
    # equal totals can hide a row counted twice next to one not counted
    hits = reduce(lambda a, b: a + b, (F.coalesce(rule.cast("int"), F.lit(0)) for rule in rules.values()))
    measures.append(F.count_if(hits != 1).alias("_unaccounted"))
    if amount:
        number = F.col(amount)
        measures.append(_total(number, scale).alias("amount_in"))
        measures.append(_total(F.abs(number), None).alias("_size"))
        measures += [_total(F.when(rule, number), scale).alias(f"amount_{name}") for name, rule in rules.items()]
        parts = reduce(lambda a, b: a + b, (F.coalesce(f"amount_{name}", F.lit(0.0)) for name in rules))
        whole = F.coalesce("amount_in", F.lit(0.0))
        balanced &= (whole == parts) | (F.abs(whole - parts) <= 1e-9 * F.coalesce("_size", F.lit(0.0)))
    return df.agg(*measures).withColumn("balanced", balanced & (F.col("_unaccounted") == 0)).drop("_unaccounted", "_size")


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row that is the same for every order of the same rows: their number and two sums of their hashes."""
    columns = list(columns or df.columns)
    return df.agg(
        F.count("*").alias("n_rows"),
        *(F.sum(row_fingerprint(df.schema, columns, s).cast("decimal(20,0)")).alias(f"checksum{s}") for s in (0, 1)),
    )


def repeatability(first: DataFrame, second: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: the rows of two runs and whether both are the same bag of rows. Nothing but hashes is shuffled."""
    columns = list(columns or first.columns)
    both = _both(first, second, [F.col(c) for c in columns])
    sums = {
        (is_left, seed): F.sum(_side(is_left, row_fingerprint(both.schema, columns, seed).cast("decimal(20,0)")))
        for is_left in (True, False)
        for seed in (0, 1)
    }
    n_first, n_second = (F.count(_side(is_left, F.lit(1))) for is_left in (True, False))
    identical = n_first == n_second
    for seed in (0, 1):
        identical &= sums[True, seed].eqNullSafe(sums[False, seed])
    return both.agg(n_first.alias("first_rows"), n_second.alias("second_rows"), identical.alias("identical"))


REPORT_COLUMNS = ("check_name", "item", "left_value", "right_value", "status")


def check(name: str, left: Column, right: Column, ok: Column, item: Column | None = None) -> Column:
    """One line of a report as a struct; ``ok`` decides between ``pass`` and ``fail``."""
    text = F.lit(None) if item is None else item
    values = (F.lit(name), text, left, right, F.when(ok, "pass").otherwise("fail"))
    return F.struct(*(v.cast("string").alias(c) for v, c in zip(values, REPORT_COLUMNS, strict=True)))


def checks(df: DataFrame, *lines: Column) -> DataFrame:
    """The given :func:`check` lines of every row of ``df``, below one another."""
    return df.select(F.inline(F.array(*lines)))


def report(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    *,
    value: str | None = None,
    tolerance: float | Mapping[str, float] = 0.0,
    value_tolerance: float = 0.0,
    scale: int | None = None,
) -> DataFrame:
    """One line per check of two tables: schema, row count, NULLs per column, total of ``value``, repeated keys, rows
    that differ.

    ``tolerance`` is for the values of rows, one number or one per column, ``value_tolerance`` for the total of
    ``value``; both are 0 unless given. The rows that differ are found by :func:`keyed_diff` (which reads the tables again
    where it compares by hash), all other figures in one pass over both tables; nothing but the lines of the report leaves
    the executors.
    """
    columns = [c for c in left.columns if c in right.columns]
    schema = schema_diff(left, right).agg(
        F.count("left_type").alias("left_columns"),
        F.count("right_type").alias("right_columns"),
        F.count_if(F.col("status").isin("only_left", "only_right", "type_changed")).alias("n_bad"),
    )

    def pair(name: str, measure, source: Column) -> list[Column]:
        return [measure(_side(True, source)).alias(f"{name}_left"), measure(_side(False, source)).alias(f"{name}_right")]

    def line(name: str, measured: str, ok: Column | None = None, item: Column | None = None) -> Column:
        a, b = F.col(f"{measured}_left"), F.col(f"{measured}_right")
        return check(name, a, b, a == b if ok is None else ok, item)

    measures = pair("rows", F.count, F.lit(1))
    lines = [line("row_count", "rows")]
    for i, column in enumerate(columns):
        measures += pair(f"nulls{i}", F.count, F.when(F.col(column).isNull(), 1))
        lines.append(line("null_count", f"nulls{i}", item=F.lit(column)))
    if value:
        measures += pair("total", lambda v: _total(v, scale), F.col(value))
        close = values_match(F.col("total_left"), F.col("total_right"), value_tolerance)
        lines.append(line("total", "total", close, F.lit(value)))
    whole = _both(left, right, [F.col(c) for c in columns]).agg(*measures)

    def keys_with(*status: str) -> Column:
        return F.count_if(F.col("status").isin(*status))

    differing = keyed_diff(left, right, keys, compare=columns, tolerance=tolerance, only_differences=True)
    by_key = differing.agg(
        F.count_if(F.col("left_rows") > 1).alias("repeated_left"),
        F.count_if(F.col("right_rows") > 1).alias("repeated_right"),
        keys_with("changed", "only_left").alias("differing_left"),
        keys_with("changed", "only_right").alias("differing_right"),
    )
    return reduce(
        DataFrame.unionByName,
        (
            checks(schema, check("schema", F.col("left_columns"), F.col("right_columns"), F.col("n_bad") == 0)),
            checks(whole, *lines),
            checks(
                by_key,
                line("repeated_keys", "repeated", F.col("repeated_left") + F.col("repeated_right") == 0),
                line("differing_rows", "differing", F.col("differing_left") + F.col("differing_right") == 0),
            ),
        ),
    )
