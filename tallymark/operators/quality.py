"""Data-quality measures of one table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallymark.functions.dates import is_iso_date
from tallymark.functions.numbers import exact_sum, safe_number
from tallymark.functions.text import code_of, is_multibyte, words_in
from tallymark.operators.joins import checkpointed_lookup, same_keys


class MissingColumns(ValueError):
    """Required columns are absent."""


def missing_columns(df: DataFrame, *names: str) -> list[str]:
    """Those of ``names`` that ``df`` does not have."""
    return [name for name in names if name not in df.columns]


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """``df`` itself, or :class:`MissingColumns` before any job starts."""
    missing = missing_columns(df, *names)
    if missing:
        raise MissingColumns(f"missing columns: {', '.join(missing)}; present: {', '.join(df.columns)}")
    return df


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows and NULLs per column, from one pass over the table."""
    columns = list(columns or df.columns)
    nulls = df.agg(F.count("*").alias("n_rows"), *(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return nulls.unpivot("n_rows", columns, "column_name", "n_nulls").select("column_name", "n_rows", "n_nulls")


def column_profile(df: DataFrame, column: str, *, exact: bool = True, scale: int | None = None, round_to: int = 4) -> DataFrame:
    """One row: values, distinct values, extremes and mean of a numeric column.

    ``exact=False`` estimates the distinct values, which saves a shuffle of all of them on large tables. ``scale`` makes
    the mean independent of the order of the rows.
    """
    value = F.col(column)
    total = F.sum(value) if scale is None else exact_sum(value, scale)
    mean = total.cast("double") / F.nullif(F.count(value), F.lit(0))
    return df.agg(
        F.count(value).alias("n"),
        (F.count_distinct(value) if exact else F.approx_count_distinct(value)).alias("n_distinct"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.round(mean, round_to).alias("mean_value"),
    )


def table_profile(df: DataFrame, columns: Sequence[str] | None = None, *, exact: bool = False) -> DataFrame:
    """One row per column: rows, NULLs, distinct values, extremes (as text) and the mean where numeric.

    One pass and one row per task through the shuffle, whatever the number of columns. The distinct values are estimates
    then; ``exact`` counts them, which shuffles each distinct value of each column. It counts column by column, each in a
    pass over that column alone: in one pass Spark makes a wide row of each value and sorts all of them within a task.
    """
    columns = list(columns or df.columns)
    numeric = ("byte", "short", "integer", "long", "float", "double", "decimal")

    def measures(name: str) -> Column:
        value = F.col(name)
        is_number = df.schema[name].dataType.typeName() in numeric
        # not count_distinct, which Spark would gather into one pass again
        distinct = df.select(value).distinct().agg(F.count(value)).scalar() if exact else F.approx_count_distinct(value)
        return F.struct(
            F.count("*").alias("n_rows"),
            F.count_if(value.isNull()).alias("n_nulls"),
            distinct.alias("n_distinct"),
            F.min(value).cast("string").alias("min_value"),
            F.max(value).cast("string").alias("max_value"),
            (F.avg(value).cast("double") if is_number else F.lit(None).cast("double")).alias("mean_value"),
        ).alias(name)

    return df.agg(*(measures(c) for c in columns)).unpivot([], columns, "column_name", "m").select("column_name", "m.*")


def duplicates(df: DataFrame, keys: Sequence[str], *, name: str = "n") -> DataFrame:
    """Keys that occur more than once, with their number. Copies are counted before the shuffle."""
    return df.groupBy(*keys).agg(F.count("*").alias(name)).filter(F.col(name) > 1)


def align(df: DataFrame, schema: StructType, *, keep_extra: bool = False) -> DataFrame:
    """``df`` in the columns, order and types of ``schema``: absent columns become NULL, others are dropped or kept."""
    have = {name.lower(): name for name in df.columns}
    wanted = [
        (F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ]
    names = {f.name.lower() for f in schema}
    extra = [F.col(f"`{name}`") for key, name in have.items() if key not in names]
    return df.select(*wanted, *(extra if keep_extra else []))


def aligned_union(schema: StructType, *frames: DataFrame) -> DataFrame:
    """All rows of several versions of a table in the shape of ``schema``."""
    return reduce(DataFrame.unionByName, (align(df, schema) for df in frames))


def split_by_type(df: DataFrame, column: str, to: str = "double") -> tuple[DataFrame, DataFrame]:
    """Rows whose text casts (cast done; NULL stays NULL) and rows whose text does not (unchanged)."""
    number = safe_number(F.col(column), to)
    rejected = F.col(column).isNotNull() & number.isNull()
    return df.filter(~rejected).withColumn(column, number), df.filter(rejected)


def type_conformity(df: DataFrame, column: str, to: str = "double") -> DataFrame:
    """One row: rows, rows that cast, rows that do not (NULL counts as not)."""
    number = safe_number(F.col(column), to)
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count(number).alias("n_valid"),
        F.count_if(number.isNull()).alias("n_rejected"),
    )


def date_conformity(df: DataFrame, column: str) -> DataFrame:
    """One row: how many values are ``yyyy-MM-dd`` dates and how many are not."""
    valid = is_iso_date(F.col(column))
    return df.agg(F.count_if(valid).alias("n_valid"), F.count_if(~valid).alias("n_invalid"))


def outliers(df: DataFrame, keys: Sequence[str], value: str, z: float = 3.0) -> DataFrame:
    """Rows further than ``z`` sample standard deviations from the mean of their group.

    Mean and deviation are computed once per group and kept in the shared folder; a window would bring a whole group to
    one task. They are broadcast if checked to be small, so that the rows themselves are not shuffled; beyond the bound
    the join is shuffled and adaptive execution splits the hot groups.
    """
    moments = df.groupBy(*keys).agg(F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_deviation"))
    rows, groups = df.alias("d"), checkpointed_lookup(moments).alias("g")
    far = F.abs(F.col(f"d.{value}") - F.col("g._mean")) > F.lit(z) * F.col("g._deviation")
    return rows.join(groups, same_keys("d", "g", keys)).filter(far).select("d.*")


#: Half the width of the band around the middle rank that is looked at exactly, and the inverse error of the sketch.
_BAND, _ACCURACY = 0.0005, 10_000


def exact_medians(df: DataFrame, keys: Sequence[str], value: str, name: str = "median") -> DataFrame:
    """Exact median of ``value`` per group, without sorting or collecting a group.

    A quantile sketch, combined before the shuffle, gives two values of each group close below and above the middle. A
    second pass counts what lies below the lower one and each distinct value between the two, and the ranks of that narrow
    band give the median: the mean of the two middle values for an even number. NULL and NaN are left out; a group of
    nothing else has no median. Where a sketch should miss its bound, the group is computed by the built-in percentile.
    """
    number = F.col(value).cast("double")
    rows = df.select(*keys, number.alias("_v")).where(~F.isnan("_v") & F.col("_v").isNotNull())
    ends = F.percentile_approx("_v", F.array(F.lit(0.5 - _BAND), F.lit(0.5 + _BAND)), F.lit(_ACCURACY))
    groups = checkpointed_lookup(rows.groupBy(*keys).agg(F.count("*").alias("_n"), ends.alias("_ends"))).alias("g")
    near = rows.alias("d").join(groups, same_keys("d", "g", keys)).where(F.col("_v") <= F.col("_ends")[1])
    spot = F.when(F.col("_v") >= F.col("_ends")[0], F.col("_v"))  # NULL, which sorts first, for all below the band
    counts = near.groupBy(*(F.col(f"d.{k}") for k in keys), spot.alias("_spot"), "_n").agg(F.count("*").alias("_c"))
    upto = F.sum("_c").over(Window.partitionBy(*keys).orderBy(F.asc_nulls_first("_spot")))
    ranked = counts.withColumn("_upto", upto)

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_upto") >= rank) & (F.col("_upto") - F.col("_c") < rank), F.col("_spot")))

    low, high = F.expr("(_n + 1) div 2"), F.expr("_n div 2 + 1")
    found = checkpointed_lookup(ranked.groupBy(*keys).agg((at(low) / 2 + at(high) / 2).alias(name)))
    missed = groups.join(found.where(F.col(name).isNotNull()).alias("f"), same_keys("g", "f", keys), "left_anti")
    missed = checkpointed_lookup(missed.select(*(F.col(f"g.{k}") for k in keys)))
    if not missed.limit(1).count():
        return found
    again = rows.alias("d").join(missed.alias("m"), same_keys("d", "m", keys), "left_semi")
    return found.where(F.col(name).isNotNull()).unionByName(again.groupBy(*keys).agg(F.percentile("_v", F.lit(0.5)).alias(name)))


#: Fixed value: the median absolute deviation of a normal distribution in standard deviations.
NORMAL_MAD = 0.6745


def robust_outliers(df: DataFrame, keys: Sequence[str], value: str, cutoff: float = 3.5) -> DataFrame:
    """Rows whose distance to the median of their group is more than ``cutoff`` times its median absolute deviation.

    The deviation is scaled to that of a normal distribution. Unlike mean and standard deviation, both medians stay where
    they are when a few values are huge, so one cannot hide another; both are exact (:func:`exact_medians`). Where more
    than half of a group have one value, the deviation is 0 and every other value is an outlier.
    """
    medians = exact_medians(df, keys, value, "_median").alias("g")
    far = F.abs(F.col(f"d.{value}").cast("double") - F.col("g._median"))
    apart = df.alias("d").join(medians, same_keys("d", "g", keys)).select("d.*", far.alias("_far"))
    deviations = exact_medians(apart, keys, "_far", "_mad").alias("m")
    joined = apart.alias("d").join(deviations, same_keys("d", "m", keys))
    return joined.where(F.lit(NORMAL_MAD) * F.col("_far") > F.lit(cutoff) * F.col("_mad")).select(*(f"d.{c}" for c in df.columns))


def text_encoding(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Texts, texts with multi-byte characters and texts that are not valid UTF-8, per group."""
    text = F.col(column)
    return df.groupBy(*by).agg(
        F.count("*").alias("n_docs"),
        F.count_if(is_multibyte(text)).alias("n_multibyte"),
        F.count_if(~F.is_valid_utf8(text)).alias("n_invalid"),
    )


# The words that are counted in a script, by measure.
SCRIPT_WORDS = {
    "n_select": ("select",),
    "n_insert": ("insert",),
    "n_create": ("create",),
    "n_drop": ("drop",),
    "n_join": ("join",),
    "n_aggregate": ("sum", "count", "avg", "min", "max"),
    "n_condition": ("where", "having", "case", "if", "while"),
}
TEMPORARY_TABLE = r"create\s+temporary\s+table"
TABLE_AFTER = r"(?i)(?<![A-Za-z0-9_])(?:from|join|into|table)\s+([A-Za-z_][A-Za-z0-9_.]*)"


def script_metrics(df: DataFrame, text: str = "text", *, code_only: bool = False) -> DataFrame:
    """The columns of ``df`` other than ``text`` plus counts of what each script holds: lines, statements, tables.

    One search finds all words that any measure counts, a second one the names of the tables. With ``code_only`` comments and
    quoted texts are taken out first, so that a word in them is no statement; lines are counted of the whole script.
    """
    lines = F.col(text)
    script = code_of(lines) if code_only else lines
    words = "|".join(word for group in SCRIPT_WORDS.values() for word in group)
    found = df.select(
        *(c for c in df.columns if c != text),
        (F.length(lines) - F.length(F.replace(lines, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        words_in(script, f"{TEMPORARY_TABLE}|{words}").alias("_words"),
        F.transform(F.regexp_extract_all(script, F.lit(TABLE_AFTER), F.lit(1)), F.lower).alias("_tables"),
    )

    def count(words: Column, group: Sequence[str]) -> Column:
        return F.size(F.filter(words, lambda word: word.isin(*group))).cast("long")

    # the phrase is found as a whole and counts by its first word as well
    first = F.transform("_words", lambda found: F.regexp_extract(found, "^[a-z]+", 0))
    counts = {name: count(first, group) for name, group in SCRIPT_WORDS.items()}
    counts["n_temporary"] = F.size(F.filter("_words", lambda found: found.contains("temporary"))).cast("long")
    counts["n_tables"] = F.size(F.array_distinct("_tables")).cast("long")
    return found.withColumns(counts).drop("_words", "_tables")
