"""Sinks. Every append goes through Spark's own writers; nothing passes through the driver."""

from __future__ import annotations

import uuid
from collections.abc import Collection, Iterator, Sequence
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NullType,
    ShortType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from tallymark.functions.size import row_bytes
from tallymark.sources.catalog import partition_spec
from tallymark.sources.scope import temp_view

_INTEGERS = [ByteType(), ShortType(), IntegerType(), LongType()]
_INTEGER_DIGITS = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 19}
_LOSSLESS = {
    (FloatType(), DoubleType()),
    (DateType(), TimestampType()),
    (DateType(), TimestampNTZType()),
    # every integer of up to 24 (53) bits is exact in a FLOAT (DOUBLE)
    (ByteType(), FloatType()),
    (ShortType(), FloatType()),
    (ByteType(), DoubleType()),
    (ShortType(), DoubleType()),
    (IntegerType(), DoubleType()),
}


class UnsafeInsert(ValueError):
    """The rows do not fit the target table without a loss."""


def _fits(source: DataType, target: DataType) -> bool:
    if source == target or isinstance(source, NullType) or (source, target) in _LOSSLESS:
        return True
    if source in _INTEGERS and target in _INTEGERS:
        return _INTEGERS.index(source) <= _INTEGERS.index(target)
    if isinstance(target, DecimalType):
        room = target.precision - target.scale
        if source in _INTEGERS:
            return _INTEGER_DIGITS[source] <= room
        if isinstance(source, DecimalType):
            return source.scale <= target.scale and source.precision - source.scale <= room
    # for structs, arrays and maps only the nullability may differ
    return source.simpleString() == target.simpleString()


def fit_to_table(
    df: DataFrame, table: str, *, allow_narrowing: bool = False, given: Collection[str] = ()
) -> DataFrame:
    """``df`` in the columns, order and types of ``table`` without the partition columns ``given`` otherwise.

    Reads no data: a missing table, missing or extra columns and narrowing raise at once.
    """
    target = [field for field in df.sparkSession.table(table).schema if field.name not in given]
    have = {field.name.lower(): field for field in df.schema}
    wanted = {field.name.lower() for field in target}
    missing = [field.name for field in target if field.name.lower() not in have]
    extra = [field.name for field in df.schema if field.name.lower() not in wanted]
    if missing or extra:
        raise UnsafeInsert(f"columns do not match {table}: missing {missing}, not in the table {extra}")
    narrowed = [
        f"{field.name} {have[field.name.lower()].dataType.simpleString()} -> {field.dataType.simpleString()}"
        for field in target
        if not _fits(have[field.name.lower()].dataType, field.dataType)
    ]
    if narrowed and not allow_narrowing:
        raise UnsafeInsert(f"insert into {table} would narrow {', '.join(narrowed)}")
    return df.select(*(F.col(f"`{field.name}`").cast(field.dataType).alias(field.name) for field in target))


_LOCKS: dict[str, Lock] = {}


@contextmanager
def writing(spark: SparkSession, table: str) -> Iterator[None]:
    """One writer per table and driver at a time.

    Spark's file committer keeps the unfinished files of all appends to a table in one folder and removes it at the end
    of each, so two of them at once could lose each other's files. Several drivers need a lock of their own, or tables
    of their own.
    """
    name = table if "." in table else f"{spark.catalog.currentDatabase()}.{table}"
    with _LOCKS.setdefault(name.replace("`", "").lower(), Lock()):
        yield


def append_by_name(df: DataFrame, table: str, *, allow_narrowing: bool = False) -> None:
    """Append to an existing table, matching columns by name. Into a delimited table no text with a line break goes: it raises.

    ``insertInto`` itself matches by position and narrows DOUBLE to FLOAT without a word. Here columns are put in
    the table's order first; missing, extra or narrowed columns raise :class:`UnsafeInsert`. For a partitioned table
    this is also the dynamic-partition insert: the partition value comes with each row.
    """
    rows = fit_to_table(df, table, allow_narrowing=allow_narrowing)
    if _provider(df.sparkSession, table) == "csv":
        rows = _single_lines(rows, table)
    with writing(df.sparkSession, table):
        rows.write.mode("append").insertInto(table)


def _provider(spark: SparkSession, table: str) -> str | None:
    about = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Provider'").first()
    return about and about["data_type"].lower()


def _single_lines(df: DataFrame, table: str) -> DataFrame:
    """``df``, whose texts raise when they are written if they hold a line break: the table could not be read any more."""
    broken = F.raise_error(F.lit(f"a text with a line break cannot be stored in the delimited table {table}"))
    texts = {f.name: F.col(f"`{f.name}`") for f in df.schema if isinstance(f.dataType, StringType)}
    return df.withColumns({n: F.when(~c.rlike("[\n\r]") | c.isNull(), c).otherwise(broken.cast("string")) for n, c in texts.items()})


def append_or_create(df: DataFrame, table: str) -> None:
    """Append by name; the first call creates the table."""
    with writing(df.sparkSession, table):
        df.write.mode("append").saveAsTable(table)


@contextmanager
def _session_option(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def replace_partitions(df: DataFrame, table: str, *, allow_narrowing: bool = False) -> None:
    """Replace just those partitions of ``table`` that occur in ``df``, so that a job can be run again safely.

    ``insertInto`` takes no write options, so the mode is set on the session for the time of the write; do not run other
    overwrites in the same session meanwhile.
    """
    rows = fit_to_table(df, table, allow_narrowing=allow_narrowing)
    option = _session_option(df.sparkSession, "spark.sql.sources.partitionOverwriteMode", "dynamic")
    with writing(df.sparkSession, table), option:
        rows.write.mode("overwrite").insertInto(table)


def replace_partition(df: DataFrame, table: str, *, allow_narrowing: bool = False, **values: str) -> None:
    """Replace one partition of ``table``, given by the values of its partition columns, by the rows of ``df``.

    ``df`` does not have these columns. An empty ``df`` leaves an empty partition.
    """
    rows = fit_to_table(df, table, allow_narrowing=allow_narrowing, given=values)
    with temp_view(rows, f"new_rows_{uuid.uuid4().hex}") as view, writing(df.sparkSession, table):
        columns = ", ".join(f"`{name}`" for name in rows.columns)
        df.sparkSession.sql(f"INSERT OVERWRITE TABLE {table} {partition_spec(values)} SELECT {columns} FROM {view}")


def create_empty_table(
    spark: SparkSession, table: str, schema: StructType | str, partition_by: Sequence[str] = ()
) -> None:
    """(Re-)create ``table`` with this schema and no rows."""
    writer = spark.createDataFrame([], schema).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def write_partitioned(
    df: DataFrame, table: str, by: Sequence[str], *, mode: str = "overwrite", compact: bool = False
) -> None:
    """Save as a table with one directory per value of ``by``.

    By default there is no shuffle: each task writes its own file into each directory it meets, which suits few
    partition values and takes a hot one in parallel. With many values that means many small files; ``compact`` then
    asks for a rebalance by the partition columns, which adaptive execution splits where one value is hot.
    """
    rows = df.hint("rebalance", *by) if compact else df
    rows.write.mode(mode).partitionBy(*by).saveAsTable(table)


BUCKET_BYTES = 256 * 1024 * 1024


def buckets_for(df: DataFrame, bucket_bytes: int = BUCKET_BYTES, least: int = 1) -> int:
    """How many buckets a table needs for about ``bucket_bytes`` each; measures the rows, one number per task.

    Tables that are joined on their buckets need the same number: take that of the larger one.
    """
    return max(least, -(-(df.agg(F.sum(row_bytes(df))).first()[0] or 0) // bucket_bytes))


def write_bucketed(
    df: DataFrame,
    table: str,
    by: str,
    buckets: int | None = None,
    *,
    sort_by: str | None = None,
    mode: str = "overwrite",
    gather: bool = True,
) -> None:
    """Save as a bucketed table; two tables with equal bucketing join on ``by`` without a shuffle.

    Without ``buckets`` their number follows from the size of ``df``. By default the rows of a bucket are gathered by a
    rebalance, so that there are about as many files as buckets; adaptive execution splits it where a key is hot, so a
    hot bucket is written by several tasks. ``gather=False`` shuffles nothing, and each task writes its own file per
    bucket: only for few tasks. A key that holds much of a table makes its bucket as large, and bucketed reads cannot
    split it: join such tables by the plain join, which adaptive execution splits.
    """
    buckets = buckets or buckets_for(df)
    rows = df.hint("rebalance", buckets, by) if gather else df
    rows.write.mode(mode).bucketBy(buckets, by).sortBy(sort_by or by).saveAsTable(table)
