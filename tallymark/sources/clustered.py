"""Tables whose files and row groups can be skipped by any of several columns.

Files sorted by one column help filters on that column only. Here each column is cut at quantiles to ranges of like many
rows, the numbers of a row's ranges are interleaved bit by bit, and rows are sorted by the result: neighbours have
neighbouring values in every column, so that the statistics of a row group are narrow in all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType, TimestampNTZType, TimestampType

from tallymark.functions.size import row_bytes
from tallymark.sources.writers import writing

#: Ranges of a column are two to this power.
BITS = 6
FILE_BYTES = 256 * 1024 * 1024


def _number(value: Column, kind: DataType) -> Column:
    """A double in the order of the values: of texts the first six bytes."""
    if isinstance(kind, StringType):
        return F.conv(F.rpad(F.hex(F.substring(value.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    return value.cast("double")


def _rank(number: Column, bounds: Column) -> Column:
    return F.coalesce(F.size(F.filter(bounds, lambda bound: bound < number)), F.lit(0)).cast("long")


def interleaved(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """Number of each row by the interleaved numbers of its ranges; NULLs lie in the first range.

    One pass finds the quantiles of all columns, one sketch of fixed size a task.
    """
    numbers = {c: _number(F.col(f"`{c}`"), df.schema[c].dataType) for c in columns}
    cuts = [i / (1 << bits) for i in range(1, 1 << bits)]
    sketches = (F.percentile_approx(n, F.array(*map(F.lit, cuts)), F.lit(1000)).alias(f"q{i}") for i, n in enumerate(numbers.values()))
    found = df.agg(*sketches).first()
    place = F.lit(0).cast("long")
    for i, number in enumerate(numbers.values()):
        bounds = F.array(*map(F.lit, sorted(set(found[i] or [])))).cast("array<double>")
        rank = _rank(number, bounds)
        for bit in range(bits):
            place = place + F.shiftleft(F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("long")), bit * len(columns) + i)
    return place


def write_clustered(
    df: DataFrame,
    table: str,
    columns: Sequence[str],
    *,
    files: int | None = None,
    bits: int = BITS,
    mode: str = "overwrite",
    row_group_bytes: int | None = None,
) -> None:
    """Save ``df`` clustered by up to nine columns in ``files`` files, by default as many as its size asks for.

    Rows of one place are dealt to several files where they are many: a value that holds a third of a table makes no large task.
    """
    if not 1 <= len(columns) * bits <= 60:
        raise ValueError("columns times bits must be 1 to 60")
    files = files or max(1, -(-(df.agg(F.sum(row_bytes(df))).first()[0] or 0) // FILE_BYTES))
    placed = df.withColumns({"_place": interleaved(df, columns, bits), "_deal": F.xxhash64(F.monotonically_increasing_id())})
    rows = placed.repartitionByRange(files, "_place", "_deal").sortWithinPartitions("_place").drop("_place", "_deal")
    options = {} if row_group_bytes is None else {"parquet.block.size": str(row_group_bytes)}
    with writing(df.sparkSession, table):
        rows.write.mode(mode).options(**options).saveAsTable(table)
