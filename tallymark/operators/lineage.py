"""Totals that carry the files they come from.

Files are numbered, and each row of a result holds the set of its files as words of 64 bits: a bitmap that is combined
before the shuffle like the sum itself, and takes 16 bytes for up to 64 neighbouring files. So every total can be traced back
to its files, and those files alone give it again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.functions.numbers import exact_parts, exact_total
from tallymark.operators.joins import broadcast_within, checkpointed_lookup, same_keys
from tallymark.sources.scope import checkpointed

FILE = "_file"


def numbered_files(df: DataFrame) -> DataFrame:
    """``file_no, file`` of the files that ``df``, a table or folder read as it is, has rows from; numbered by name.

    There is a row for each file, so that one task can number them.
    """
    files = df.select(F.col("_metadata.file_path").alias("file")).distinct()
    return checkpointed(files.withColumn("file_no", F.row_number().over(Window.orderBy("file")) - F.lit(1).cast("long")))


def with_file_number(df: DataFrame, files: DataFrame, name: str = FILE) -> DataFrame:
    """``df`` with the number of the file of each row."""
    listed = files.select(F.col("file").alias("_listed"), F.col("file_no").alias(name))
    size = listed.agg(F.count("*").alias("n"), F.sum(F.octet_length("_listed") + 8).alias("bytes")).first()
    listed = broadcast_within(listed, size["n"], size["bytes"])
    return df.withColumn("_path", F.col("_metadata.file_path")).join(listed, F.col("_path") == F.col("_listed")).drop("_path", "_listed")


def traced_totals(
    df: DataFrame, files: DataFrame, keys: Sequence[str], value: str, *, name: str = "total_sales", scale: int = 2
) -> DataFrame:
    """Exact total of ``value`` per key with its ``sources``: words of 64 files, each a ``word`` number and its ``bits``."""
    rows = with_file_number(df, files).select(*keys, F.col(value).alias("_v"), FILE)
    sums = exact_parts(F.col("_v"), scale)
    bit = F.expr(f"shiftleft(1L, cast({FILE} % 64 as int))")
    words = rows.groupBy(*keys, F.expr(f"{FILE} div 64").alias("word")).agg(
        F.bit_or(bit).alias("bits"), *(c.alias(f"_{p}") for p, c in sums.items())
    )
    whole = words.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("sources"), *(F.sum(f"_{p}").alias(f"_{p}") for p in sums)
    )
    return whole.select(*keys, exact_total({p: F.col(f"_{p}") for p in sums}, scale).alias(name), "sources")


def sources_of(totals: DataFrame, files: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``file_no, file`` of every row of ``totals`` (its keys), one row for each file."""
    words = totals.select(*keys, F.inline("sources"))
    places = F.expr("filter(sequence(0, 63), i -> (shiftright(bits, i) & 1L) = 1L)")
    bits = words.select(*keys, "word", F.explode(places).alias("place"))
    numbers = bits.select(*keys, (F.col("word") * 64 + F.col("place")).alias("file_no"))
    return numbers.join(checkpointed_lookup(files), "file_no")


def retraced_totals(
    df: DataFrame, totals: DataFrame, files: DataFrame, keys: Sequence[str], value: str, *, scale: int = 2,
    name: str = "total_sales",
) -> DataFrame:
    """The rows of ``totals`` with ``retraced``, the total of their keys in their source files only, and ``same``."""
    wanted = sources_of(totals, files, keys).select(*(F.col(k).alias(k) for k in keys), F.col("file_no").alias(FILE)).alias("w")
    rows = with_file_number(df, files).alias("d")
    inside = rows.join(wanted, same_keys("d", "w", [*keys, FILE]), "left_semi")
    again = inside.groupBy(*(F.col(f"d.{k}") for k in keys)).agg(_exact(value, scale).alias("retraced")).alias("a")
    figures = totals.alias("t").join(again, same_keys("t", "a", keys), "left")
    return figures.select("t.*", "a.retraced", F.col(f"t.{name}").eqNullSafe(F.col("a.retraced")).alias("same"))


def _exact(value: str, scale: int):
    return exact_total(exact_parts(F.col(f"d.{value}"), scale), scale)
