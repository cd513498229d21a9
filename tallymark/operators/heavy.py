"""Bucketed tables whose heavy keys lie apart.

A bucketed join has no shuffle, and nothing can split a bucket: a key that holds a third of a table makes one task of a third
of all rows. So keys above a share of a table are found by a sketch of frequent values in one pass and kept in a table
of their own, without buckets. Light keys meet in the bucketed join; heavy ones, of which there are few, are joined
by broadcasting the other side's rows of these keys, or by salting where those are many.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.operators.joins import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS, fits_broadcast
from tallymark.sources.writers import buckets_for, write_bucketed, writing

#: Share of a table from which a key is heavy, and values that the sketch follows: the error of a count is below 1/7,500 of all.
SHARE, TRACKED = 0.01, 10_000
SALTS = 64
HEAVY = "_heavy"


def heavy_keys(df: DataFrame, key: str, share: float = SHARE, tracked: int = TRACKED) -> list[Any]:
    """The keys, at most ``1 / share`` and a few more, that hold at least ``share`` of the rows of ``df``; NULL is not one.

    One pass and one sketch a task. The sketch never misses a key whose share is above its own error, and may name one
    that is just below ``share``.
    """
    most = int(1 / share) + 1
    found = df.agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k(`{key}`, {most}, {max(tracked, most)})").alias("top")
    ).first()
    slack = found["n"] / (0.75 * max(tracked, most))
    return [t["item"] for t in found["top"] or [] if t["item"] is not None and t["count"] + slack >= share * found["n"] > 0]


def write_apart(
    frames: Mapping[str, DataFrame], by: str, *, share: float = SHARE, buckets: int | None = None, mode: str = "overwrite"
) -> list[Any]:
    """Save tables that are to be joined on ``by``, each as a bucketed table and a plain one, ``<name>_heavy``.

    A key that is heavy in one of them is kept apart in all. Returns these keys.
    """
    heavy = sorted({k for df in frames.values() for k in heavy_keys(df, by, share)})
    is_heavy = F.coalesce(F.col(by).isin(heavy), F.lit(False)) if heavy else F.lit(False)
    buckets = buckets or max(buckets_for(df.where(~is_heavy)) for df in frames.values())
    for name, df in frames.items():
        write_bucketed(df.where(~is_heavy), name, by, buckets, mode=mode)
        with writing(df.sparkSession, f"{name}{HEAVY}"):
            df.where(is_heavy).write.mode(mode).saveAsTable(f"{name}{HEAVY}")
    return heavy


def salted_join(left: DataFrame, right: DataFrame, key: str, salts: int = SALTS) -> DataFrame:
    """Inner join of many rows of few keys: rows of ``left`` are dealt to ``salts`` groups, those of ``right`` go to each.

    Rows are dealt by their place in the partition, so that a repeated task deals them alike and equal rows are spread.
    """
    dealt = left.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(copies, [key, "_salt"]).drop("_salt")


def join_apart(
    spark: SparkSession,
    left: str,
    right: str,
    by: str,
    *,
    columns: Sequence[str] | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """Inner join of two tables written together by :func:`write_apart`.

    Of the two tables of heavy keys the smaller is broadcast if it is proven to fit, else the larger is salted.
    """
    light = spark.table(left).join(spark.table(right), by)
    sides = [spark.table(f"{name}{HEAVY}") for name in (left, right)]
    sizes = [df.count() for df in sides]  # read from the footers
    small, large = (sides[1], sides[0]) if sizes[1] <= sizes[0] else (sides[0], sides[1])
    if fits_broadcast(small, max_rows, max_bytes):
        heavy = large.join(F.broadcast(small), by)
    else:
        heavy = salted_join(large, small, by, salts)
    wanted = list(columns or light.columns)
    return light.select(*wanted).unionByName(heavy.select(*wanted))
