"""Intermediate results that live as long as a ``with`` block, and where scratch data goes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """Folder shared by driver and executors, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting uses a folder in its warehouse; on a cluster its absence is an error, because
    a machine-local folder would be lost with the machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not (context.master or "").startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            shared = f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
        context.setCheckpointDir(shared)
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once and written to the shared folder: later readers see the same rows even if executors die."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` kept by the executors (spilling to disk) and released at the end, also after an error."""
    df.persist()
    try:
        yield df
    finally:
        df.unpersist()


@contextmanager
def temp_view(df: DataFrame, name: str) -> Iterator[str]:
    """``df`` under a name for SQL, dropped at the end."""
    df.createOrReplaceTempView(name)
    try:
        yield name
    finally:
        df.sparkSession.catalog.dropTempView(name)


def scratch_database(spark: SparkSession, name: str = "tallymark_scratch") -> str:
    """Database whose tables lie in the shared folder; ``DROP DATABASE … CASCADE`` removes it with its files."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{scratch_root(spark)}/{name}'")
    return name


@contextmanager
def _staged(df: DataFrame) -> Iterator[DataFrame]:
    table = f"{scratch_database(df.sparkSession)}.held_{uuid.uuid4().hex}"
    df.write.saveAsTable(table)
    try:
        yield df.sparkSession.table(table)
    finally:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")


@contextmanager
def held(df: DataFrame, how: str = "checkpoint") -> Iterator[DataFrame]:
    """``df`` computed once for several uses.

    ``checkpoint`` and ``table`` write it to the shared folder, so that a lost executor cannot make two uses differ
    (a recomputed sum of doubles may differ in its last digits); ``table`` drops its copy at the end. ``cache`` is the
    light form for small jobs.
    """
    if how == "checkpoint":
        yield checkpointed(df)
    elif how == "table":
        with _staged(df) as rows:
            yield rows
    elif how == "cache":
        with cached(df) as rows:
            yield rows
    else:
        raise ValueError(f"unknown way to hold a result: {how!r}")
