"""Small helpers of this package: column names that clash with nothing, reading a table, shipping texts to Python."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def importable(spark: SparkSession) -> None:
    """Let Python workers find this library where the driver found it, unless it is installed there anyway."""
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


_KEPT: dict[tuple, Any] = {}


def kept_in_worker(name: tuple, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps from one task to the next: one object at a time, whichever operator it belongs to."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = make()
    return _KEPT[name]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so (Spark compares without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept back from training: crc32 of its id as text, modulo 3, is 1 (a null id is trained on)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch; null is the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str, max_chars: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``max_chars`` bytes of ``column`` at most, or a single longer row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = total = 0
        for i, size in enumerate(sizes):
            if total and total + size > max_chars:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(size)
        if start < len(sizes):
            yield batch.slice(start)
    pa.default_memory_pool().release_unused()
