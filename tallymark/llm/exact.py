"""Exact duplicates by composable polynomial fingerprints.

The bytes of a text, A-Z lower-cased, are the coefficients of a polynomial that is evaluated at four points modulo 2^31 - 1.
Such hashes compose: that of ``xy`` is the hash of ``x`` shifted by the length of ``y`` (times the point to that power) plus
the hash of ``y``. So texts are hashed in chunks, and the pieces of a huge text are dealt to many tasks, each shifted by
the bytes behind it, and only summed. Length and the four values are the fingerprint.

Equal fingerprints are no proof. Texts that share one are compared chunk by chunk: for each place of a chunk the smallest
and the largest chunk of the group are kept, row by row and before the shuffle, so that a group of any size sends one row a
task and place. Where both are the same everywhere, all texts of the group are equal. Groups where they differ are grouped
by the chunks themselves.

Null texts are empty, and empty texts are equal to one another. Of equal texts the row with the largest id stays; a null id
is smaller than all others. Exactly one row of a group stays, also where rows are repeated (then any of them, since nothing
tells them apart but other columns). An empty table gives no rows. Other columns may have any name.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallymark.llm.frames import slices
from tallymark.operators.joins import checkpointed_lookup
from tallymark.sources.scope import checkpointed

PRIME = (1 << 31) - 1
CHUNK = 1 << 16  # bytes that are hashed and compared at once; products of this many bytes stay within 64 bits
HUGE = 1 << 23  # texts of more bytes are hashed by many tasks
POINTS = tuple(int(hashlib.sha256(f"point {i}".encode()).hexdigest()[:12], 16) % PRIME for i in range(4))


@functools.lru_cache(4)
def _powers(points: tuple[int, ...]) -> np.ndarray:
    """Descending powers of each point, down to the power 0 of the last byte of a chunk."""
    powers = np.ones((len(points), CHUNK), np.uint64)
    size = 1
    while size < CHUNK:
        shift = np.array([pow(p, size, PRIME) for p in points], np.uint64)[:, None]
        powers[:, size : 2 * size] = powers[:, :size] * shift % PRIME
        size *= 2
    return np.ascontiguousarray(powers[:, ::-1])


def chunk_hash(chunk: bytes, points: tuple[int, ...] = POINTS) -> np.ndarray:
    """Value of a chunk of at most ``CHUNK`` bytes at each point."""
    data = np.frombuffer(chunk, np.uint8).astype(np.uint64)
    return _powers(points)[:, CHUNK - len(data) :] @ data % PRIME


def shifted(value: np.ndarray, n_bytes: int, points: tuple[int, ...] = POINTS) -> np.ndarray:
    """``value`` with ``n_bytes`` more bytes behind it."""
    return value * np.array([pow(p, n_bytes, PRIME) for p in points], np.uint64) % PRIME


def text_hash(data: bytes, points: tuple[int, ...] = POINTS) -> np.ndarray:
    """Value of a text of any length, composed from left to right."""
    total = chunk_hash(data[:CHUNK], points)
    for at in range(CHUNK, len(data), CHUNK):
        chunk = data[at : at + CHUNK]
        total = (shifted(total, len(chunk), points) + chunk_hash(chunk, points)) % PRIME
    return total


def _pieces(data: bytes, size: int) -> list[bytes]:
    return [data[at : at + size] for at in range(0, len(data), size)] or [b""]


def _hashed(rows: DataFrame, points: tuple[int, ...], huge: int, with_chunks: bool) -> DataFrame:
    """``row, n_bytes, hash`` of ``row, text``, the digest, and the chunks or, of huge texts only, the pieces to be hashed."""
    name, size = ("chunks", CHUNK) if with_chunks else ("pieces", min(huge, CHUNK * 16))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data = [(t or b"").lower() for t in batch.column("text").cast(pa.binary()).to_pylist()]
            apart = [not with_chunks and len(d) > huge for d in data]
            hashes = [None if a else text_hash(d, points).tolist() for d, a in zip(data, apart, strict=True)]
            parts = [_pieces(d, size) if with_chunks or a else None for d, a in zip(data, apart, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array(map(len, data), pa.int64()),
                    pa.array(hashes, pa.list_(pa.int64())),
                    pa.array([hashlib.sha256(d).hexdigest() for d in data], pa.string()),
                    pa.array(parts, pa.list_(pa.binary())),
                ],
                ["row", "n_bytes", "hash", "digest", name],
            )

    more = StructType.fromDDL(f"n_bytes long, hash array<long>, digest string, {name} array<binary>")
    return rows.mapInArrow(run, StructType([rows.schema["row"], *more]))


def _hash_pieces(first: DataFrame, points: tuple[int, ...]) -> DataFrame:
    """``spot, hash``: huge texts, their pieces dealt to all tasks and hashed there, shifted and summed."""
    size = F.octet_length(F.element_at("pieces", 1))
    pieces = first.where("pieces is not null").select("spot", "n_bytes", size.alias("size"), F.posexplode("pieces").alias("place", "piece"))
    behind = F.col("n_bytes") - F.col("place") * F.col("size") - F.octet_length("piece")
    dealt = pieces.select("spot", behind.alias("behind"), "piece").repartition("spot", "behind")
    names = [f"h{i}" for i in range(len(points))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "piece"):
            behind = batch.column("behind").to_pylist()
            values = [
                shifted(text_hash(p, points), n, points) for p, n in zip(batch.column("piece").to_pylist(), behind, strict=True)
            ]
            columns = np.array(values, np.uint64).reshape(len(values), len(points)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("spot"), *map(pa.array, columns.T)], ["spot", *names])

    parts = dealt.mapInArrow(run, f"spot long, {', '.join(f'{n} long' for n in names)}")
    # values lie below 2^31, so that sums of 2^32 pieces do not overflow
    return parts.groupBy("spot").agg(F.array(*(F.sum(n) % PRIME for n in names)).alias("hash"))


def _classes(docs: DataFrame, key: str, text: str, carried: Sequence[str], points: tuple[int, ...], huge: int) -> DataFrame:
    """``row`` (``id`` and the carried columns), ``digest``, ``n_bytes``, ``keep_id``, ``group_size``, ``kept`` for every row."""
    row = F.struct(F.col(f"`{key}`").alias("id"), F.struct(*(F.col(f"`{c}`") for c in carried)).alias("own"))
    rows = docs.select(row.alias("row"), F.col(f"`{text}`").alias("text"))
    first = _hashed(rows, points, huge, False).withColumn("spot", F.monotonically_increasing_id())
    first = checkpointed(first)  # from here on a row keeps its number
    if first.where("pieces is not null").limit(1).count():
        whole = _hash_pieces(first, points).withColumnRenamed("hash", "composed")
        first = first.drop("pieces").join(whole, "spot", "left").withColumn("hash", F.coalesce("hash", "composed")).drop("composed")
        first = checkpointed(first)
    else:
        first = first.drop("pieces")
    order = F.struct(F.col("row.id").isNotNull(), F.col("row.id").alias("id"), F.col("spot").alias("spot"))
    groups = first.groupBy("n_bytes", "hash").agg(F.count("*").alias("group_size"), F.max(order).alias("last"))
    groups = checkpointed_lookup(groups.select("n_bytes", "hash", "group_size", "last.id", F.col("last.spot").alias("keep_spot")))

    suspects = checkpointed_lookup(groups.where("group_size > 1").select("n_bytes", "hash"))
    chunked = _hashed(rows, points, huge, True)
    meets = chunked.join(suspects, ["n_bytes", "hash"], "left_semi")
    places = meets.select("n_bytes", "hash", F.posexplode("chunks").alias("place", "chunk"))
    compared = places.groupBy("n_bytes", "hash", "place").agg(F.min("chunk").alias("low"), F.max("chunk").alias("high"))
    collided = checkpointed_lookup(compared.where("low != high").select("n_bytes", "hash").distinct())

    shown = ("row", "digest", "n_bytes", F.col("id").alias("keep_id"), "group_size", (F.col("spot") == F.col("keep_spot")).alias("kept"))
    if not collided.limit(1).count():
        return first.join(groups, ["n_bytes", "hash"]).select(*shown)
    # different texts with one fingerprint: grouped by their chunks
    sound = first.join(collided, ["n_bytes", "hash"], "left_anti").join(groups, ["n_bytes", "hash"]).select(*shown)
    apart = chunked.join(collided, ["n_bytes", "hash"], "left_semi").withColumn("spot", F.monotonically_increasing_id())
    apart = checkpointed(apart)
    own = apart.groupBy("chunks").agg(F.count("*").alias("group_size"), F.max(order).alias("last"))
    own = checkpointed_lookup(own.select("chunks", "group_size", "last.id", F.col("last.spot").alias("keep_spot")))
    return sound.unionByName(apart.join(own, "chunks").select(*shown))


def group(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", points: tuple[int, ...] = POINTS, huge: int = HUGE
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, n_bytes, text_sha256`` for every row, dropped ones too.

    ``keep_id`` is the id of the row of the group that stays; ``text_sha256`` is of the lower-cased text. Other columns are
    not looked at. ``points`` are those of the polynomials, and texts of more than ``huge`` bytes are hashed in pieces.
    """
    found = _classes(docs, key, text, [], points, huge)
    return found.select(
        F.col("row.id").alias("doc_id"), "keep_id", "group_size", "kept", "n_bytes", F.col("digest").alias("text_sha256")
    )


def keep_last(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", points: tuple[int, ...] = POINTS, huge: int = HUGE
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; a copy of the table lies in the shared folder meanwhile."""
    return _classes(docs, key, text, docs.columns, points, huge).where("kept").select("row.own.*")
