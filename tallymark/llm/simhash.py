"""Near-duplicates by 64-bit SimHash fingerprints, found with anchor-point covering.

The anchors are the words of a covering code: every fingerprint lies within the covering radius of one anchor, its home.
If two fingerprints differ in ``t`` bits, the home of one is within radius plus ``t`` of the other. So each fingerprint is
sent to its home, and as a copy to every anchor within that distance, and fingerprints meet copies per anchor.

The code is the product of two perfect Golay codes of 23 bits (4,096 words each, radius 3) over 46 of the 64 bits, so
there are 2^24 anchors. The excess over the radius is counted in each half, and only copies whose excesses add up to at
most ``t`` are made: exactly those anchors that are home to some fingerprint within ``t`` bits. That is about 61 copies
for ``t`` = 2, whatever the data.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.frames import slices, texts
from tallymark.llm.graph import components
from tallymark.operators.joins import checkpointed_lookup
from tallymark.sources.scope import checkpointed

HALF_BITS, RADIUS = 23, 3
GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 generates the Golay code

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_COLUMNS = np.arange(8, dtype=np.int64) * 256


def fingerprint(text: str, words: int = 3, seed: int = 42, step: int = 100_000) -> int:
    """SimHash of the ``words``-word shingles of a text, as a signed 64-bit number; 0 if it has no word.

    A-Z are lower-cased and words are what lies between ASCII white space. Shingles count as often as they occur; a text of
    fewer words is one shingle.
    """
    parts = text.encode().lower().split()
    if not parts:
        return 0
    parts = parts if len(parts) >= words else [b" ".join(parts)]
    size = min(words, len(parts))
    n = len(parts) - size + 1
    seen = np.zeros(2048, np.int64)
    for start in range(0, n, step):
        stop = min(n, start + step)
        shingles = map(b" ".join, zip(*(parts[start + i : stop + i] for i in range(size)), strict=True))
        digests = np.frombuffer(b"".join(map(xxhash.xxh64_digest, shingles, repeat(seed))), np.uint8)
        seen += np.bincount((digests.reshape(-1, 8) + _COLUMNS).ravel(), minlength=2048)
    ones = (seen.reshape(8, 256) @ _BYTE_BITS).ravel()
    return int(np.packbits(ones * 2 > n).view(">i8")[0])


def fingerprints(docs: DataFrame, *, text: str = "text", words: int = 3) -> DataFrame:
    """``docs`` without ``text``, with its fingerprint as ``simhash`` (a null text is empty); such a column is replaced."""
    kept = [c for c in docs.columns if c != text and c.lower() != "simhash"]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            prints = pa.array([fingerprint(t, words) for t in texts(batch, "text")], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("row"), prints], ["row", "simhash"])

    out = rows.mapInArrow(run, rows.select("row", F.lit(0).cast("long").alias("simhash")).schema)
    return out.select(*(F.col("row").getField(c).alias(c) for c in kept), "simhash")


@functools.lru_cache(1)
def golay_homes() -> np.ndarray:
    """Number of the nearest code word for each word of 23 bits."""
    codes = np.zeros(4096, np.int64)
    for bit in range(12):
        codes ^= np.where(np.arange(4096) >> bit & 1, GENERATOR << bit, 0)
    homes = np.zeros(1 << HALF_BITS, np.uint16)
    for errors in range(RADIUS + 1):
        for places in combinations(range(HALF_BITS), errors):
            homes[codes ^ sum(1 << p for p in places)] = np.arange(4096)
    return homes


@functools.lru_cache(4)
def _flips(weight: int) -> np.ndarray:
    return np.array([sum(1 << p for p in places) for places in combinations(range(HALF_BITS), weight)], np.int64)


def _homes_at(half: np.ndarray, distance: int) -> list[np.ndarray]:
    """For each fingerprint half, the homes of the words at each distance of up to ``distance``."""
    homes = golay_homes()
    return [homes[half[:, None] ^ _flips(d)[None]].astype(np.int64) for d in range(distance + 1)]


def anchors(prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Home of each fingerprint, and the anchors that get a copy as one row for each (place in ``prints``, anchor)."""
    low, high = (prints >> shift & (1 << HALF_BITS) - 1 for shift in (0, HALF_BITS))
    lows, highs = _homes_at(low, distance), _homes_at(high, distance)
    place = np.arange(len(prints), dtype=np.int64)[:, None] << 24
    found = []
    for i in range(distance + 1):
        for j in range(distance + 1 - i):
            a, b = _few(lows[i]), _few(highs[j])
            both = (place[:, :, None] + (a[:, :, None] << 12) + b[:, None, :]).ravel()
            wanted = ((a >= 0)[:, :, None] & (b >= 0)[:, None, :]).ravel()
            found.append(np.unique(both[wanted]))
    return (lows[0][:, 0] << 12) + highs[0][:, 0], np.unique(np.concatenate(found))


def _few(homes: np.ndarray) -> np.ndarray:
    """The distinct values of each row first, -1 after them, in as few columns as they need."""
    ordered = np.sort(homes, axis=1)
    ordered[:, 1:][ordered[:, 1:] == ordered[:, :-1]] = -1
    ordered = -np.sort(-ordered, axis=1)
    return ordered[:, : max(1, int((ordered >= 0).sum(axis=1).max(initial=0)))]


def close_pairs(prints: DataFrame, distance: int = 2) -> DataFrame:
    """Pairs ``a < b`` of the distinct ``simhash`` values of ``prints`` that differ in at most ``distance`` bits, once each.

    A fingerprint has at most C(64, 1) + C(64, 2) others within two bits, so that there are never all pairs of a group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                home, copies = anchors(part.column("simhash").to_numpy(), distance)
                place, anchor = copies >> 24, (copies & (1 << 24) - 1).astype(np.int32)
                ends = np.searchsorted(place, np.arange(1, part.num_rows + 1))
                lists = pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), pa.array(anchor))
                columns = [part.column("simhash"), pa.array(home.astype(np.int32)), lists]
                yield pa.RecordBatch.from_arrays(columns, ["simhash", "home", "copies"])

    placed = checkpointed(prints.select("simhash").mapInArrow(run, "simhash long, home int, copies array<int>"))
    homes = placed.select(F.col("home").alias("anchor"), F.col("simhash").alias("a"))
    copies = placed.select(F.explode("copies").alias("anchor"), F.col("simhash").alias("b"))
    return homes.join(copies, "anchor").where(f"a < b and bit_count(a ^ b) <= {int(distance)}").select("a", "b")


def group(docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = 3, distance: int = 2) -> DataFrame:
    """``doc_id, simhash, component_id`` for every row: documents whose fingerprints are linked, directly or not.

    Fingerprints link at ``distance`` or fewer differing bits; ``component_id`` is the smallest id in reach. Equal
    fingerprints are one node, so copies are never paired. Null and empty texts have fingerprint 0 and link like any
    other. Null ids are ignored where the smallest is taken (null if there is no other). Repeated rows come out repeated,
    an empty table gives none, and other columns are not looked at.
    """
    plain = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    prints = checkpointed(fingerprints(plain, words=words))
    distinct = checkpointed(prints.groupBy("simhash").agg(F.min("doc_id").alias("first")))
    of_print = _smallest(distinct, distance).withColumnRenamed("smallest", "component_id")
    of_print = checkpointed_lookup(of_print)  # so that a fingerprint of very many copies can be split
    return prints.join(of_print, "simhash").select("doc_id", "simhash", "component_id")


def _smallest(distinct: DataFrame, distance: int) -> DataFrame:
    """``simhash, smallest``: of distinct fingerprints, each with its ``first``, the smallest ``first`` in reach."""
    members = components(close_pairs(distinct, distance)).withColumnRenamed("id", "simhash")
    linked = members.join(distinct, "simhash")
    smallest = linked.groupBy("component").agg(F.min("first").alias("smallest"))
    linked = linked.join(smallest, "component").select("simhash", "smallest")
    return distinct.join(linked, "simhash", "left").select("simhash", F.coalesce("smallest", "first").alias("smallest"))


def keep_one(docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = 3, distance: int = 2) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component exactly one row, one with the smallest id.

    Null ids come last, so that a component without any id keeps one row as well. Of rows that share the smallest id that
    with the smallest MD5 of the text stays, then that with the smallest hash of the other columns. Rows of different
    components may share an id: each component keeps its own.
    """
    id_, body = F.col(f"`{key}`"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    # equal ids and texts lie in one component, so that these three name a row of one component only
    named = {"doc_id": id_, "digest": F.unhex(F.md5(body.cast("binary"))), "rest": _rest(docs, [key, text])}
    plain = docs.select(*(c.alias(n) for n, c in named.items()), F.col(f"`{text}`").alias("text"))
    copies = fingerprints(plain, words=words).groupBy("simhash", *named).agg(F.count("*").alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), *named, "n")
    distinct = checkpointed(copies.groupBy("simhash").agg(F.min(order).alias("first")))
    chosen = _smallest(distinct, distance).select("smallest.*").distinct()
    kept = checkpointed_lookup(
        chosen.select(
            F.col("doc_id").alias("kept_id"), F.col("digest").alias("kept_digest"), F.col("rest").alias("kept_rest"),
            (F.col("n") > 1).alias("repeated"),
        )
    )
    rows = docs.select(F.struct("*").alias("row"), *(c.alias(n) for n, c in named.items()))
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("digest") == F.col("kept_digest"))
    rows = rows.join(kept, same & (F.col("rest") == F.col("kept_rest")))
    single = rows.where("not repeated").select("row.*")
    return single.unionByName(rows.where("repeated").dropDuplicates(list(named)).select("row.*"))


def _rest(docs: DataFrame, but: list[str]) -> Column:
    """A hash of the other columns, nulls told from absent values; maps cannot be hashed and are left out."""
    rest = [F.col(f"`{f.name}`") for f in docs.schema if f.name not in but and "map<" not in f.dataType.simpleString()]
    return F.xxhash64(F.lit(0), *rest, *(c.isNull() for c in rest))


def hexadecimal(simhash: str = "simhash"):
    return F.lower(F.lpad(F.hex(F.col(simhash)), 16, "0"))
