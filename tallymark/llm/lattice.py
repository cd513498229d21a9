"""Near-duplicate vectors by hashing with the E8 lattice.

A table projects unit vectors to eight random orthogonal directions, or to two times eight, scales them and takes the
nearest point of the lattice E8 in each eight: its home cell. Besides, a vector is a guest of the neighbouring cells whose
lattice points are next nearest. Two vectors meet in a table if one is a guest in the home cell of the other, or both are
at home there; those that meet are compared by cosine. Several tables with other directions make a miss unlikely.

A cell is compared in blocks: its members are dealt to parts of bounded size, and each pair of parts is one task's work,
so that a cell may hold any share of the rows. Pairs are counted where they are found, in the first table and cell where
they meet, and never written out; of the links of a block only a spanning forest goes on to the components.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from tallymark.llm.graph import components
from tallymark.operators.joins import checkpointed_lookup
from tallymark.sources.scope import checkpointed


@dataclass(frozen=True)
class Settings:
    """``scale`` stretches projections of unit vectors as if they had 64 dimensions; ``part`` bounds a compared block."""

    tables: int = 4
    eights: int = 2
    scale: float = 3.0
    guests: int = 6
    part: int = 1_000
    seed: int = 5


@functools.lru_cache(1)
def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8, doubled so that they are whole numbers."""
    found = []
    for i, j in combinations(range(8), 2):
        for a in (2, -2):
            for b in (2, -2):
                v = [0] * 8
                v[i], v[j] = a, b
                found.append(v)
    for bits in range(256):
        signs = [1 - 2 * (bits >> i & 1) for i in range(8)]
        if bits.bit_count() % 2 == 0:
            found.append(signs)
    return np.array(found, np.int64)


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with whole coordinates of even sum: round, and round the worst coordinate the other way if odd."""
    r = np.rint(x)
    odd = np.flatnonzero(np.mod(r.sum(axis=1), 2))
    off = x[odd] - r[odd]
    worst = np.abs(off).argmax(axis=1)
    r[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1, -1)
    return r


def decode(x: np.ndarray) -> np.ndarray:
    """Nearest lattice point of each row of eight, doubled: E8 is D8 and D8 moved by one half in every coordinate."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    nearer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.rint(2 * np.where(nearer[:, None], a, b)).astype(np.int64)


def _key(points: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit name for each row of lattice coordinates."""
    h = np.full(len(points), salt + 0x51, np.uint64)
    for column in points.T:
        h = (h ^ column.astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def directions(dims: int, table: int, settings: Settings) -> np.ndarray:
    """Orthogonal directions as columns, stretched; vectors with fewer dimensions count as if zeros followed them."""
    rng = np.random.default_rng([settings.seed, table, dims])
    wanted = 8 * settings.eights
    whole = max(dims, wanted)
    return np.linalg.qr(rng.normal(size=(whole, wanted)))[0][:dims] * settings.scale * np.sqrt(whole / 64)


def cells(unit: np.ndarray, settings: Settings) -> np.ndarray:
    """Names of the cells of each vector: (row, table, home and guests). Guests may be fewer than asked: then the home."""
    n, dims = unit.shape
    out = np.empty((n, settings.tables, 1 + settings.guests), np.int64)
    for table in range(settings.tables):
        x = (unit @ directions(dims, table, settings)).reshape(n, settings.eights, 8)
        homes = np.stack([decode(x[:, e]) for e in range(settings.eights)], axis=1)
        costs, places = [], []
        for e in range(settings.eights):
            # squared distance to a neighbour less that to the home
            away = 2 * x[:, e] - homes[:, e]
            cost = 8 - 2 * away @ neighbours().T
            best = np.argpartition(cost, settings.guests, axis=1)[:, : settings.guests]
            costs.append(np.take_along_axis(cost, best, axis=1))
            places.append(best)
        costs, places = np.concatenate(costs, axis=1), np.concatenate(places, axis=1)
        chosen = np.argsort(costs, axis=1, kind="stable")[:, : settings.guests]
        out[:, table, 0] = _key(homes.reshape(n, -1), table)
        for g in range(settings.guests):
            e = chosen[:, g] // settings.guests
            points = homes.copy()
            points[np.arange(n), e] += neighbours()[places[np.arange(n), chosen[:, g]]]
            out[:, table, 1 + g] = _key(points.reshape(n, -1), table)
    return out


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links of a spanning forest of the graph with these links (places of nodes)."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        rx, ry = root(x), root(y)
        if rx != ry:
            parent[max(rx, ry)] = min(rx, ry)
            kept.append((x, y))
    return kept


def _compare(
    left: dict[str, np.ndarray], right: dict[str, np.ndarray], same: bool, at: tuple[int, int], least: float
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places in two parts of a cell that link and meet here first."""
    table, cell = at
    cosine = left["unit"] @ right["unit"].T
    a, b = np.nonzero(cosine >= least)
    if same:
        a, b = a[a < b], b[a < b]
    ca, cb = left["cells"][a], right["cells"][b]
    # meeting in a table: the home of one is a cell of the other; of two such cells the smaller name counts
    a_visits = (cb == ca[:, :, :1]).any(axis=2)
    b_visits = (ca == cb[:, :, :1]).any(axis=2)
    meets = a_visits | b_visits
    first = meets.argmax(axis=1) if len(a) else np.zeros(0, np.int64)
    rows = np.arange(len(a))
    home_a, home_b = ca[rows, first, 0], cb[rows, first, 0]
    big = np.iinfo(np.int64).max
    place = np.minimum(np.where(a_visits[rows, first], home_a, big), np.where(b_visits[rows, first], home_b, big))
    here = meets.any(axis=1) & (first == table) & (place == cell)
    return a[here], b[here]


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def link(
    rows: DataFrame, least: float, settings: Settings = Settings(), *, key: str = "vec_id", vector: str = "embedding",
    label: str | None = "label",
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row: vectors of cosine ``least`` and more are linked.

    Only rows with the same label, not null, are compared (all rows with ``label=None``). A vector that is null, empty,
    zero, or holds a null or non-finite number links with nothing. Equal vectors are one node that counts as often as it
    occurs, so copies are never paired. Vectors of different lengths do not link. ``component_id`` is the smallest id in
    reach, ``kept`` marks it. Null ids link by their vectors, have no say in the smallest and are not kept.
    """
    plain = rows.select(
        F.col(f"`{key}`").cast("long").alias("vec_id"),
        F.col(f"`{vector}`").cast("array<double>").alias("v"),
        (F.col(f"`{label}`").cast("string") if label else F.lit("")).alias("label"),
    )
    sound = F.coalesce(
        F.col("label").isNotNull()
        & F.exists("v", lambda x: x != 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))),
        F.lit(False),
    )
    plain = plain.withColumn("v", F.when(sound, F.col("v")))
    # one node for each distinct vector of a label, told by two hashes and then numbered
    twins = {name: F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(i), "label", F.size("v"), "v")) for i, name in enumerate(("h0", "h1"))}
    named = plain.withColumns(twins)
    nodes = (
        named.where("h0 is not null")
        .groupBy("h0", "h1")
        .agg(F.first("v").alias("v"), F.first("label").alias("label"), F.min("vec_id").alias("first"), F.count("*").alias("n"))
    )
    nodes = checkpointed(nodes.withColumn("node", F.monotonically_increasing_id()))
    # vectors given in single precision travel in it, which loses nothing
    kind = rows.schema[vector].dataType
    carried = "float" if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else "double"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column("v").to_pylist()])
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ends = np.cumsum(sizes)
            found = np.empty((len(sizes), settings.tables * (1 + settings.guests)), np.int64)
            for size in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == size)
                vectors = np.stack([flat[ends[i] - size : ends[i]] for i in own])
                found[own] = cells(_unit(vectors), settings).reshape(len(own), -1)
            width = found.shape[1]
            lists = pa.ListArray.from_arrays(np.arange(len(sizes) + 1, dtype=np.int32) * width, pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("node", "n", "label", "v")), lists],
                                             ["node", "n", "label", "v", "cells"])

    placed = checkpointed(
        nodes.select("node", "n", "label", F.col("v").cast(f"array<{carried}>").alias("v")).mapInArrow(
            place, f"node long, n long, label string, v array<{carried}>, cells array<long>"
        )
    )
    each = 1 + settings.guests
    spots = F.transform(
        "cells",
        lambda c, i: F.struct(F.floor(i / each).cast("int").alias("tab"), c.alias("cell"), (i % each == 0).alias("home")),
    )
    member = placed.select("node", "n", "label", F.size("v").alias("dims"), "v", "cells", F.explode(spots).alias("at")).select(
        "node", "n", "label", "dims", "v", "cells", "at.*"
    )
    group = ["label", "dims", "tab", "cell"]
    # guests alone do not meet
    sizes = member.groupBy(group).agg(F.count("*").alias("members"), F.max("home").alias("lived_in"))
    sizes = sizes.where("members > 1 and lived_in")
    sizes = sizes.select(*group, F.ceil(F.col("members") / settings.part).cast("int").alias("parts"))
    # each member goes to every pair of parts that holds its own: once in a cell of one part
    dealt = member.join(sizes, group).withColumn("part", F.pmod(F.xxhash64("node", "tab"), F.col("parts")).cast("int"))
    dealt = dealt.withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    ).select(
        "node", "n", "v", "cells", "tab", "cell", "part",
        F.xxhash64(*group, F.least("part", "other"), F.greatest("part", "other")).alias("block"),
        F.least("part", "other").alias("low"),
    )
    blocks = dealt.repartition("block").sortWithinPartitions("block")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _blocks(batches):
            found = _links(part, settings, least)
            if len(found[0]):
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["a", "b", "links"])

    found = checkpointed(blocks.mapInArrow(compare, "a long, b long, links long"))
    links = found.where("b is null").groupBy("a").agg(F.sum("links").alias("links"))
    member_of = components(found.where("b is not null").select("a", "b"))
    first = nodes.select(F.col("node").alias("id"), "first", "n", "h0", "h1")
    linked = member_of.join(first, "id")
    smallest = linked.groupBy("component").agg(F.min("first").alias("smallest"))
    smallest = linked.join(smallest, "component").select("id", "smallest")
    of_node = (
        first.join(smallest, "id", "left")
        .join(links.withColumnRenamed("a", "id"), "id", "left")
        .select(
            "h0",
            "h1",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("smallest", "first").alias("component_id"),
        )
    )
    return (
        named.select("vec_id", "h0", "h1")
        .join(checkpointed_lookup(of_node), ["h0", "h1"], "left")  # so that a vector of very many copies can be split
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
            F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(False)).alias("kept"),
        )
    )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one block after another; they come sorted by block."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        names = batch.column("block").to_numpy()
        cuts = np.flatnonzero(names[1:] != names[:-1]) + 1
        for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), len(names)], strict=True):
            if held and start == 0 and held[-1].column("block")[0].as_py() != names[0]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, stop - start))
            if stop < len(names):
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def _links(block: pa.Table, settings: Settings, least: float) -> tuple[list[int], list, list]:
    """Of a block: for each node the linked vectors found here (no ``b``), and a spanning forest (no count)."""
    block = block.combine_chunks()
    if block.num_rows < 2:
        return [], [], []
    node, n = block.column("node").to_numpy(), block.column("n").to_numpy()
    vectors = block.column("v").chunk(0).flatten().to_numpy(zero_copy_only=False).reshape(block.num_rows, -1).astype(np.float64)
    own = block.column("cells").chunk(0).flatten().to_numpy().reshape(block.num_rows, settings.tables, -1)
    part, low = block.column("part").to_numpy(), int(block.column("low")[0].as_py())
    at = (int(block.column("tab")[0].as_py()), int(block.column("cell")[0].as_py()))
    sides = [np.flatnonzero(part == low), np.flatnonzero(part != low)]
    same = not len(sides[1])
    left, right = ({"unit": _unit(vectors[s]), "cells": own[s]} for s in ((sides[0], sides[0]) if same else sides))
    if not same and len(sides[0]) == 0:
        return [], [], []
    counts = np.zeros(block.num_rows, np.int64)
    forest: list[tuple[int, int]] = []
    step = 256
    for start in range(0, len(sides[0]), step):
        piece = {k: v[start : start + step] for k, v in left.items()}
        if same:
            rest = {k: v[start:] for k, v in left.items()}
            a, b = _compare(piece, rest, True, at, least)
            a, b = sides[0][a + start], sides[0][b + start]
        else:
            a, b = _compare(piece, right, False, at, least)
            a, b = sides[0][a + start], sides[1][b]
        np.add.at(counts, a, n[b])
        np.add.at(counts, b, n[a])
        forest = _forest(np.array([*(x for x, _ in forest), *a]), np.array([*(y for _, y in forest), *b]))
    seen = np.flatnonzero(counts)
    nodes = [int(node[i]) for i in seen] + [int(node[x]) for x, _ in forest]
    others = [None] * len(seen) + [int(node[y]) for _, y in forest]
    return nodes, others, [int(counts[i]) for i in seen] + [None] * len(forest)
