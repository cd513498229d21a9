"""Approximate nearest neighbours by inner product over robustly pruned graphs.

Vectors are dealt to shards of bounded size. Each shard is a directed graph: points come in batches, a greedy beam search
from a few entry points proposes neighbours for each, and relaxed pruning keeps those that are diverse (a candidate goes
if it is, times ``alpha``, nearer to one that was kept than to the point itself). Edges go both ways, and a point with too
many is pruned again. Queries are searched by beam in every shard, and the best of all shards are kept.

Inner products become distances by one more coordinate: with ``M`` the largest norm of the shard a point gets
``sqrt(M^2 - |x|^2)`` and a query 0, so that the nearest point has the largest product. Vectors of similar length share
shards, so that this coordinate stays small beside the others. The products that are returned are computed in double
precision on the vectors as they were given.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.operators.joins import checkpointed_lookup
from tallymark.sources.scope import checkpointed


@dataclass(frozen=True)
class Settings:
    """``shard_rows`` bounds what one task holds, ``query_rows`` queries are worth a further copy of a shard; ``slack`` is how far a degree may grow meanwhile."""

    degree: int = 32
    slack: int = 16
    build_beam: int = 64
    search_beam: int = 160
    wide: int = 4
    alpha: float = 1.3
    entries: int = 8
    batch: int = 256
    shard_rows: int = 8_192
    query_rows: int = 1_024
    seed: int = 3


@dataclass(frozen=True)
class Index:
    """``points``: ``shard, place, node, twin, first, last, v, edges`` of each distinct vector; ``ids``: ``node, twin, vec_id, n``.

    ``node`` and ``twin`` are two hashes that name a vector, ``first`` and ``last`` its smallest and largest id, and ``n``
    counts the rows of an id and vector.
    """

    points: DataFrame
    ids: DataFrame


class Graph:
    """A shard in memory: points, squared norms and neighbours (-1 where there is none)."""

    def __init__(self, points: np.ndarray, settings: Settings, edges: np.ndarray | None = None):
        norms = np.einsum("ij,ij->i", points, points)
        extra = np.sqrt(np.maximum(norms.max(initial=0.0) - norms, 0))
        self.points = np.concatenate([points, extra[:, None]], axis=1).astype(np.float32)
        self.norms = np.einsum("ij,ij->i", self.points, self.points)
        self.settings = settings
        n = len(points)
        rng = np.random.default_rng(settings.seed)
        self.order = rng.permutation(n)
        centre = int(((self.points - self.points.mean(axis=0)) ** 2).sum(axis=1).argmin()) if n else 0
        self.order = np.concatenate([[centre], self.order[self.order != centre]]).astype(np.int64) if n else self.order
        self.entries = self.order[: settings.entries]
        if edges is None:
            self.edges = np.full((n, settings.degree + settings.slack), -1, np.int32)
            self._build()
        else:
            self.edges = edges

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and distances (less the query's norm) of the nearest points found, nearest first; -1 pads."""
        m, n, wide = len(queries), len(self.points), self.settings.wide
        beam = min(beam, n)
        seen = np.zeros((m, n + 1), bool)
        seen[:, -1] = True
        place = np.full((m, beam), -1, np.int64)
        away = np.full((m, beam), np.inf, np.float32)
        done = np.ones((m, beam), bool)
        rows = np.arange(m)
        fresh = np.broadcast_to(self.entries, (m, len(self.entries)))
        while len(rows):
            fresh = np.where(fresh < 0, n, fresh)
            fresh = np.sort(fresh, axis=1)  # a point that two expanded points share comes once
            new = ~seen[rows[:, None], fresh]
            new[:, 1:] &= fresh[:, 1:] != fresh[:, :-1]
            seen[rows[:, None], fresh] = True
            at, column = np.nonzero(new)
            point = fresh[at, column]
            d = np.full(fresh.shape, np.inf, np.float32)
            d[at, column] = self.norms[point] - 2 * np.einsum("ij,ij->i", self.points[point], queries[rows[at]])
            d_all = np.concatenate([away[rows], d], axis=1)
            best = np.argpartition(d_all, beam - 1, axis=1)[:, :beam] if d_all.shape[1] > beam else None
            if best is None:
                best = np.argsort(d_all, axis=1)
            else:
                best = np.take_along_axis(best, np.argsort(np.take_along_axis(d_all, best, 1), axis=1, kind="stable"), 1)
            away[rows] = np.take_along_axis(d_all, best, 1)
            place[rows] = np.take_along_axis(np.concatenate([place[rows], fresh], axis=1), best, 1)
            done[rows] = np.take_along_axis(np.concatenate([done[rows], ~new], axis=1), best, 1)
            # expand the nearest points not expanded yet, several at a time
            open_ = ~done[rows] & np.isfinite(away[rows])
            rank = np.cumsum(open_, axis=1)
            chosen = open_ & (rank <= wide)
            done[rows] |= chosen
            going = chosen.any(axis=1)
            rows, chosen, rank = rows[going], chosen[going], rank[going]
            heads = np.full((len(rows), wide), -1, np.int64)
            at, column = np.nonzero(chosen)
            heads[at, rank[at, column] - 1] = place[rows[at], column]
            fresh = np.where(heads[:, :, None] >= 0, self.edges[heads], -1).reshape(len(rows), wide * self.edges.shape[1])
        place[~np.isfinite(away)] = -1
        return place, away

    def prune(self, owners: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """For each owner at most ``degree`` of its candidates (-1 pads), diverse ones, nearest first."""
        points, alpha = self.points, self.settings.alpha**2
        valid = (candidates >= 0) & (candidates != owners[:, None])
        there = points[np.maximum(candidates, 0)]
        own = np.einsum("mcd,mcd->mc", there - points[owners][:, None], there - points[owners][:, None])
        own = np.where(valid, own, np.inf)
        order = np.argsort(own, axis=1, kind="stable")
        own, candidates = np.take_along_axis(own, order, 1), np.take_along_axis(candidates, order, 1)
        there = np.take_along_axis(there, order[:, :, None], 1)
        norms = np.einsum("mcd,mcd->mc", there, there)
        between = np.maximum(norms[:, :, None] + norms[:, None, :] - 2 * there @ there.transpose(0, 2, 1), 0)
        alive = np.isfinite(own)
        alive[:, 1:] &= candidates[:, 1:] != candidates[:, :-1]
        kept = np.full((len(owners), self.settings.degree), -1, np.int32)
        rows = np.arange(len(owners))
        for slot in range(self.settings.degree):
            first = alive.argmax(axis=1)
            some = alive[rows, first]
            if not some.any():
                break
            kept[:, slot] = np.where(some, candidates[rows, first], -1)
            alive &= ~(some[:, None] & (alpha * between[rows, first] <= own))
            alive[rows, first] = False
        return kept

    def _build(self) -> None:
        settings, n = self.settings, len(self.points)
        order = self.order
        begin = min(n, max(settings.batch, settings.entries))
        head = order[:begin]
        nearest = min(begin, settings.build_beam)
        d = self.norms[head][None] - 2 * self.points[head] @ self.points[head].T
        self._add(head, head[np.argpartition(d, nearest - 1, axis=1)[:, :nearest]] if n else np.zeros((0, 1), np.int64))
        while begin < n:
            batch = order[begin : begin + settings.batch]
            found, _ = self.search(self.points[batch], settings.build_beam)
            self._add(batch, found)
            begin += len(batch)

    def _add(self, batch: np.ndarray, candidates: np.ndarray) -> None:
        degree, width = self.settings.degree, self.edges.shape[1]
        if not len(batch):
            return
        kept = self.prune(batch, candidates)
        self.edges[batch, :degree] = kept
        source = np.repeat(batch, degree)[kept.ravel() >= 0]
        target = kept.ravel()[kept.ravel() >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        points, start, count = np.unique(target, return_index=True, return_counts=True)
        free = (self.edges[points] < 0).sum(axis=1)
        fits = count <= free
        used = width - free
        place = np.arange(len(target)) - np.repeat(start, count)
        light = np.repeat(fits, count)
        self.edges[target[light], (np.repeat(used, count) + place)[light]] = source[light]
        heavy = points[~fits]
        for at in range(0, len(heavy), 512):
            part = heavy[at : at + 512]
            most = int(count[np.searchsorted(points, part)].max())
            extra = np.full((len(part), most), -1, np.int64)
            for row, p in enumerate(part.tolist()):
                i = int(np.searchsorted(points, p))
                extra[row, : count[i]] = source[start[i] : start[i] + count[i]]
            pruned = self.prune(part, np.concatenate([self.edges[part].astype(np.int64), extra], axis=1))
            self.edges[part] = -1
            self.edges[part, :degree] = pruned


def _sound(vector: str):
    v = F.col(vector)
    return F.coalesce(
        F.exists(v, lambda x: x != 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))),
        F.lit(False),
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows that follow one another with the same key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        names = batch.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)]
        for start, stop in zip(cuts, cuts[1:], strict=False):
            if held and held[-1].column(key)[0].as_py() != names[start]:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(start, stop - start))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, Iterator[pa.RecordBatch]]]:
    """Of each task's rows, sorted by shard and then points before queries: the points, and the queries as they come."""
    pieces = _pieces(batches)
    piece = next(pieces, None)
    while piece is not None:
        task, points = piece[0], []
        while piece is not None and piece[:2] == (task, False):
            points.append(piece[2])
            piece = next(pieces, None)

        def asks() -> Iterator[pa.RecordBatch]:
            nonlocal piece
            while piece is not None and piece[0] == task:
                yield piece[2]
                piece = next(pieces, None)

        if points:
            yield pa.Table.from_batches(points).combine_chunks(), asks()
        for _ in asks():  # what was not read
            pass


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
    """Batches cut where the task or the kind of row changes."""
    for batch in batches:
        tasks = batch.column("task").to_numpy()
        asks = batch.column("asks").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((tasks[1:] != tasks[:-1]) | (asks[1:] != asks[:-1])) + 1
        for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), len(tasks)], strict=True):
            if stop > start:
                yield int(tasks[start]), bool(asks[start]), batch.slice(start, stop - start)


def build(rows: DataFrame, settings: Settings = Settings(), *, key: str = "vec_id", vector: str = "embedding") -> Index:
    """The index of every sound vector, written to the shared folder.

    Equal vectors are one point of a graph, since copies would prune each other's edges and leave nothing else to reach;
    their ids lie in a table beside. Vectors that are null, empty, zero, or hold null or non-finite numbers are left out,
    and so are null ids. Vectors of different lengths lie in different shards. Rows with equal ids stay rows of their own.
    """
    sound = rows.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    sound = sound.where(F.col("vec_id").isNotNull() & _sound("v"))
    named = sound.withColumns({"node": F.xxhash64(F.lit(0), "v"), "twin": F.xxhash64(F.lit(1), "v")})
    ids = checkpointed(named.groupBy("node", "twin", "vec_id").agg(F.count("*").alias("n")))
    ends = F.min("vec_id").alias("first"), F.max("vec_id").alias("last")
    sound = named.groupBy("node", "twin").agg(*ends, F.first("v").alias("v"))
    # vectors of similar length together: a band is a factor of e^(1/4); doubles have a few thousand bands
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    band = F.floor(4 * F.greatest(F.lit(-400.0), F.least(F.lit(400.0), F.log(length))) + 0.5).cast("long") + 2048
    sound = checkpointed(sound.withColumn("band", F.size("v").cast("long") * (1 << 32) + band * (1 << 18)))
    counts = sound.groupBy("band").count().collect()
    parts = {r["band"]: -(-r["count"] // settings.shard_rows) for r in counts}
    shards = sum(parts.values())
    own = F.create_map(*(F.lit(x) for pair in parts.items() for x in pair))[F.col("band")] if parts else F.lit(1)
    dealt = sound.withColumn("shard", F.col("band") + F.pmod(F.xxhash64("node", F.lit(settings.seed)), own)).drop("band")
    dealt = dealt.repartition(max(shards, 2), "shard").sortWithinPartitions("shard", "first", "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "shard"):
            vectors = _matrix(group.column("v").chunk(0))
            edges = Graph(vectors, settings).edges
            width = edges.shape[1]
            lists = pa.ListArray.from_arrays(np.arange(len(edges) + 1, dtype=np.int32) * width, pa.array(edges.ravel()))
            place = pa.array(np.arange(len(edges), dtype=np.int32))
            columns = [group.column("shard"), place, *(group.column(c) for c in ("node", "twin", "first", "last", "v")), lists]
            names = ["shard", "place", "node", "twin", "first", "last", "v", "edges"]
            yield from pa.table(columns, names).to_batches(max_chunksize=2048)

    schema = "shard long, place int, node long, twin long, first long, last long, v array<double>, edges array<int>"
    return Index(checkpointed(dealt.mapInArrow(run, schema)), ids)


def search(
    index: Index, queries: DataFrame, k: int, settings: Settings = Settings(), *, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` points of largest inner product found for each query, but not itself.

    A task holds one shard, and the queries stream past it. Fewer rows come out only if there are fewer candidates of the
    same length. Ties go to the smaller ``vec_id``; queries that are not sound give no row; a repeated query id, taken as one
    query, asks with the smallest of its vectors.
    """
    asked = queries.select(
        F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("v")
    )
    asked = asked.where(F.col("vec_id").isNotNull() & _sound("v"))
    asked = checkpointed(asked.groupBy("vec_id").agg(F.min("v").alias("v")))
    names = index.points.select("shard").distinct()
    shards = max(1, names.count())
    # queries stream past a shard, so that points need not be copied; only few shards are, to keep all cores busy
    wanted = -(-2 * queries.sparkSession.sparkContext.defaultParallelism // shards)
    blocks = max(1, min(wanted, -(-asked.count() // settings.query_rows)))
    none = F.lit(None)
    points = index.points.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    points = points.select(
        "shard", "block", F.lit(False).alias("asks"), "place", F.col("first").alias("vec_id"), "last", "node", "twin", "v", "edges"
    )
    # each query goes to every shard of its length
    lists = names.groupBy(F.expr("shard >> 32").cast("int").alias("dims")).agg(F.collect_list("shard").alias("shards"))
    asking = (
        asked.join(lists, F.size("v") == F.col("dims"))
        .withColumn("shard", F.explode("shards"))
        .select(
            "shard",
            F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"),
            F.lit(True).alias("asks"),
            none.cast("int").alias("place"),
            "vec_id",
            none.cast("long").alias("last"),
            none.cast("long").alias("node"),
            none.cast("long").alias("twin"),
            "v",
            none.cast("array<int>").alias("edges"),
        )
    )
    both = points.unionByName(asking).withColumn("task", F.xxhash64("shard", "block"))
    both = both.repartition(max(2, shards * blocks), "task").sortWithinPartitions("task", "asks", "place", "vec_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for points, asks in _shards(batches):
            n = len(points)
            vectors, first = _matrix(points.column("v").chunk(0)), points.column("vec_id").to_numpy()
            last, node, twin = (points.column(c).to_numpy() for c in ("last", "node", "twin"))
            graph = Graph(vectors, settings, _matrix(points.column("edges").chunk(0)))
            for batch in asks:
                for start in range(0, len(batch), settings.batch):
                    part = batch.slice(start, settings.batch)
                    q, q_ids = _matrix(part.column("v")), part.column("vec_id").to_numpy()
                    wide = np.concatenate([q, np.zeros((len(q), 1))], axis=1).astype(np.float32)
                    place, _ = graph.search(wide, max(settings.search_beam, k + 1))
                    near = np.clip(place, 0, n - 1)
                    score = np.einsum("md,mbd->mb", q, vectors[near])
                    alone = (first[near] == q_ids[:, None]) & (last[near] == q_ids[:, None])
                    score = np.where((place < 0) | alone, -np.inf, score)
                    best = np.lexsort((first[near], -score))[:, : k + 1]
                    rows, columns = np.nonzero(np.isfinite(np.take_along_axis(score, best, 1)))
                    chosen = best[rows, columns]
                    at = place[rows, chosen]
                    arrays = [q_ids[rows], node[at], twin[at], first[at], score[rows, chosen]]
                    names = ["query_id", "node", "twin", "first", "score"]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names)

    found = both.mapInArrow(run, "query_id long, node long, twin long, first long, score double")
    # k + 1 vectors, by their smallest ids where they tie, hold k ids besides the query's own; so do k + 1 ids of each
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "first")
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k + 1).drop("rank", "first")
    smallest = Window.partitionBy("node", "twin").orderBy("vec_id")
    ids = index.ids.withColumn("nth", F.row_number().over(smallest)).where(F.col("nth") <= k + 1).drop("nth")
    found = found.join(checkpointed_lookup(ids), ["node", "twin"]).where("vec_id != query_id")
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int"))))
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
