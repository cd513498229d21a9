"""Connected components of a graph that lies in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.sources.scope import checkpointed


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``id, component`` for every node of ``links`` (columns ``a``, ``b``, longs); a component is its smallest node.

    Alternating stars: a round lets every node tell its larger neighbours, then its smaller ones, the smallest node it
    knows, which halves long chains. Minima are combined before the shuffle and kept in the shared folder, since adaptive
    execution splits a hot node only in a join of plain shuffled rows; each round is checkpointed as well. Links with a
    null end, loops and repeated links change nothing.
    """
    pairs = links.dropna(subset=["a", "b"]).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = checkpointed(pairs.where("u != v").distinct())
    before = _state(edges)
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = checkpointed(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = checkpointed(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(down, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = checkpointed(small.union(down.select("u", F.col("m").alias("v"))).distinct())
        after = _state(edges)
        if after == before:
            roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)
        before = after
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
