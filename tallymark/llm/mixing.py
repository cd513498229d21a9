"""Interleaving sources by target weights with Pfair scheduling.

Each source is cut into blocks of rows. A source of weight ``w`` among active weights that add up to ``L`` gets ``w`` of
every ``L`` slots: its ``j``-th block (from 0) of a round is released at slot ``floor(j * L / w)`` and due by slot
``ceil((j + 1) * L / w)``. One block is placed per slot, the released one with the earliest deadline. For one machine this
meets every deadline, so at every slot each source has had its share to within less than one block.

Rounds with the same allotments have the same schedule, and the allotments only change where a source runs out: then the
weights of the others are scaled up. So a few schedules of ``L`` slots, made with SQL functions, place any number of rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymark.operators.joins import checkpointed_lookup

#: One step of the schedule: of the released sources with blocks left, the one with the earliest deadline, ties by place.
_PICK = """array_min(transform(sequence(0, size(allotted) - 1), i -> if(
    acc.done[i] < allotted[i].n and acc.done[i] * total div allotted[i].n <= t,
    struct(((acc.done[i] + 1) * total + allotted[i].n - 1) div allotted[i].n as due, i as i, acc.done[i] as j), null)))"""
_STEP = f"""transform(array({_PICK}), p -> struct(
    transform(acc.done, (d, i) -> if(i = p.i, d + 1L, d)) as done,
    concat(acc.placed, array(struct(p.i as i, p.j as j))) as placed))[0]"""
_SCHEDULE = f"""aggregate(sequence(0L, total - 1L),
    struct(transform(allotted, x -> 0L) as done, cast(array() as array<struct<i: int, j: bigint>>) as placed),
    (acc, t) -> {_STEP}, acc -> acc.placed)"""


def weight_of(source: Column, weights: Mapping[str, int], default: int) -> Column:
    if default < 1 or any(w < 1 for w in weights.values()):
        raise ValueError("weights are whole numbers from 1")
    pairs = [F.lit(x) for pair in sorted(weights.items()) for x in pair]
    named = F.create_map(*pairs)[source] if pairs else F.lit(None)
    return F.coalesce(named, F.lit(default)).cast("long")


def schedules(sizes: DataFrame) -> DataFrame:
    """The distinct rounds of ``sizes`` (key, weight, n_blocks): first round they hold for, first slot, length, schedule."""
    every = F.expr("array_sort(collect_list(struct(key, weight, n_blocks)))")
    return (
        sizes.agg(every.alias("every"))
        .withColumn(
            "round",
            F.explode(
                F.expr(
                    """filter(array_distinct(concat(array(0L), flatten(transform(every, x -> array(
                    x.n_blocks div x.weight, x.n_blocks div x.weight + 1))))),
                    r -> exists(every, x -> r * x.weight < x.n_blocks))"""
                )
            ),
        )
        .withColumn(
            "allotted",
            F.expr(
                """filter(transform(every, x -> struct(x.key as key,
                greatest(0L, least(x.weight, x.n_blocks - round * x.weight)) as n)), x -> x.n > 0)"""
            ),
        )
        .withColumn("first_slot", F.expr("aggregate(every, 0L, (a, x) -> a + least(x.n_blocks, round * x.weight))"))
        .withColumn("total", F.expr("aggregate(allotted, 0L, (a, x) -> a + x.n)"))
        .withColumn("placed", F.expr(_SCHEDULE))
    )


def mix(
    docs: DataFrame,
    weights: Mapping[str, int],
    *,
    default_weight: int,
    block_rows: int,
    source: str = "source",
    key: str = "doc_id",
    bucket_bits: int = 12,
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """``docs`` with the place of each row in the mix; no row is dropped or repeated.

    ``weights`` are whole numbers per source; other sources, and the rows without one (which form a source of their
    own), get ``default_weight``. Added columns: ``block`` (of its source, from 0), ``slot`` (of the block in the mix),
    ``release`` and ``deadline`` (the slots the block may take: from the first, before the second) and ``place`` (of the
    row in its block). ``names`` renames them. Columns of ``docs`` may have any names, these five included if renamed.

    Rows of a source are shuffled by the MD5 of ``key``; equal keys (repeated rows, null keys) are ordered by the other
    columns, and equal rows are interchangeable. Rows are numbered per source and hash bucket (``2 ** bucket_bits`` of
    them) with running counts of the buckets, so a source of any size is spread over tasks. An empty table gives none.
    """
    names = {n: (names or {}).get(n, n) for n in ("block", "slot", "release", "deadline", "place")}
    taken = {c.lower() for c in docs.columns}
    if clash := [n for n in names.values() if n.lower() in taken]:
        raise ValueError(f"columns {clash} are there already: give other names")
    plain = docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.concat(F.lit("="), F.col(f"`{source}`").cast("string")), F.lit("null")).alias("key"),
        F.col(f"`{key}`").alias("id"),
        *_rest(docs, key),
    )
    spread = F.col("rest").cast("string") if "rest" in plain.columns else F.lit("")
    plain = plain.withColumn("hash", F.md5(F.coalesce(F.col("id").cast("string"), spread).cast("binary"))).withColumn(
        "bucket", F.shiftright(F.conv(F.substring("hash", 1, 4), 16, 10).cast("int"), 16 - bucket_bits)
    )

    counts = plain.groupBy("key", "bucket").agg(F.count("*").alias("n"))
    # a running count per source: at most one row for each bucket
    running = F.sum("n").over(Window.partitionBy("key").orderBy("bucket")) - F.col("n")
    before = counts.select("key", "bucket", running.alias("before"))
    named = F.when(F.col("key") != "null", F.expr("substring(key, 2)"))
    sizes = (
        counts.groupBy("key")
        .agg(F.sum("n").alias("n"))
        .select(
            "key",
            weight_of(named, weights, default_weight).alias("weight"),
            F.ceil(F.col("n") / block_rows).cast("long").alias("n_blocks"),
        )
    )
    rounds = checkpointed_lookup(schedules(sizes))
    placed = rounds.select("round", "first_slot", "total", "allotted", F.posexplode("placed").alias("at", "p"))
    places = checkpointed_lookup(
        placed.withColumn("own", F.expr("allotted[p.i]")).select(
            F.expr("own.key").alias("key"),
            F.col("round").alias("since"),
            F.expr("p.j").alias("j"),
            "first_slot",
            "total",
            "at",
            F.expr("p.j * total div own.n").alias("released"),
            F.expr("((p.j + 1) * total + own.n - 1) div own.n").alias("due"),
        )
    )
    rounds_of = checkpointed_lookup(
        rounds.select("round", F.explode("every").alias("x"))
        .groupBy(F.expr("x.key").alias("key"), F.expr("x.weight").alias("weight"))
        .agg(F.array_sort(F.collect_list("round")).alias("rounds"))
    )

    own = Window.partitionBy("key", "bucket").orderBy("hash", "id", *(["rest"] if "rest" in plain.columns else []))
    z = (
        plain.withColumn("index", F.row_number().over(own) - 1)
        .join(before, ["key", "bucket"])
        .withColumn("index", F.col("before") + F.col("index"))
        .join(rounds_of, "key")
        .withColumn("block", F.expr(f"index div {block_rows}"))
        .withColumn("turn", F.expr("block div weight"))
        .withColumn("j", F.expr("block % weight"))
        .withColumn("since", F.expr("array_max(filter(rounds, r -> r <= turn))"))
        .join(places, ["key", "since", "j"])
        .withColumn("start", F.expr("first_slot + (turn - since) * total"))
    )
    return z.select(
        *(F.col("row").getField(c).alias(c) for c in docs.columns),
        F.col("block").cast("long").alias(names["block"]),
        F.expr("start + at").cast("long").alias(names["slot"]),
        F.expr("start + released").cast("long").alias(names["release"]),
        F.expr("start + due").cast("long").alias(names["deadline"]),
        F.expr(f"index % {block_rows}").cast("int").alias(names["place"]),
    )


def _rest(docs: DataFrame, key: str) -> list[Column]:
    """A hash of the other columns, to order rows whose keys are equal; maps cannot be hashed and are left out."""
    rest = [F.col(f"`{f.name}`") for f in docs.schema if f.name != key and "map<" not in f.dataType.simpleString()]
    return [F.xxhash64(*rest).alias("rest")] if rest else []
