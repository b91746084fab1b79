"""Mix sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is a tape: its rows in a random but fixed order, over and over, as long as its target. Tapes are cut into
blocks. The tree halves the output shards level by level: at every node the blocks of all sources are split into two halves
drawn without replacement, so each child's source quotas follow the multivariate hypergeometric law and add up exactly. A
leaf is an output shard; it gets disjoint blocks and shuffles their rows among themselves.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartzo.llm.common import identified, numbered, running, stored, unused

#: Output shards at least, words of one at most on average, blocks of one on average.
SHARDS, WORDS, BLOCKS = 8, 50_000_000, 64


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Add rank, weight and target to one row per source (source, source_size).

    Sources in order of code points, null last, take the weights in turn. They share the sum of all sizes by weight; a
    target stops at ``most`` times its source's size, and the excess is shared again until none is above.
    """
    ranked = numbered(sizes, [F.col("source").asc_nulls_last()], "rank")
    turn = F.array(*(F.lit(w) for w in weights))
    ranked = stored(ranked.withColumn("weight", F.element_at(turn, (F.col("rank") % len(weights) + 1).cast("int"))))
    level, stopped = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) > most * F.col("source_size")
        total, full, rest, count = ranked.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum(F.when(above, most * F.col("source_size"))), F.lit(0)), F.sum(F.when(~above, F.col("weight"))), F.count(F.when(above, 1))
        ).first()
        if count == stopped or not rest:
            break
        level, stopped = (total - full) / rest, count
    return ranked.withColumn("target", F.least((most * F.col("source_size")).cast("double"), F.col("weight") * F.lit(float(level))))


def split(blocks: DataFrame, levels: int) -> DataFrame:
    """Add shard to the rows (rank, block): halve the blocks at every node, ``levels`` times."""
    nodes = stored(blocks.withColumn("node", F.lit(0)))
    for level in range(levels):
        chance = nodes.withColumn("u", F.xxhash64("rank", "block", F.lit(level)))
        placed = running(chance, "node", ["u", "rank", "block"], F.lit(1), "before")
        n = nodes.groupBy("node").agg(F.count("*").alias("n"))
        # an odd block goes left or right by chance
        left = 2 * F.col("before") + F.pmod(F.xxhash64("node", F.lit(level)), F.lit(2)) < F.col("n")
        nodes = stored(placed.join(n, "node").select("rank", "block", (2 * F.col("node") + F.when(left, 0).otherwise(1)).alias("node")))
    return nodes.withColumnRenamed("node", "shard")


def mix(df: DataFrame, source: str, size: Column, key: Column, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, undrawn: bool = False) -> DataFrame:
    """The mix: one row per drawn copy, all columns of ``df`` and mix_row (an id of the input row), mix_size, source_size,
    target, copy (0, 1, 2), mix_shard and mix_slot (from 0 in the shuffled shard). With ``undrawn`` the other rows come
    too, with a null copy.

    ``size``: words of a row, not null. ``key``: a hash that orders a source's rows; it should depend on their content, so
    that reruns agree. Copies follow each other while they fit into the target; smaller rows and one nearest row of those left out
    fill what is missing then. No row comes more than ``most`` times. Rows of size 0 are not drawn. Null
    is a source of its own. Repeated rows are drawn each for itself. An empty table gives an empty mix.
    """
    rid, inner = unused(df, "mix_row", "inner")
    whole = identified(df, rid)
    rows = stored(whole.select(F.col(rid).alias("row"), F.col(source).alias("source"), size.cast("long").alias("size"), key.alias("key")))
    goals = stored(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most))
    total = goals.agg(F.sum("target")).first()[0] or 0
    levels = max(1, math.ceil(math.log2(max(SHARDS, total / WORDS))))
    block = max(1, int(total / (BLOCKS << levels)))
    known = rows.join(goals.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    tape = running(known, "rank", ["key", "row"], F.col("size"), "start")
    times = F.floor((F.col("target") - F.col("start") - F.col("size")) / F.col("source_size")) + 1
    times = F.when(F.col("size") > 0, F.greatest(F.lit(0), F.least(F.lit(most), times))).otherwise(0).cast("int")
    tape = stored(tape.select("row", "key", "size", "source_size", "target", "rank", "start", times.alias("times")))
    copies = tape.where("times > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("times") - 1)))
    at = F.floor((F.col("copy") * F.col("source_size") + F.col("start")) / block).alias("block")
    copies = copies.select("row", "copy", "rank", at)
    missing = tape.groupBy("rank").agg((F.first("target") - F.sum(F.col("times") * F.col("size"))).alias("missing"))
    end = F.floor(F.col("target") / block).alias("block")
    # what the first row that didn't fit left open: smaller rows behind it, then the one row that comes nearest
    left = tape.where((F.col("size") > 0) & (F.col("times") < most) & (F.col("times") <= F.floor(F.col("target") / F.col("source_size"))))
    left = stored(left.join(missing, "rank").select("row", "key", "size", "target", "rank", "missing", F.col("times").alias("copy")))
    small = running(left.where("size <= missing").withColumnRenamed("missing", "room"), "rank", ["key", "row"], F.col("size"), "start")
    small = stored(small.where("start + size <= room").select("row", "size", "copy", "rank", end))
    fill = small.groupBy("rank").agg(F.sum("size").alias("filled"))
    still = F.col("missing") - F.coalesce("filled", F.lit(0))
    gap = F.abs(F.col("size") - still)
    last = left.join(small.select("row"), "row", "left_anti").join(fill, "rank", "left").where(gap < still)
    last = last.groupBy("rank").agg(F.min(F.struct(gap.alias("gap"), "key", "row", "copy", end)).alias("m"))
    copies = stored(copies.union(small.select("row", "copy", "rank", "block")).union(last.select("m.row", "m.copy", "rank", "m.block")))
    shards = split(copies.select("rank", "block").distinct(), levels)
    order = Window.partitionBy("mix_shard").orderBy(F.xxhash64("row", "copy"), "row", "copy")
    drawn = copies.join(shards, ["rank", "block"]).select("row", "copy", F.col("shard").alias("mix_shard"))
    drawn = drawn.withColumn("mix_slot", (F.row_number().over(order) - 1).cast("long"))
    facts = tape.select("row", F.col("size").alias("mix_size"), "source_size", "target")
    drawn = facts.join(drawn, "row", "left" if undrawn else "inner")
    added = ["mix_size", "source_size", "target", "copy", "mix_shard", "mix_slot"]
    kept = [c for c in df.columns if c not in added]
    full = whole.select(F.struct(*kept).alias(inner), F.col(rid).alias("row"))
    return full.join(drawn, "row").select(*(F.col(f"{inner}.`{c}`").alias(c) for c in kept), F.col("row").alias(rid), *added)
