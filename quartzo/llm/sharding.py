"""Shards of near equal size, by sampled splitters.

Keys are sampled with a chance in proportion to their rows' sizes; quantiles of the sample cut the key space into many
ranges. The exact size of every range is counted. Overfull ranges are divided: keys that are too large for a range get one
of their own, the rest is dealt by a second hash. Ranges are then packed into shards, largest first. Rows of one key stay in
one shard, unless the key alone is larger than a shard's share.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartzo.llm.common import identified, stored, unused

#: Ranges for each shard at least, rows of a range at most on average, sampled keys for each range.
RANGES, ROWS, SAMPLED = 128, 1_000_000, 16


@dataclass
class Plan:
    """cuts: between ranges. heavy: pieces of keys with a range of their own. pieces: of the other ranges, where over 1.
    units: (range, heavy key or 0, piece) with its shard and first slot. All are bounded by the number of ranges."""

    cuts: list[float]
    heavy: dict[int, int]
    pieces: dict[int, int]
    units: list[tuple[int, int, int, int, int]]


def _placed(rows: DataFrame, cuts: list[float]) -> DataFrame:
    """Add r, the range of the column place."""
    if not cuts:
        return rows.withColumn("r", F.lit(0))
    bucket = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="place", outputCol="r")
    return bucket.transform(rows).withColumn("r", F.col("r").cast("int"))


def _units(rows: DataFrame, heavy: dict[int, int], pieces: dict[int, int]) -> DataFrame:
    """Add own (the key, if it is heavy, else 0) and piece; key, sub and r must be there."""
    spark = rows.sparkSession
    for name, on, parts in (("own", "key", heavy), ("more", "r", pieces)):
        small = spark.createDataFrame(list(parts.items()), f"{on} {'long' if on == 'key' else 'int'}, {name}_pieces int")
        rows = rows.join(F.broadcast(small), on, "left")  # a row for each range at most
    own = F.col("own_pieces").isNotNull()
    piece = F.when(own, F.pmod("sub", "own_pieces")).otherwise(F.pmod(F.xxhash64("key"), F.coalesce("more_pieces", F.lit(1))))
    return rows.select(
        *(c for c in rows.columns if c not in ("own_pieces", "more_pieces", "r")),
        F.when(own, F.lit(-1)).otherwise(F.col("r")).alias("r"), F.when(own, F.col("key")).otherwise(F.lit(0)).alias("own"), piece.cast("int").alias("piece"),
    )


def _packed(sizes: list[tuple[tuple[int, int, int], int, int]], share: float, shards: int) -> list[tuple[int, int, int, int, int]]:
    """Largest first into the emptiest shard; the pieces of a heavy key go together while they are no larger than a share."""
    bundles: dict[tuple, list] = {}
    own: dict[int, int] = {}
    for unit, size, _ in sizes:
        own[unit[1]] = own.get(unit[1], 0) + size * (unit[0] < 0)
    for unit, size, n in sizes:
        together = unit[0] < 0 and own[unit[1]] <= share
        bundles.setdefault(("key", unit[1]) if together else unit, []).append((unit, size, n))
    queue = [(0, 0, s) for s in range(shards)]  # size, rows, shard
    out: list[tuple[int, int, int, int, int]] = []
    slots = [0] * shards
    for bundle in sorted(bundles.values(), key=lambda b: (-sum(x[1] for x in b), b[0][0])):
        size, n, shard = heapq.heappop(queue)
        heapq.heappush(queue, (size + sum(x[1] for x in bundle), n + sum(x[2] for x in bundle), shard))
        for unit, _, count in sorted(bundle):
            out.append((*unit, shard, slots[shard]))
            slots[shard] += count
    return out


def plan(rows: DataFrame, shards: int) -> Plan:
    """``rows``: key, sub, size and place (the key as a double), read several times."""
    n, total, longest = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0)), F.max("size")).first()
    if not n:
        return Plan([], {}, {}, [])
    ranges = max(shards * RANGES, -(-n // ROWS))
    goal, most = max(1.0, total / ranges), 2 * n / ranges + 1
    chance = F.col("size") * (SAMPLED * ranges / max(total, 1))
    drawn = rows.where(F.pmod(F.xxhash64("key", "sub", F.lit(1)), F.lit(1 << 40)) < chance * (1 << 40))
    sample = sorted(drawn.select("place", F.greatest(F.lit(1.0), chance).alias("w")).collect())
    cuts, filled = [], 0.0
    step = sum(r.w for r in sample) / ranges
    for r in sample:
        if filled >= step and (not cuts or r.place > cuts[-1]):
            cuts.append(r.place)
            filled = 0.0
        filled += r.w
    placed = _placed(rows, cuts)
    sizes = {r.r: (r.s, r.n) for r in placed.groupBy("r").agg(F.sum("size").alias("s"), F.count("*").alias("n")).collect()}
    full = [(r,) for r, (s, k) in sizes.items() if s > 2 * goal or k > most]
    heavy, rest = {}, dict(sizes)
    if full:
        crowded = placed.join(F.broadcast(placed.sparkSession.createDataFrame(full, "r int")), "r", "left_semi")
        keys = crowded.groupBy("key", "r").agg(F.sum("size").alias("s"), F.count("*").alias("n")).where((F.col("s") > goal) | (F.col("n") > most))
        for k in keys.collect():  # each fills a range: no more than there are ranges
            heavy[k.key] = max(1, math.ceil(k.s / goal) if k.s > total / shards else 1, math.ceil(k.n / most))
            rest[k.r] = (rest[k.r][0] - k.s, rest[k.r][1] - k.n)
    pieces = {r: p for r, (s, k) in rest.items() if (p := max(math.ceil(s / goal / 2), math.ceil(k / most))) > 1}
    units = _units(placed, heavy, pieces).groupBy("r", "own", "piece").agg(F.sum("size").alias("s"), F.count("*").alias("n"))
    packed = _packed([((u.r, u.own, u.piece), u.s, u.n) for u in units.collect()], total / shards, shards)
    return Plan(cuts, heavy, pieces, packed)


def shard(df: DataFrame, shards: int, size: Column, key: Column) -> DataFrame:
    """All rows and columns of ``df``, with shard (0 to shards - 1) and slot (0, 1, 2 ... within the shard).

    ``size``: not null, above 0. Rows of equal ``key`` (a long; nulls are equal) stay together up to a shard's share; larger
    keys are dealt by a hash of the row. Rows are in order of their key within a range; repeated rows each get a slot. An
    empty table gives an empty result. Columns called shard or slot are replaced.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    df = df.drop("shard", "slot")
    (rid, inner, key_name, sub_name) = unused(df, "rid", "inner", "key", "sub")
    whole = identified(df, rid)
    # 52 bits of the key are exact as a double; rows of one key share its place
    parts = [F.coalesce(key, F.lit(0)).alias("key"), F.xxhash64(rid).alias("sub"), size.cast("long").alias("size")]
    place = F.shiftright("key", 12).cast("double").alias("place")
    made = plan(stored(whole.select(*parts).select("*", place)), shards)
    kept = whole.drop(rid).columns
    rows = whole.select(F.struct(*kept).alias(inner), *parts).select("*", place)
    units = df.sparkSession.createDataFrame(made.units, "r int, own long, piece int, shard int, first long")
    rows = _units(_placed(rows, made.cuts), made.heavy, made.pieces).join(F.broadcast(units), ["r", "own", "piece"])
    within = Window.partitionBy("r", "own", "piece").orderBy("key", "sub")
    slot = F.col("first") + F.row_number().over(within) - 1
    return rows.select(*(F.col(f"{inner}.`{c}`").alias(c) for c in kept), "shard", slot.cast("long").alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder for each shard, of as many files as it needs, rows in order of their slots."""
    rows = sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    rows.write.partitionBy("shard").parquet(path)
