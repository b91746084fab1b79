import random

import pytest
from pyspark.sql import functions as F

from quartzo.llm import mixing, queries
from quartzo.llm.mixing import mix, split

SCHEMA = "doc_id long, source string, words long, Copy string, row int"


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s.encode() if s is not None else b""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in full]
        share = total - sum(full.values())
        goal = {s: share * w[s] / sum(w[x] for x in rest) for s in rest}
        above = [s for s in rest if goal[s] > most * sizes[s]]
        if not above:
            return {**goal, **full}
        full |= {s: most * sizes[s] for s in above}


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, s, n, "x", 3) for i, s, n in rows], SCHEMA)
    return mix(df, "source", F.col("words"), F.xxhash64("doc_id", "words"), undrawn=True, **options).collect()


def check(got, rows):
    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    want = plain_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    times = {}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        if r["copy"] is not None:
            taken[r.source] += r.mix_size
            times.setdefault(tuple(r._mix_row if hasattr(r, "_mix_row") else r.mix_row), []).append(r["copy"])
    assert all(sorted(c) == list(range(len(c))) and len(c) <= 3 for c in times.values())
    return {s: abs(taken[s] - want[s]) for s in sizes}, want


def test_targets_are_met(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["b", "a", "é", "Z", None, "hot", "hot", "hot"]), rng.randrange(1, 400)) for i in range(900)]
    rows += [(5000, "tiny", 7), (5001, "tiny", 0), (5002, "a", 4000)]
    off, want = check(run(spark, rows), rows)
    assert all(o <= 0.02 * want[s] + 2 for s, o in off.items())


def test_shards_get_each_block_once(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCKS", 4)
    rows = [(i, "ab"[i % 2], 10) for i in range(400)]
    got = [r for r in run(spark, rows) if r["copy"] is not None]
    by_shard = {}
    for r in got:
        by_shard.setdefault(r.mix_shard, []).append(r.mix_slot)
    assert len(by_shard) == 8 and all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    # the tree decides alike in every run
    placed = lambda: sorted((r.doc_id, r["copy"], r.mix_shard) for r in run(spark, rows) if r["copy"] is not None)
    assert placed() == placed() == sorted((r.doc_id, r["copy"], r.mix_shard) for r in got)


def test_quotas_follow_the_hypergeometric_law(spark):
    """300 sources of 8 blocks: of 2400 blocks half go left, so a source's share has mean 4 and variance 8/4 * 2392/2399."""
    blocks = spark.createDataFrame([(r, b) for r in range(300) for b in range(8)], "rank long, block long")
    left = {r["rank"]: r["count"] for r in split(blocks, 1).where("shard = 0").groupBy("rank").count().collect()}
    counts = [left.get(r, 0) for r in range(300)]
    mean = sum(counts) / 300
    assert mean == 4 and 1.5 < sum((c - mean) ** 2 for c in counts) / 299 < 2.5


def test_query_tells_the_shards_of_every_copy(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, "w " * rng.randrange(30), rng.choice(["a", "b", None])) for i in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op7_mixing(spark, str(tmp_path)).collect()
    assert len(got) == 200 and all(r.taken == r.size * len(r.shards) and all(0 <= s < 8 for s in r.shards) for r in got)
    assert len({s for r in got for s in r.shards}) == 8


def test_splits_are_exact_halves(spark):
    blocks = spark.createDataFrame([(r, b) for r in range(3) for b in range(20 * r + 5)], "rank long, block long")
    got = split(blocks, 3).groupBy("shard").count().collect()
    assert len(got) == 8 and max(r["count"] for r in got) - min(r["count"] for r in got) <= 1
    assert split(blocks, 3).select("rank", "block").distinct().count() == 75


@pytest.mark.parametrize("rows", [[], [(1, "a", 0)], [(1, None, 5)], [(1, "a", 3), (1, "a", 3), (None, "b", 2)], [(1, "a", 10**6), (2, "b", 1)]])
def test_small_tables(spark, rows):
    got = run(spark, rows)
    assert {r.doc_id for r in got} == {i for i, _, _ in rows}
    if rows:
        check(got, rows)


def test_taken_words_agree_between_runs(spark):
    rows = [(i, "abc"[i % 3], i % 37) for i in range(300)]
    sums = []
    for parts in (1, 7):
        df = spark.createDataFrame([(i, s, n, "x", 3) for i, s, n in rows], SCHEMA).repartition(parts)
        out = mix(df, "source", F.col("words"), F.xxhash64("doc_id", "words"))
        sums.append(sorted(map(tuple, out.groupBy("doc_id").count().collect())))
    assert sums[0] == sums[1]
