import random

import pytest
from pyspark.sql import functions as F

from quartzo.operators import scan


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot", "hot", "a", "b", None]), rng.choice([None, *range(9)]), i % 7, rng.choice([None, 1, 2, 5])) for i in range(900)]
    rows += [("copies", 1, 1, 3)] * 300
    return spark.createDataFrame(rows, "k string, t int, u int, v int").repartition(6)


def ordered(rows):
    """Rows by key in the total order: nulls first, ties by the other columns."""
    low = lambda x: (x is not None, x if x is not None else 0)
    out = {}
    for r in rows:
        out.setdefault(r.k, []).append(r)
    return {k: sorted(rs, key=lambda r: (low(r.t), low(r.u), low(r.v))) for k, rs in out.items()}


def flat(rows):
    return sorted(map(str, rows))


def test_number(frame):
    got = scan.number(frame, ["k"], ["t"], "n")
    want = [(*r, i) for rs in ordered(frame.collect()).values() for i, r in enumerate(rs, 1)]
    assert flat(tuple(r) for r in got.collect()) == flat(want)
    assert got.columns == [*frame.columns, "n"]


def test_number_of_all_rows_is_dense(spark):
    df = spark.range(0, 3000, numPartitions=5).select((F.col("id") * 7 % 1000).alias("x")).union(spark.createDataFrame([(10**15,), (None,)], "x long"))
    got = scan.number(df, [], ["x"], "n").collect()
    assert [r.n for r in sorted(got, key=lambda r: r.n)] == list(range(1, 3003))
    assert [r.x for r in sorted(got, key=lambda r: r.n)] == [None, *sorted(r.x for r in got if r.x is not None)]


def test_running_sum_and_last_known(frame):
    sums, lasts = [], []
    for rs in ordered(frame.collect()).values():
        total = last = None
        for r in rs:
            if r.v is not None:
                total, last = (total or 0) + r.v, r.v
            sums.append((*r, total))
            lasts.append((*r, last))
    assert flat(tuple(r) for r in scan.running_sum(frame, ["k"], ["t"], "v", "s").collect()) == flat(sums)
    assert flat(tuple(r) for r in scan.last_known(frame, ["k"], ["t"], "v", "last").collect()) == flat(lasts)


@pytest.mark.parametrize("following", [False, True])
def test_neighbour(frame, following):
    want = []
    for rs in ordered(frame.collect()).values():
        near = [*rs[1:], None] if following else [None, *rs[:-1]]
        want += [(*r, n and n.v, n is None) for r, n in zip(rs, near)]
    got = scan.neighbour(frame, ["k"], ["t"], ["v"], "near", following).collect()
    assert flat((*r[:4], r.near and r.near.v, r.near is None) for r in got) == flat(want)


def test_empty(frame):
    none = frame.limit(0)
    assert scan.number(none, ["k"], ["t"], "n").count() == scan.running_sum(none, [], ["t"], "v", "s").count() == 0


def test_a_hot_key_spreads(spark):
    """A key with half the rows fills many ranges, and so do its exact copies."""
    df = spark.range(0, 40_000, numPartitions=8).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("k"), F.lit(1).alias("t"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        sizes = [r["count"] for r in scan.ranges(df, ["k"], ["t"]).rows.groupBy("_range").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(sizes) == 40_000 and max(sizes) < 3 * 40_000 / 16
