import random

import pytest
from pyspark.sql import functions as F

from quartzo.llm import sharding
from quartzo.llm.sharding import shard, write_shards

SCHEMA = "doc_id long, text string, shard int, key string, R double"


def run(spark, rows, shards=8):
    df = spark.createDataFrame([(i, t, 9, "k", 1.5) for i, t in rows], SCHEMA)
    out = shard(df, shards, (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long"), F.xxhash64("text"))
    assert out.columns == ["doc_id", "text", "key", "R", "shard", "slot"]
    return out.collect()


def balanced(got, rows, shards=8, spread=0.1):
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(rows, key=str)
    sizes = [0] * shards
    slots = {}
    for r in got:
        sizes[r.shard] += len((r.text or "").encode()) + 1
        slots.setdefault(r.shard, []).append(r.slot)
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    assert max(sizes) <= (1 + spread) * sum(sizes) / shards + max(len((r.text or "").encode()) + 1 for r in got)
    return sizes


def test_even_sizes_and_whole_groups(spark):
    rng = random.Random(1)
    rows = [(i, "x" * rng.randrange(400) + str(i)) for i in range(600)] + [(1000 + i, "copy " * 20) for i in range(50)]
    got = run(spark, rows)
    sizes = balanced(got, rows, spread=0.02)
    assert max(sizes) < 1.05 * min(sizes)
    assert len({r.shard for r in got if r.text == "copy " * 20}) == 1


def test_a_key_above_a_share_is_divided(spark):
    rows = [(i, f"other {i} " * 5) for i in range(300)] + [(5, "hot text " * 6)] * 400 + [(None, None)] * 300
    sizes = balanced(run(spark, rows), rows, spread=0.05)
    assert max(sizes) < 1.1 * min(sizes)


def test_many_rows_of_one_key_are_numbered_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS", 20)
    rows = [(i, None) for i in range(500)] + [(i, "y" * 900 + str(i)) for i in range(40)]
    got = run(spark, rows, 2)
    balanced(got, rows, 2)
    assert len({r.shard for r in got if r.text is None}) == 1


@pytest.mark.parametrize("rows", [[], [(1, "a")], [(None, "a"), (None, "a"), (2, "")], [(1, "long " * 60_000), (2, None)]])
def test_small_tables(spark, rows):
    got = run(spark, rows)
    assert len(got) == len(rows) and sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in rows)


def test_written_shards_read_back(spark, tmp_path):
    df = spark.createDataFrame([(i, "z" * (i % 50)) for i in range(200)], "doc_id long, text string")
    out = shard(df, 4, F.length("text").cast("long") + 1, F.xxhash64("text"))
    write_shards(out, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(map(tuple, back.select("doc_id", "shard").collect())) == sorted(map(tuple, out.select("doc_id", "shard").collect()))


def test_no_shards():
    with pytest.raises(ValueError):
        shard(None, 0, None, None)
