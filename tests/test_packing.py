import os

import pytest
from pyspark.sql import functions as F

from quartzo.sources import packing


def files(root):
    return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


@pytest.fixture
def lake(spark, tmp_path):
    """Two folders of many small files and one large file each; later files have one more column."""
    root = str(tmp_path / "lake dir")
    df = spark.range(6000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t"))
    for day in ("01", "02"):
        df.where("id < 4000").coalesce(1).write.parquet(f"{root}/day={day}")
        df.where("id >= 4000 and id < 5000").repartition(10).write.mode("append").parquet(f"{root}/day={day}")
        df.where("id >= 5000").withColumn("more", F.lit(day)).repartition(10).write.mode("append").parquet(f"{root}/day={day}")
    return root


def content(spark, root, rows):
    df = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(root)
    return rows(df.select("id", "t", "more"))


def test_small_files_are_packed_within_their_folder(spark, lake, rows):
    before, want, target = files(lake), content(spark, lake, rows), 50_000
    large = {p: n for p, n in before.items() if n >= packing.SMALL * target}
    stamps = {p: os.stat(p).st_mtime_ns for p in large}
    assert len(large) == 2
    bins = packing.packing_plan(spark, lake, target).groupBy("folder", "bin").agg(F.sum("length").alias("n")).orderBy("folder", "bin").collect()
    written = packing.pack(spark, lake, target)
    after = files(lake)
    assert content(spark, lake, rows) == want
    assert {p: os.stat(p).st_mtime_ns for p in large} == stamps
    new = {p: n for p, n in after.items() if p not in before}
    assert len(new) == written and len(after) < 14 < len(before)
    assert all(n < 2 * target for n in new.values())
    for day in ("01", "02"):  # all but a folder's last bin are within one small file of the target
        mine = [r.n for r in bins if r.folder.endswith(f"day={day}")]
        assert len(mine) == sum(f"day={day}/" in p for p in new) > 1
        assert all(abs(n - target) < packing.SMALL * target for n in mine[:-1])
    assert sorted(os.listdir(lake)) == ["day=01", "day=02"]


def test_plan_depends_on_files_only(spark, lake, rows):
    first = rows(packing.packing_plan(spark, lake, 30_000).select("path", "bin"))
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert rows(packing.packing_plan(spark, lake, 30_000).select("path", "bin")) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("lost_at", ["written", "moved", "data"])
def test_a_run_that_breaks_off_is_finished_or_cleared(spark, lake, rows, monkeypatch, lost_at):
    want, count, whole = content(spark, lake, rows), len(files(lake)), packing.finish
    calls = []

    def lost(spark, root):
        calls.append(1)
        if len(calls) == 1:
            return whole(spark, root)
        raise OSError("lost")

    monkeypatch.setattr(packing, "finish", lost)
    with pytest.raises(OSError):
        packing.pack(spark, lake, 50_000)
    monkeypatch.setattr(packing, "finish", whole)
    (staging,) = (d for d in os.listdir(lake) if d.startswith(packing.STAGING))
    assert content(spark, lake, rows) == want  # nothing of it is visible yet
    if lost_at == "data":
        os.remove(f"{lake}/{staging}/data/_SUCCESS")
    if lost_at == "moved":  # a bin's files were moved in, its old ones not yet deleted
        plan = spark.read.parquet(f"{lake}/{staging}/plan").where("bin = 1").first()
        (name,) = (f for f in os.listdir(f"{lake}/{staging}/data/_bin=1") if f.endswith(".parquet"))
        os.rename(f"{lake}/{staging}/data/_bin=1/{name}", f"{plan.folder.removeprefix('file:')}/{name}")
    packing.finish(spark, lake)
    assert content(spark, lake, rows) == want
    assert not any(d.startswith(packing.STAGING) for d in os.listdir(lake))
    assert (len(files(lake)) == count) == (lost_at == "data")


def test_nothing_to_pack(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "one"))
    assert packing.pack(spark, str(tmp_path / "one")) == 0
    packing.finish(spark, str(tmp_path / "none"))
