"""Bronze takes each file once; a run's tables become visible together or not at all."""

import datetime
import os
import shutil

import pytest
from pyspark.sql import functions as F

from quartzo.operators.quality import BlockedRun
from quartzo.plans import validate
from quartzo.plans.medallion import Medallion
from quartzo.plans.storefront import Storefront
from quartzo.sources import lake as layers
from quartzo.sources.lake import Lake
from test_lake import DATA, RUN, land, needs_data

SCHEMA = "id bigint, name string"


def put(spark, base, day, rows):
    path = f"{base}/landing/t/dia={day}"
    shutil.rmtree(path, ignore_errors=True)
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.json(path)


def take(spark, base, stamp=RUN):
    return layers.bronze(spark, Lake(spark, base), "t", "jsonl", stamp, SCHEMA)


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_bronze_takes_new_and_changed_files_only(spark, tmp_path, rows):
    base = str(tmp_path)
    put(spark, base, "2024-01-01", [(1, "a"), (2, "b")])
    put(spark, base, "2024-01-02", [(3, "c")])
    take(spark, base)
    before = files(f"{base}/bronze/t")
    assert layers.unread_files(Lake(spark, base), "t").count() == 0
    take(spark, base, datetime.datetime(2025, 1, 1))
    assert files(f"{base}/bronze/t") == before  # nothing was read, nothing written
    put(spark, base, "late", [(4, "d")])
    assert layers.unread_files(Lake(spark, base), "t").count() == 1
    got = take(spark, base, datetime.datetime(2025, 1, 1))
    assert before.items() <= files(f"{base}/bronze/t").items()
    want = [(1, "a", "2024-01-01", 2024), (2, "b", "2024-01-01", 2024), (3, "c", "2024-01-02", 2024), (4, "d", "late", 2025)]
    assert rows(got.select("id", "name", "dia", F.year("_ingested_at"))) == want


def test_crash_before_the_manifest_repeats_cleanly(spark, tmp_path, rows, monkeypatch):
    base = str(tmp_path)
    put(spark, base, "a", [(1, "a")])
    monkeypatch.setattr(layers, "_manifest", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    monkeypatch.setattr(layers, "unread_files", lambda lake, dataset: layers.formats.file_sizes(spark, lake.path("landing", dataset)).select("path", F.lit("k").alias("key"), "length", F.col("modificationTime").alias("modified")))
    with pytest.raises(OSError):
        take(spark, base)
    monkeypatch.undo()
    assert layers.unread_files(Lake(spark, base), "t").count() == 1
    assert rows(take(spark, base).select("id", "name")) == [(1, "a")]


def test_tables_become_visible_together(spark, tmp_path):
    base, one = str(tmp_path), spark.range(1)
    lake, reader = Lake(spark, base), Lake(spark, base)
    lake.stage(one, "silver", "a")
    lake.stage(one, "gold", "b")
    assert lake.read("silver", "a").count() == 1 and reader.version() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        reader.read("gold", "nothing")
    assert lake.publish() == 1 and reader.read("gold", "b").count() == 1
    lake.stage(spark.range(5), "silver", "a")
    lake.discard()
    assert reader.read("silver", "a").count() == lake.read("silver", "a").count() == 1
    lake.stage(spark.range(7), "silver", "a")
    assert lake.publish() == 2
    assert reader.read("silver", "a").count() == 7 and reader.read("gold", "b").count() == 1  # b stays where version 1 put it
    lake.stage(spark.range(8), "silver", "a")
    lake.publish()
    assert lake.vacuum(keep=2) == 1 and len(os.listdir(f"{base}/silver/a")) == 2
    assert reader.read("silver", "a").count() == 8 and reader.read("gold", "b").count() == 1


@needs_data
def test_bad_day_and_lost_file_leave_every_table(spark, tmp_path, rows):
    base = str(tmp_path / "lake")
    events = Storefront(spark, DATA).events().drop("injected_issue").filter("_source_file not like '%late%'")
    land(spark, base, events=events)
    flow = Medallion(spark, base, RUN, database="gold_wap", max_quarantine_pct=60)
    assert all(r.ok for r in flow.run())
    tables = [(layer, n) for layer, names in (("silver", ("customers", "orders", "events")), ("quarantine", ("events", "catalog")), ("gold", ("fato_vendas", "dim_data"))) for n in names]
    seen = lambda: {t: flow.lake.location(*t) for t in tables}
    before, revenue = seen(), rows(flow.tables()["mart_receita_categoria_dia"])
    # a day without any device comes in
    bad = events.filter("_source_file like '%2024-01-05%'").withColumn("device", F.lit(None).cast("string"))
    bad.drop("_source_file").coalesce(1).write.mode("append").json(f"{base}/landing/events/arquivo=9999")
    with pytest.raises(BlockedRun, match="9999"):
        flow.run()
    assert seen() == before and flow.lake.version() == 1 and rows(flow.tables()["mart_receita_categoria_dia"]) == revenue
    shutil.rmtree(f"{base}/landing/events/arquivo=9999")
    for folder in os.listdir(f"{base}/bronze/events"):
        if "9999" in folder:
            shutil.rmtree(f"{base}/bronze/events/{folder}")
    # a Bronze folder is lost: its file counts as taken, so the check of the layers must see it
    lost = sorted(f for f in os.listdir(f"{base}/bronze/events") if f.startswith("_origin"))[3]
    shutil.rmtree(f"{base}/bronze/events/{lost}")
    with pytest.raises(validate.FailedChecks, match="bronze_preserva_landing"):
        flow.run()
    assert seen() == before and flow.lake.version() == 1
    spark.sql("DROP DATABASE IF EXISTS gold_wap CASCADE")
