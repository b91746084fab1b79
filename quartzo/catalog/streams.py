"""Streaming jobs run to the end of their input; their result must equal the batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from quartzo.catalog.base import query
from quartzo.catalog.books import TURNS
from quartzo.catalog.lake import BRONZE_SQL, EVENT_SCHEMA, RUN, landed_events
from quartzo.plans import bookstore
from quartzo.session import cut_lineage, scratch
from quartzo.sources import formats
from quartzo.streaming import jobs

TIMED = "event_id bigint, ts timestamp, event_type string"


def timed_events(shop, files_per_batch=None):
    """Events as landing files with a zoned event time; copies of some come in a later file."""
    path = scratch(shop.spark, "stream-in")
    events = shop.table("events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    formats.write_parquet(events, f"{path}/first")
    formats.write_parquet(events.filter("event_id % 97 = 0"), f"{path}/late")
    return path, jobs.landing_stream(shop.spark, path, TIMED, files_per_batch, fmt="parquet")


@query("stream_bronze", BRONZE_SQL)
def stream_bronze(shop):
    lake = landed_events(shop)
    out, check = scratch(shop.spark, "stream-bronze"), scratch(shop.spark, "check")
    stream = jobs.landing_stream(shop.spark, lake.path("landing", "events"), EVENT_SCHEMA)
    for _ in range(2):  # the second run finds nothing new
        jobs.to_bronze(stream, lake.path("landing"), out, check, RUN)
    origin = F.regexp_extract("_source_file", "^events/arquivo=([^/]+)/", 1)
    return shop.spark.read.parquet(out).select("event_id", "event_type", "event_at", "device", origin.alias("origem"))


HOURLY_SQL = """SELECT date_trunc('hour', ts) AS inicio, CAST(count(*) + count(*) FILTER (WHERE event_id % 97 = 0) AS BIGINT) AS eventos
       FROM events GROUP BY 1"""


def hourly(shop):
    _, stream = timed_events(shop)
    out = scratch(shop.spark, "stream-counts")
    jobs.window_counts(stream, "ts", out, scratch(shop.spark, "check"))
    return out


@query("stream_hourly_counts", HOURLY_SQL)
def stream_hourly_counts(shop):
    counts = jobs.newest_counts(shop.spark, hourly(shop))
    return counts.select(F.col("inicio").cast("timestamp_ntz").alias("inicio"), "eventos")


@query("stream_peak_alert", f"SELECT * FROM ({HOURLY_SQL}) WHERE eventos > 15")
def stream_peak_alert(shop):
    return jobs.peaks(shop.spark, hourly(shop), 15).select(F.col("inicio").cast("timestamp_ntz").alias("inicio"), "eventos")


@query("stream_dedup", "SELECT DISTINCT event_id FROM events")
def stream_dedup(shop):
    _, stream = timed_events(shop, 1)
    out = scratch(shop.spark, "stream-dedup")
    jobs.dedup(stream, "event_id", "ts", "40 days", out, scratch(shop.spark, "check"))
    return shop.spark.read.parquet(out).select("event_id")


@query("stream_quality_split", "SELECT event_id, event_type, device, motivos FROM chk_events")
def stream_quality_split(shop):
    """A dozen files a batch: copies of an event meet only through its state."""
    lake = landed_events(shop)
    stream = jobs.landing_stream(shop.spark, lake.path("landing", "events"), EVENT_SCHEMA, 20)
    out = scratch(shop.spark, "stream-quality")
    jobs.quality_split(stream, shop.customer_ids(), shop.product_ids(), lake.path("landing"), out, scratch(shop.spark, "check"), RUN)
    good = shop.spark.read.parquet(f"{out}/silver").select("event_id", "event_type", "device", F.lit("").alias("motivos"))
    return good.unionByName(shop.spark.read.parquet(f"{out}/quarantine").select("event_id", "event_type", "device", "motivos"))


@query("stream_sales", "SELECT livro_id, vez, quantidade, motivo, estoque_antes FROM decisoes", recursive=True, **TURNS)
def stream_sales(shop):
    """Three batches, each with the turns that follow the one before; what has landed by a start of the stream is one batch."""
    source, out, check = (scratch(shop.spark, n) for n in ("stream-requests", "stream-sales", "check"))
    turns = cut_lineage(bookstore.in_turn(bookstore.requests(shop)).select("livro_id", "vez", "quantidade"))
    stock = bookstore.books(shop).select(F.col("id").alias("livro_id"), "estoque")
    for k, part in enumerate(("vez <= 8", "vez between 9 and 20", "vez > 20")):
        formats.write_parquet(turns.filter(part), f"{source}/{k}")
        stream = jobs.landing_stream(shop.spark, source, "livro_id bigint, vez bigint, quantidade bigint", fmt="parquet")
        jobs.sales(stream, stock, "livro_id", "vez", "quantidade", out, check)
    return shop.spark.read.parquet(f"{out}/decided").select("livro_id", "vez", "quantidade", "motivo", "estoque_antes")
