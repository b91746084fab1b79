"""Structured Streaming jobs: the batch plans, fed file by file.

Every sink is keyed by the batch id, so a batch that is repeated after a failure
replaces its own output and nothing is counted twice.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartzo.operators import quality
from quartzo.operators.keys import latest_version
from quartzo.operators.profile import stacked
from quartzo.plans import silver
from quartzo.sources.files import relative_key
from quartzo.sources.formats import write_parquet
from quartzo.streaming import state

BATCH = "_batch"
PARTS = "spark.sql.shuffle.partitions"


def landing_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None, fmt: str = "json") -> DataFrame:
    """Landing files as a stream; the schema is stated, never inferred."""
    reader = spark.readStream.schema(schema).format(fmt).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def run_available(df: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> list:
    """Process everything that is there, batch by batch, then stop; returns the progress of the last batches.

    Every part of the state is opened and committed in every batch, however few rows it has, so there are no more than two for
    each core. A checkpoint keeps to the number it began with.
    """
    spark = df.sparkSession
    given = spark.conf.get(PARTS)
    spark.conf.set(PARTS, min(int(given), 2 * spark.sparkContext.defaultParallelism))
    try:
        job = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(each).start()
        job.awaitTermination()
    finally:
        spark.conf.set(PARTS, given)
    return job.recentProgress


def _store(df: DataFrame, path: str, batch: int) -> None:
    write_parquet(df, f"{path}/{BATCH}={batch}")


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What earlier batches stored; empty before the first."""
    try:
        return spark.read.schema(f"{schema}, {BATCH} bigint").parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], f"{schema}, {BATCH} bigint")


def to_bronze(stream: DataFrame, root: str, out: str, checkpoint: str, run_ts: datetime) -> None:
    """New landing files to Bronze, each exactly once, with lineage."""
    tagged = stream.withColumns(
        {"_source_file": relative_key(F.col("_metadata.file_path"), root), "_ingested_at": F.lit(run_ts).cast("timestamp_ntz")}
    )
    tagged.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", out).trigger(
        availableNow=True
    ).start().awaitTermination()


def window_counts(stream: DataFrame, time: str, out: str, checkpoint: str, width: str = "1 hour", late: str = "1 day") -> None:
    """Counts per window. Each batch stores the windows it changed; see :func:`newest_counts`."""
    counted = (
        stream.withWatermark(time, late).groupBy(F.window(time, width).alias("w")).agg(F.count(F.lit(1)).alias("eventos"))
    )
    flat = counted.select(F.col("w.start").alias("inicio"), "eventos")
    run_available(flat, checkpoint, lambda df, batch: _store(df, out, batch), "update")


def newest_counts(spark: SparkSession, out: str) -> DataFrame:
    """Latest stored count per window, open windows included."""
    return latest_version(_stored(spark, out, "inicio timestamp, eventos bigint"), ["inicio"], [BATCH]).drop(BATCH)


def peaks(spark: SparkSession, out: str, limit: int) -> DataFrame:
    """Windows whose count passes the limit."""
    return newest_counts(spark, out).filter(F.col("eventos") > limit)


def dedup(stream: DataFrame, key: str, time: str, late: str, out: str, checkpoint: str) -> None:
    """First row per key within the lateness bound."""
    once = stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])
    run_available(once, checkpoint, lambda df, batch: _store(df, out, batch))


def quality_split(
    stream: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    root: str,
    out: str,
    checkpoint: str,
    run_ts: datetime,
    keep_ms: int | None = None,
) -> list:
    """Silver and quarantine per batch; copies of events from earlier batches are duplicates too.

    How often an event came before is kept in the state store, by event; no batch reads what earlier ones wrote. Copies within
    the batch are numbered by the batch plan. With ``keep_ms`` an event is forgotten that long after its last copy, which
    takes a processor's state and is slower.
    """
    spark = stream.sparkSession
    tagged = stream.withColumn("_source_file", relative_key(F.col("_metadata.file_path"), root))

    def each(df: DataFrame, batch: int) -> None:
        # Numbering the copies reads the rows more than once; the state is gone through once.
        _store(df, f"{out}/counted", batch)
        rows = spark.read.schema(df.schema).parquet(f"{out}/counted/{BATCH}={batch}")
        base = silver.event_base(rows if keep_ms else state.earlier(rows, "event_id", silver.EARLIER))
        base = base.withColumn("ocorrencia", F.col("ocorrencia") + F.col(silver.EARLIER)).drop(silver.EARLIER)
        # Both outputs come from one stored result, so the checks run once.
        _store(silver.recheck_events(base, customers, products), f"{out}/checked", batch)
        checked = spark.read.parquet(f"{out}/checked/{BATCH}={batch}")
        _store(silver.silver_events(checked), f"{out}/silver", batch)
        _store(silver.quarantine(checked, run_ts), f"{out}/quarantine", batch)

    if keep_ms:
        return run_available(state.with_earlier(tagged, "event_id", silver.EARLIER, keep_ms), checkpoint, each)
    return run_available(state.counted(tagged, "event_id", silver.EARLIER), checkpoint, each, "update")


def sales(stream: DataFrame, stock: DataFrame, key: str, seq: str, qty: str, out: str, checkpoint: str) -> list:
    """Settle requests as they arrive; the stock left is kept in the state store, by key."""
    return run_available(state.settled(stream, stock, key, seq, qty), checkpoint, lambda df, batch: _store(df, f"{out}/decided", batch))


def alert_share(checked: DataFrame, max_pct: int) -> DataFrame:
    """Batches of a quality split that would be blocked."""
    return quality.over_limit(checked, F.col(BATCH), max_pct)


def all_batches(spark: SparkSession, out: str, names: list[str]) -> DataFrame:
    """Rows per output over all batches."""
    return stacked([spark.read.parquet(f"{out}/{n}").agg(F.lit(n).alias("saida"), F.count(F.lit(1)).alias("linhas")) for n in names])
