"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. They are plain SQL settings, so they can
# be applied to a session somebody else created.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "quartzo", master: str | None = None, extra: dict | None = None) -> SparkSession:
    """Create a session; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        cores = master[master.find("[") + 1 : -1] if "[" in master else ""
        builder = builder.master(master)
        if cores.isdigit():
            builder = builder.config("spark.sql.shuffle.partitions", cores)
    for key, value in {**RUNTIME, **(extra or {})}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` when the cluster names it.

    Only a local master, where driver and executors are one process, may fall back
    to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    root = os.path.join(tempfile.gettempdir(), "quartzo-shared")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/quartzo/{label}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store a frame in the shared folder and go on from the stored copy.

    The copy survives the loss of executors, is computed once, and has a known size. It goes when the driver ends.
    """
    spark = df.sparkSession
    path = scratch(spark, "stored")
    df.write.option("compression", "zstd").parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)
