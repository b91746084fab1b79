"""Layers of the lake: landing, bronze, silver, quarantine, and published versions."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quartzo.session import cut_lineage
from quartzo.sources import formats
from quartzo.sources.files import relative_key

LAYERS = ("landing", "bronze", "silver", "quarantine", "gold")


LOG = "versao bigint, camada string, tabela string, pasta string"


class Lake:
    """Tables of one lake; ``base`` is any URI Spark can reach.

    A run writes its tables to folders of its own and checks them there. They become visible together, when one row per
    table is appended to a log by a single file; readers take the folders that the highest version in the log names. A table
    that a run didn't write stays where its last version left it. One run publishes at a time.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")
        self.run = f"run-{uuid.uuid4().hex[:12]}"
        self.staged: dict[tuple[str, str], str] = {}

    def _log(self) -> list:
        """Rows of the highest version: one for each table."""
        log = read_or_empty(self.spark, f"{self.base}/_log", LOG)
        top = log.agg(F.max("versao").alias("v")).first().v
        return [] if top is None else log.filter(F.col("versao") == top).collect()

    def version(self) -> int:
        return max((r.versao for r in self._log()), default=0)

    def location(self, layer: str, dataset: str) -> str:
        """Where a table is: as this run staged it, as it was published, or in its plain folder."""
        if layer in ("silver", "quarantine", "gold"):
            if (layer, dataset) in self.staged:
                return f"{self.base}/{self.staged[layer, dataset]}"
            for r in self._log():
                if (r.camada, r.tabela) == (layer, dataset):
                    return f"{self.base}/{r.pasta}"
        return self.path(layer, dataset)

    def stage(self, df: DataFrame, layer: str, dataset: str, by: list[str] | None = None) -> DataFrame:
        """Write a table into this run's folder, where only the run itself reads it."""
        folder = f"{layer}/{dataset}/{self.run}"
        if by:
            formats.write_partitioned(df, f"{self.base}/{folder}", by, full=True)
        else:
            formats.write_parquet(df, f"{self.base}/{folder}")
        self.staged[layer, dataset] = folder
        return self.read(layer, dataset)

    def publish(self) -> int:
        """Make all staged tables visible in one step; returns the new version."""
        now = self._log()
        folders = {**{(r.camada, r.tabela): r.pasta for r in now}, **self.staged}
        version = max((r.versao for r in now), default=0) + 1
        rows = self.spark.createDataFrame([(version, *k, p) for k, p in sorted(folders.items())], LOG)
        rows.coalesce(1).write.mode("append").parquet(f"{self.base}/_log")
        self._begin()
        return version

    def discard(self) -> None:
        """Forget and delete what was staged; published tables stay as they are."""
        for folder in self.staged.values():
            delete(self.spark, f"{self.base}/{folder}")
        self._begin()

    def _begin(self) -> None:
        self.run, self.staged = f"run-{uuid.uuid4().hex[:12]}", {}

    def vacuum(self, keep: int = 2) -> int:
        """Delete folders that none of the last ``keep`` versions names; returns how many."""
        log = read_or_empty(self.spark, f"{self.base}/_log", LOG)
        top = self.version()
        used = log.groupBy("pasta").agg(F.max("versao").alias("last")).filter(F.col("last") <= top - keep).collect()
        for r in used:
            delete(self.spark, f"{self.base}/{r.pasta}")
        return len(used)

    def path(self, layer: str, dataset: str = "") -> str:
        if layer not in LAYERS:
            raise ValueError(f"layer must be one of {LAYERS}")
        return f"{self.base}/{layer}/{dataset}".rstrip("/")

    def read(self, layer: str, dataset: str) -> DataFrame:
        return self.spark.read.parquet(self.location(layer, dataset))

    def write(self, df: DataFrame, layer: str, dataset: str, by: list[str] | None = None) -> str:
        path = self.path(layer, dataset)
        if by:
            formats.write_partitioned(df, path, by)
        else:
            formats.write_parquet(df, path)
        return path

    def inspect(self, layer: str, dataset: str, limit: int, order: list[str]) -> DataFrame:
        """First rows of a dataset in a stated order."""
        return self.read(layer, dataset).orderBy(*order).limit(limit)


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A small table that may not be there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def with_lineage(df: DataFrame, root: str, run_ts: datetime | Column) -> DataFrame:
    """Add the landing key and the run's time; call it right after reading files."""
    stamp = run_ts if isinstance(run_ts, Column) else F.lit(run_ts).cast("timestamp_ntz")
    return df.withColumns(
        {"_source_file": relative_key(F.col("_metadata.file_path"), root), "_ingested_at": stamp}
    )


@contextlib.contextmanager
def folders_as_text(spark: SparkSession) -> Iterator[None]:
    """Values in folder names stay text, whichever folders are read together."""
    name = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def read_landing(spark: SparkSession, path: str | list[str], fmt: str, schema: str | None = None, root: str | None = None) -> DataFrame:
    """Landing files as they came: CSV as text only, JSON with dates as text. ``root``: the folder that listed files lie in."""
    with folders_as_text(spark):
        return _read_landing(spark, path, fmt, schema, root)


def _read_landing(spark: SparkSession, path: str | list[str], fmt: str, schema: str | None, root: str | None) -> DataFrame:
    if fmt == "csv":
        return formats.read_csv_text(spark, path, root)
    if fmt == "jsonl":
        return formats.read_jsonl(spark, path, schema, root)
    if fmt == "json":
        return formats.read_json_array(spark, path, schema, root)
    if fmt == "parquet":
        return formats.based(spark.read, root).parquet(*([path] if isinstance(path, str) else path))
    raise ValueError(f"unknown format {fmt!r}")


MANIFEST = "key string, length bigint, modified timestamp"


def unread_files(lake: Lake, dataset: str) -> DataFrame:
    """path, key, length and modified of the landing files that are new or changed since Bronze last took them."""
    root = lake.path("landing")
    listing = formats.file_sizes(lake.spark, lake.path("landing", dataset)).select(
        "path", relative_key(F.col("path"), root).alias("key"), "length", F.col("modificationTime").alias("modified")
    )
    return listing.join(read_or_empty(lake.spark, _manifest(lake, dataset), MANIFEST), ["key", "length", "modified"], "left_anti")


def _manifest(lake: Lake, dataset: str) -> str:
    return f"{lake.base}/bronze/_manifest/{dataset}"


def bronze(
    spark: SparkSession, lake: Lake, dataset: str, fmt: str, run_ts: datetime, schema: str | None = None
) -> DataFrame:
    """Landing to Bronze: Parquet plus lineage; nothing corrected, nothing dropped. Files that were taken are not read again.

    Each landing file owns one Bronze folder named after it. New and changed files are read and written by one job without
    a shuffle: a task writes to the folders of the files it reads. They are entered in the manifest once their folders are
    written; a run that ends in between is repeated by the next one, which replaces the same folders.
    """
    todo = cut_lineage(unread_files(lake, dataset))
    paths = [r.path for r in todo.select("path").collect()]
    if paths:
        root = lake.path("landing", dataset)
        raw = with_lineage(read_landing(spark, paths, fmt, schema, root), lake.path("landing"), run_ts)
        # Folder names must not depend on characters a file system would escape.
        origin = F.regexp_replace("_source_file", "[^A-Za-z0-9_.-]", "_")
        formats.write_partitioned(raw.withColumn("_origin", origin), lake.path("bronze", dataset), ["_origin"], gather=False)
        todo.select("key", "length", "modified").coalesce(1).write.mode("append").parquet(_manifest(lake, dataset))
    return read_bronze(lake, dataset)


def read_bronze(lake: Lake, dataset: str) -> DataFrame:
    """All Bronze folders of a dataset, columns united by name."""
    return lake.spark.read.option("mergeSchema", True).parquet(lake.path("bronze", dataset)).drop("_origin")


class Versions:
    """All outputs of a batch become visible together.

    Outputs go to a folder of their own version; the last step appends one row to a log.
    Readers use the highest logged version, so a failed batch is never seen.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def current(self) -> int:
        try:
            log = self.spark.read.schema("versao bigint").parquet(f"{self.base}/_log")
            return log.agg(F.coalesce(F.max("versao"), F.lit(0))).first()[0]
        except Exception as error:  # no batch was published yet
            if "PATH_NOT_FOUND" in str(error):
                return 0
            raise

    def path(self, version: int, name: str) -> str:
        return f"{self.base}/v{version}/{name}"

    def publish(self, outputs: dict[str, DataFrame]) -> int:
        version = self.current() + 1
        for name, df in outputs.items():
            formats.write_parquet(df, self.path(version, name))
        self.spark.range(version, version + 1).select(F.col("id").alias("versao")).coalesce(1).write.mode("append").parquet(
            f"{self.base}/_log"
        )
        return version

    def read(self, name: str) -> DataFrame:
        version = self.current()
        if not version:
            raise LookupError("nothing published yet")
        return self.spark.read.parquet(self.path(version, name))
