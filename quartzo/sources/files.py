"""Which files changed, and which are new."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quartzo.sources.formats import file_sizes

WHOLE_FILE = 128 * 1024 * 1024


def relative_key(path: Column, root: str) -> Column:
    """The path below ``root``, whatever scheme the file system reports."""
    tail = root.split("://", 1)[-1]
    if root.startswith("file:"):
        tail = root[len("file:") :].lstrip("/")
    tail = tail.strip("/")
    return F.element_at(F.split(path, f"\\Q{tail}/\\E", 2), -1)


def _digest_large(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    for batch in batches:
        shas = []
        for path in batch["path"]:
            system, name = fs.FileSystem.from_uri(path)
            digest = hashlib.sha256()
            with system.open_input_stream(name) as stream:
                while block := stream.read(8 * 1024 * 1024):
                    digest.update(block)
            shas.append(digest.hexdigest())
        yield batch[["path", "length"]].assign(sha=shas)


def manifest(spark: SparkSession, root: str, whole_file: int = WHOLE_FILE) -> DataFrame:
    """(key, length, sha) of every file below ``root``.

    Files up to ``whole_file`` bytes are hashed in the JVM; longer ones are read block by
    block, so no task holds a large file in memory.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    small = (
        reader.load(root)
        .filter(F.col("length") <= whole_file)
        .select("path", "length", F.sha2("content", 256).alias("sha"))
    )
    large = file_sizes(spark, root).filter(F.col("length") > whole_file).select("path", "length")
    large = large.mapInPandas(_digest_large, "path string, length bigint, sha string")
    return small.unionByName(large).select(relative_key(F.col("path"), root).alias("key"), "length", "sha")


def changed_files(source: DataFrame, target: DataFrame) -> DataFrame:
    """Entries of the source manifest whose content the target lacks."""
    return source.join(target.select("key", "sha"), ["key", "sha"], "left_anti")


def publish_report(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: objects to upload, objects skipped, bytes to upload."""
    known = target.select("key", "sha", F.lit(True).alias("_known"))
    marked = source.join(known, ["key", "sha"], "left")
    new = F.col("_known").isNull()
    return marked.agg(
        F.count_if(new).alias("enviados"),
        F.count_if(~new).alias("ignorados"),
        F.coalesce(F.sum(F.when(new, F.col("length"))), F.lit(0)).alias("bytes_enviados"),
    )


def new_files(listing: DataFrame, seen: DataFrame) -> DataFrame:
    """Files of a listing that the manifest of processed files does not name."""
    return listing.join(seen.select("key"), "key", "left_anti")
