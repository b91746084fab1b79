"""Watermarks of incremental loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartzo.sources.lake import read_or_empty


class Control:
    """A small log of (fonte, marca, chave); the last mark per source counts.

    A mark of a time alone would skip rows that come later with the same time: ``place`` and ``changed_after`` go on behind
    the last key of that time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def watermark(self, source: str, start: str, kind: str = "string") -> str:
        """The highest mark stored, compared as ``kind``: as a number 10 is above 9, as text it isn't."""
        try:
            log = self.spark.read.schema("fonte string, marca string").parquet(self.path)
            found = log.filter(F.col("fonte") == source).agg(F.max(F.col("marca").cast(kind)).cast("string")).first()[0]
        except Exception as error:  # nothing was loaded yet
            if "PATH_NOT_FOUND" not in str(error):
                raise
            found = None
        return found or start

    def place(self, source: str, start: str, kind: str = "string", key_kind: str = "string") -> tuple[str, str | None]:
        """The highest mark and, of those with its time, the highest key; keys compare as ``key_kind``."""
        log = read_or_empty(self.spark, self.path, "fonte string, marca string, chave string").filter(F.col("fonte") == source)
        both = F.struct(F.col("marca").cast(kind).alias("m"), F.col("chave").cast(key_kind).alias("k"))
        found = log.agg(F.max(both).alias("p")).select(F.col("p.m").cast("string"), F.col("p.k").cast("string")).first()
        return (found[0], found[1]) if found[0] is not None else (start, None)

    def advance(self, source: str, mark: str, key: str | None = None) -> None:
        """Call after the batch was stored; a failed batch leaves the mark where it was."""
        row = self.spark.range(1).select(F.lit(source).alias("fonte"), F.lit(mark).alias("marca"), F.lit(key).cast("string").alias("chave"))
        row.coalesce(1).write.mode("append").parquet(self.path)


def changed_since(df: DataFrame, column: str, mark: str, kind: str) -> DataFrame:
    """Rows after the mark; the literal is cast, not the column, so the filter reaches the scan."""
    return df.filter(F.col(column) > F.lit(mark).cast(kind))


def changed_after(df: DataFrame, column: str, key: str, place: tuple[str, str | None], kind: str) -> DataFrame:
    """Rows behind a place: later ones, and those of the mark's time with a higher key. Both filters reach the scan."""
    mark, last = place
    if last is None:
        return changed_since(df, column, mark, kind)
    time = F.lit(mark).cast(kind)
    return df.filter((F.col(column) >= time) & ((F.col(column) > time) | (F.col(key) > F.lit(last).cast(df.schema[key].dataType))))
