"""Reading and writing CSV, JSON Lines, JSON arrays and Parquet."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CODECS = ("zstd", "snappy", "gzip", "none")


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header; types from ``schema``, else inferred (which reads the text twice)."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def based(reader: DataFrameReader, root: str | None) -> DataFrameReader:
    """Columns in the names of folders below ``root`` are kept when single files are listed."""
    return reader.option("basePath", root) if root else reader


def read_csv_text(spark: SparkSession, path: str | list[str], root: str | None = None) -> DataFrame:
    """CSV with every value kept as text, so no value can break the load."""
    return based(spark.read, root).option("header", True).csv(path)


def read_jsonl(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None, root: str | None = None) -> DataFrame:
    """One JSON object per line; dates stay text unless ``schema`` says otherwise."""
    reader = based(spark.read, root)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_json_array(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None, root: str | None = None) -> DataFrame:
    """Files that each hold one JSON array; parallel across files."""
    reader = based(spark.read, root).option("multiLine", True)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_parquet(spark: SparkSession, path: str | list[str], columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return df.select(*columns) if columns else df


def read_union_by_name(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet files below a folder; columns missing in some files become NULL."""
    return spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(path)


def write_parquet(df: DataFrame, path: str, codec: str = "zstd", mode: str = "overwrite") -> None:
    if codec not in CODECS:
        raise ValueError(f"codec must be one of {CODECS}")
    df.write.mode(mode).option("compression", codec).parquet(path)


def write_partitioned(
    df: DataFrame, path: str, by: list[str], codec: str = "zstd", max_records: int = 5_000_000, gather: bool = True, full: bool = False
) -> None:
    """Write one folder per value of ``by``. Folders that get no rows stay as they are, unless the table is rebuilt in ``full``.

    Gathering rebalances rows by folder, so that each has few files, and splits a folder
    that holds a large share of the rows over several tasks. Rows that already lie
    together, as when each folder belongs to one input file, need no such shuffle.
    """
    laid = df.hint("rebalance", *by) if gather else df
    (
        laid.write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if full else "dynamic")
        .option("compression", codec)
        .option("maxRecordsPerFile", max_records)
        .partitionBy(*by)
        .parquet(path)
    )


def write_as(df: DataFrame, fmt: str, path: str) -> None:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    elif fmt == "jsonl":
        writer.json(path)
    elif fmt == "parquet":
        writer.option("compression", "zstd").parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def convert_to_parquet(spark: SparkSession, source: str, fmt: str, target: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV or JSON Lines to Parquet, all rows; returns the Parquet copy."""
    readers = {"csv": read_csv, "jsonl": read_jsonl}
    write_parquet(readers[fmt](spark, source, schema), target)
    return read_parquet(spark, target)


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Path and length of every data file below a folder; contents are not read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
    )


def size_report(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """KB per format, smallest first."""
    sizes = [file_sizes(spark, p).select(F.lit(f).alias("formato"), "length") for f, p in paths.items()]
    total = reduce(DataFrame.unionByName, sizes).groupBy("formato").agg(F.sum("length").alias("bytes"))
    return total.select("formato", "bytes", F.round(F.col("bytes") / 1024, 1).alias("kb")).orderBy("bytes")


def compact(spark: SparkSession, source: str, target: str, target_bytes: int = 256 * 1024 * 1024, by: list[str] | None = None) -> int:
    """Rewrite many small files as files of about ``target_bytes``; returns their number, which only the bytes decide."""
    total = file_sizes(spark, source).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    files = max(1, -(-int(total) // target_bytes))
    df = spark.read.parquet(source)
    if by:
        write_partitioned(df, target, by)
    else:
        write_parquet(df.repartition(files), target)
    return files
