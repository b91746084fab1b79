"""Extracting tables from a relational source in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def range_predicates(column: str, low: int, high: int, pieces: int) -> list[str]:
    """Conditions that cut the key range into pieces; together they cover every row once.

    The outer pieces are open, so rows outside low..high and NULLs are not lost.
    """
    pieces = max(1, min(pieces, high - low + 1))
    edges = [low + (high - low + 1) * i // pieces for i in range(1, pieces)]
    if not edges:
        return ["1 = 1"]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(edges, edges[1:])]
    return [f"{column} < {edges[0]} OR {column} IS NULL", *inner, f"{column} >= {edges[-1]}"]


def read_relational(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    pieces: int = 32,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A table, or a query in parentheses with an alias, read by key ranges.

    Needs the source's JDBC driver on the class path.
    """
    properties = properties or {}
    bounds = spark.read.jdbc(url, f"(SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}) AS bounds", properties=properties)
    low, high = bounds.first()
    if low is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(url, table, predicates=range_predicates(key, int(low), int(high), pieces), properties=properties)


def read_increment(
    spark: SparkSession, url: str, table: str, changed: str, watermark: str, properties: dict[str, str] | None = None
) -> DataFrame:
    """Rows changed after the stored watermark; the filter runs in the source."""
    return spark.read.jdbc(url, table, predicates=[f"{changed} > '{watermark}'"], properties=properties or {})
