"""Versions, duplicates and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from quartzo.operators.scan import number


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key.

    The rank filter lets Spark drop all but one row per key before the shuffle, so a hot
    key costs one row per map task.
    """
    over = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(over)).filter("_rank = 1").drop("_rank")


def _newest_first(df: DataFrame, keys: list[str], newest: list[str]) -> list[Column]:
    rest = [c for c in df.columns if c not in keys and c not in newest]
    return [F.col(c).desc_nulls_last() for c in newest] + [F.col(c).asc_nulls_last() for c in rest]


def latest_version(df: DataFrame, keys: list[str], newest: list[str]) -> DataFrame:
    """Newest row per key by ``newest`` (highest wins); remaining columns break ties."""
    return first_per_key(df, keys, _newest_first(df, keys, newest))


def drop_duplicate_keys(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key by ascending ``order``; remaining columns break ties."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    return first_per_key(df, keys, [F.col(c).asc_nulls_first() for c in order + rest])


def priority_dedupe(df: DataFrame, keys: list[str], priority: list[Column]) -> DataFrame:
    """Best row per key by a list of priorities, most important first."""
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    return first_per_key(df, keys, priority + rest)


def occurrence(df: DataFrame, keys: list[str], order: list[str], name: str = "ocorrencia") -> DataFrame:
    """1 for the first row of a key, 2 and more for its repeats; remaining columns break ties."""
    return number(df, keys, order, name)


def duplicated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys seen more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("vezes")).filter("vezes > 1")


def surrogate_key(df: DataFrame, natural: str, name: str) -> DataFrame:
    """Dense 1..N by a unique natural key of any sortable type, numbered range by range."""
    return number(df, [], [natural], name).select(name, *df.columns)
