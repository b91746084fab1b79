"""Profiling: what is in a table and how much of it is unusable."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_col_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("linhas"), F.lit(len(df.columns)).alias("colunas"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value, most frequent first."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("linhas"))
    return counted.orderBy(F.desc("linhas"), column)


def column_types(df: DataFrame) -> DataFrame:
    """Name, type and number of filled values per column, in one pass."""
    filled = df.agg(*[F.count(c).alias(c) for c in df.columns])
    kinds = dict(df.dtypes)
    pairs = ", ".join(f"'{c}', '{kinds[c]}', `{c}`" for c in df.columns)
    return filled.selectExpr(f"stack({len(df.columns)}, {pairs}) as (coluna, tipo, preenchidos)")


def null_pct(df: DataFrame) -> DataFrame:
    """Missing values per column in percent, in one pass; NaN counts as missing."""
    kinds = dict(df.dtypes)
    missing = lambda c: F.col(c).isNull() | F.isnan(c) if kinds[c] in ("double", "float") else F.col(c).isNull()
    counted = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(missing(c)).alias(c) for c in df.columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    long = counted.selectExpr("_rows", f"stack({len(df.columns)}, {pairs}) as (coluna, ausentes)")
    share = F.col("ausentes").cast("decimal(20,0)") * 100 / F.greatest("_rows", F.lit(1)).cast("decimal(20,0)")
    return long.select("coluna", "ausentes", F.round(share, 2).cast("decimal(7,2)").alias("pct"))


def repeats(key: str) -> Column:
    """Rows beyond the first per key, as an aggregate; missing keys are one group."""
    return F.count(F.lit(1)) - F.count_distinct(F.col(key)) - F.max(F.col(key).isNull().cast("int"))


def replicate(df: DataFrame, times: int, name: str = "copia") -> DataFrame:
    """Every row ``times`` times, copies numbered from 1; needs no shuffle."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(1), F.lit(int(times)))))


def growth(df: DataFrame, factors: list[int], row_bytes: Column) -> DataFrame:
    """Rows and estimated bytes of the table repeated by each factor, in one pass."""
    copies = F.explode(F.array(*[F.lit(f) for f in factors])).alias("fator")
    base = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes).cast("bigint").alias("b"))
    return base.select(copies, "n", "b").select(
        "fator", (F.col("n") * F.col("fator")).alias("linhas"), (F.col("b") * F.col("fator")).alias("bytes")
    )


def stacked(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
