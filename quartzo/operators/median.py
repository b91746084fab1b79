"""Exact median of a column of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartzo.operators.scan import running_sum

#: A quantile of the sketch is at most 1/ACCURACY of all rows away from the true rank.
ACCURACY = 10_000


def exact_median(df: DataFrame, value: str, name: str = "mediana", accuracy: int = ACCURACY) -> DataFrame:
    """One row with the interpolated median; NULL and NaN are left out.

    Two reads: a quantile sketch gives two values that surely enclose the middle rows; then the rows between them are
    counted by value, and all rows below them as one. What is left to sort is a few in ``accuracy`` of the rows, and a value
    shared by many rows is one row.
    """
    v = F.col("v")
    rows = df.select(F.col(value).cast("double").alias("v")).filter(v.isNotNull() & ~F.isnan(v))
    margin = 2 / accuracy
    around = [max(0.0, 0.5 - margin), min(1.0, 0.5 + margin)]
    n, ends = rows.agg(F.count(v), F.percentile_approx(v, around, accuracy)).first()
    if not n:
        return rows.agg(F.max(v).alias(name))
    low, high = ends
    counted = rows.filter(v <= high).groupBy(F.when(v >= low, v).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    upto = running_sum(counted, [], ["v"], "n", "upto")
    at = lambda rank: F.min(F.when(F.col("upto") >= rank, v))
    return upto.agg(((at((n + 1) // 2) + at((n + 2) // 2)) / 2).alias(name))
