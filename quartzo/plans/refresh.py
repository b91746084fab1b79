"""Marts kept up day by day: what changed in Silver decides which cells are worked out anew."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartzo.plans.gold import mart_revenue_by_category_day
from quartzo.session import cut_lineage
from quartzo.sources import formats
from quartzo.sources.lake import delete


def changed_rows(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the rows that are new, gone or different."""
    columns = after.columns
    sides = before.select(*columns, F.lit(-1).alias("_n")).unionByName(after.select(*columns, F.lit(1).alias("_n")))
    return sides.groupBy(*columns).agg(F.sum("_n").alias("_n")).filter("_n <> 0").select(*keys).distinct()


def affected_days(facts: list[DataFrame], days: DataFrame, products: DataFrame) -> DataFrame:
    """sk_data of all cells that may differ: the days themselves, and days on which one of the products was sold."""
    sold = [f.join(products.select("sk_produto"), "sk_produto", "left_semi").select("sk_data") for f in facts]
    out = days.select("sk_data")
    for s in sold:
        out = out.unionByName(s)
    return out.distinct()


def write_revenue(cells: DataFrame, path: str) -> None:
    """Store a revenue mart in a folder for each month."""
    formats.write_partitioned(cells.withColumn("mes", F.date_format("data", "yyyy-MM")), path, ["mes"])


def refresh_revenue(path: str, fact: DataFrame, dates: DataFrame, products: DataFrame, days: DataFrame) -> int:
    """Replace the days' cells of the stored mart by what the fact has now; returns the number of days.

    Only these days' facts are read; other cells of their months are taken over as they are stored, other months' folders
    are not touched. Days are as many as a calendar has, so they may be listed. A month without revenue loses its folder.
    """
    spark = fact.sparkSession
    todo = dates.join(days, "sk_data", "left_semi").select("sk_data", "data").collect()
    if not todo:
        return 0
    months = sorted({f"{r.data:%Y-%m}" for r in todo})
    fresh = mart_revenue_by_category_day(fact.filter(F.col("sk_data").isin([r.sk_data for r in todo])), dates, products)
    stored = spark.read.parquet(path).filter(F.col("mes").isin(months) & ~F.col("data").isin([r.data for r in todo]))
    both = cut_lineage(stored.select(*fresh.columns).unionByName(fresh))  # the folders that are read are about to be replaced
    write_revenue(both, path)
    there = {r.mes for r in both.select(F.date_format("data", "yyyy-MM").alias("mes")).distinct().collect()}
    for month in set(months) - there:
        delete(spark, f"{path}/mes={month}")
    return len(todo)
