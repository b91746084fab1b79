"""The way of one order item through the layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def trace(
    item_id: Column | int,
    bronze: DataFrame,
    silver: DataFrame,
    fact: DataFrame,
    dates: DataFrame,
    products: DataFrame,
) -> DataFrame:
    """Landing key, rows per layer and the mart cell an item ends up in.

    The item filter reaches every scan; the layers meet on one item only.
    """
    wanted = F.lit(item_id) if isinstance(item_id, int) else item_id
    b = bronze.filter(F.col("item_id") == wanted).groupBy("item_id").agg(
        F.min("_source_file").alias("arquivo_landing"), F.count(F.lit(1)).alias("linhas_bronze")
    )
    s = silver.filter(F.col("item_id") == wanted).groupBy("item_id").agg(F.count(F.lit(1)).alias("linhas_silver"))
    f = fact.filter(F.col("item_id") == wanted).select("item_id", "order_id", "sk_data", "sk_produto", "valor_bruto")
    cell = f.join(dates.select("sk_data", "data"), "sk_data", "left").join(
        products.select("sk_produto", "categoria"), "sk_produto", "left"
    )
    return b.join(s, "item_id", "left").join(cell, "item_id", "left").select(
        "item_id", "arquivo_landing", "linhas_bronze", "linhas_silver", "order_id", "data", "categoria", "valor_bruto"
    )
