"""The sales table of the format lessons."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartzo.functions.columns import cents_to_money, line_total
from quartzo.plans.storefront import Storefront


def sales(shop: Storefront) -> DataFrame:
    items = shop.order_items().select(
        "item_id", F.col("shipped_on").alias("data_hora"), "seller_id", "product_id",
        F.col("quantity").alias("quantidade"), cents_to_money("unit_price_cents").alias("preco_unitario"),
        F.col("discount_pct").alias("desconto_pct"),
    )
    state = shop.suppliers().select(F.col("supplier_id").alias("seller_id"), F.col("state").alias("estado"))
    category = shop.products().select("product_id", F.col("category").alias("categoria"))
    return items.join(state, "seller_id").join(category, "product_id").select(
        "item_id", "data_hora", "estado", "categoria", "quantidade", "preco_unitario", "desconto_pct"
    )


def with_total(df: DataFrame) -> DataFrame:
    return df.withColumn("valor_total", line_total("quantidade", "preco_unitario", "desconto_pct"))
