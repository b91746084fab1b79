"""Books, authors and sales requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartzo.functions.columns import money, to_cents
from quartzo.operators.keys import surrogate_key
from quartzo.operators.quality import Rule
from quartzo.operators.scan import number
from quartzo.operators.stock import settle
from quartzo.plans.storefront import GHOST, Storefront, every


def books(shop: Storefront) -> DataFrame:
    key = F.col("p_partkey")
    return shop.table("part").select(
        key.alias("id"),
        F.col("p_name").alias("titulo"),
        (key + 9780000000000).cast("string").alias("isbn"),
        money("p_retailprice").alias("preco"),
        F.col("p_size").alias("estoque"),
        (key % 10).alias("autor_id"),
    )


def authors(shop: Storefront) -> DataFrame:
    return shop.table("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("nome"))


def requests(shop: Storefront) -> DataFrame:
    """Sales requests from order lines; some name an unknown book or no quantity."""
    return shop.table("lineitem").select(
        F.when(every("l_orderkey", 59), F.col("l_partkey") + GHOST).otherwise(F.col("l_partkey")).alias("livro_id"),
        F.when(every("l_orderkey", 61), F.lit(0)).otherwise(F.col("l_quantity")).cast("bigint").alias("quantidade"),
        F.col("l_shipdate").cast("date").alias("dia"),
        F.col("l_orderkey").alias("pedido"),
        F.col("l_linenumber").cast("bigint").alias("linha"),
        F.col("l_suppkey").alias("vendedor"),
        to_cents("l_extendedprice").alias("centavos"),
        to_cents("l_discount").alias("desconto"),
        to_cents("l_tax").alias("imposto"),
    )


ORDER = ["dia", "pedido", "linha", "vendedor", "quantidade", "centavos", "desconto", "imposto"]


def in_turn(df: DataFrame) -> DataFrame:
    """Number the requests of each book in the order they came."""
    return number(df, ["livro_id"], ORDER, "vez")


def settle_requests(df: DataFrame, stock: DataFrame) -> DataFrame:
    on_hand = stock.select(F.col("id").alias("livro_id"), "estoque")
    return settle(in_turn(df), on_hand, "livro_id", "vez", "quantidade")


def append_books(existing: DataFrame, new: DataFrame, order: str) -> DataFrame:
    """New books with ids that follow the highest one in use."""
    top = existing.agg(F.coalesce(F.max("id"), F.lit(0)).cast("bigint")).scalar()
    return surrogate_key(new, order, "_n").select((F.col("_n") + top).cast("bigint").alias("id"), *new.columns)


def required(columns: list[str]) -> list[Rule]:
    return [Rule(f"{name}_ausente", F.col(name).isNull()) for name in columns]
