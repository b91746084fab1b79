"""Performance jobs: one result, several ways to it."""

from __future__ import annotations

from pyspark.sql import functions as F

from quartzo.catalog.base import query
from quartzo.functions.columns import cents_to_money, to_cents
from quartzo.operators.profile import stacked
from quartzo.plans import tuning
from quartzo.session import scratch
from quartzo.sources import formats


def lines(shop):
    return shop.table("lineitem").select(F.col("l_orderkey").alias("order_id"), cents_to_money(to_cents("l_extendedprice")).alias("valor"))


def statuses(shop):
    return shop.table("orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"))


@query(
    "explain_compare",
    """SELECT o_orderstatus AS status, count(*) AS linhas, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS valor, plano
       FROM lineitem JOIN orders ON o_orderkey = l_orderkey, (SELECT unnest(['juntar_antes', 'somar_antes']) AS plano) GROUP BY o_orderstatus, plano""",
)
def explain_compare(shop):
    return stacked(
        [
            tuning.revenue_join_first(lines(shop), statuses(shop)).withColumn("plano", F.lit("juntar_antes")),
            tuning.revenue_sum_first(lines(shop), statuses(shop)).withColumn("plano", F.lit("somar_antes")),
        ]
    )


@query(
    "repartition_effect",
    "SELECT p AS particoes, p AS ocupadas, count(*) AS linhas FROM lineitem, (SELECT CAST(unnest([4, 16, 64]) AS BIGINT) AS p) GROUP BY p",
)
def repartition_effect(shop):
    def spread(n: int):
        per = shop.table("lineitem").select("l_orderkey").repartition(n).groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
        return per.agg(
            F.lit(n).cast("bigint").alias("particoes"), F.count_if(F.col("n") > 0).alias("ocupadas"), F.sum("n").alias("linhas")
        )

    return stacked([spread(n) for n in (4, 16, 64)])


@query(
    "cache_reuse",
    """SELECT 'status' AS visao, o_orderstatus AS grupo, count(*) AS pedidos FROM orders GROUP BY 2
       UNION ALL SELECT 'prioridade', o_orderpriority, count(*) FROM orders GROUP BY 2""",
)
def cache_reuse(shop):
    shown = shop.table("orders").select("o_orderstatus", "o_orderpriority")
    views = {"status": "o_orderstatus", "prioridade": "o_orderpriority"}
    outs = []
    with tuning.kept(shown) as base:
        for view, column in views.items():
            out = scratch(shop.spark, f"view-{view}")
            formats.write_parquet(
                base.groupBy(F.col(column).alias("grupo")).agg(F.count(F.lit(1)).alias("pedidos")).withColumn("visao", F.lit(view)), out
            )
            outs.append(shop.spark.read.parquet(out))
    return stacked(outs).select("visao", "grupo", "pedidos")


@query(
    "early_filter_prune",
    """SELECT o_orderstatus, count(*) AS pedidos, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS total, plano
       FROM orders, (SELECT unnest(['cedo', 'tarde']) AS plano) WHERE o_orderdate >= TIMESTAMP '1999-01-01' GROUP BY o_orderstatus, plano""",
)
def early_filter_prune(shop):
    orders = shop.table("orders")
    return stacked(
        [
            tuning.early(orders, "1999-01-01").withColumn("plano", F.lit("cedo")),
            tuning.late(orders, "1999-01-01").withColumn("plano", F.lit("tarde")),
        ]
    )


@query(
    "salted_aggregation",
    """SELECT l_suppkey % 3 AS grupo, count(*) AS linhas, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS valor
       FROM lineitem GROUP BY 1""",
)
def salted_aggregation(shop):
    rows = shop.table("lineitem").select((F.col("l_suppkey") % 3).alias("grupo"), "l_orderkey", "l_linenumber", cents_to_money(to_cents("l_extendedprice")).alias("v"))
    return tuning.salted_sum(rows, "grupo", "v", ["l_orderkey", "l_linenumber"])


@query("optimization_log")
def optimization_log(shop):
    orders = shop.table("orders")
    return tuning.measured(
        shop.spark,
        {
            "juntar_antes": lambda: tuning.revenue_join_first(lines(shop), statuses(shop)),
            "somar_antes": lambda: tuning.revenue_sum_first(lines(shop), statuses(shop)),
            "filtro_tarde": lambda: tuning.late(orders, "1999-01-01"),
            "filtro_cedo": lambda: tuning.early(orders, "1999-01-01"),
        },
    )
