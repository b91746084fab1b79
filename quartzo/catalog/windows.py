"""Windows, sorting, top-k, unions and reshaping."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quartzo.catalog.base import query
from quartzo.functions.columns import money, money_sum
from quartzo.operators.keys import drop_duplicate_keys, latest_version, occurrence, surrogate_key
from quartzo.operators.profile import replicate
from quartzo.plans import mobility, sales
from quartzo.plans.silver import event_base


@query(
    "latest_version",
    """SELECT order_id, status, total_cents, updated_at FROM raw_orders
       QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC, customer_id, status, channel, total_cents, created_at) = 1""",
)
def newest(shop):
    return latest_version(shop.orders(), ["order_id"], ["updated_at"]).select("order_id", "status", "total_cents", "updated_at")


@query("occurrence_number", "SELECT event_id, _source_file, ocorrencia FROM event_base")
def occurrence_number(shop):
    return event_base(shop.events()).select("event_id", "_source_file", F.col("ocorrencia"))


@query("surrogate_key", "SELECT row_number() OVER (ORDER BY c_custkey) AS sk_cliente, c_custkey, c_name FROM customer")
def surrogate(shop):
    return surrogate_key(shop.table("customer").select("c_custkey", "c_name"), "c_custkey", "sk_cliente")


@query(
    "rank_per_group",
    """WITH r AS (SELECT p.category AS categoria, i.product_id, CAST(sum(i.line_cents) AS BIGINT) AS centavos
       FROM raw_order_items i JOIN raw_products p ON p.product_id = i.product_id GROUP BY 1, 2)
       SELECT categoria, product_id, centavos, CAST(row_number() OVER (PARTITION BY categoria ORDER BY centavos DESC, product_id) AS INTEGER) AS posicao
       FROM r QUALIFY posicao <= 5""",
)
def rank_per_group(shop):
    per = shop.order_items().groupBy("product_id").agg(F.sum("line_cents").alias("centavos"))
    named = per.join(shop.products().select("product_id", F.col("category").alias("categoria")), "product_id")
    place = F.row_number().over(Window.partitionBy("categoria").orderBy(F.desc("centavos"), "product_id"))
    return named.withColumn("posicao", place).filter("posicao <= 5")


@query(
    "cumulative_share",
    """WITH r AS (SELECT p.category AS categoria, CAST(sum(i.line_cents) AS BIGINT) AS centavos
       FROM raw_order_items i JOIN raw_products p ON p.product_id = i.product_id GROUP BY 1)
       SELECT categoria, centavos, round(100.0::DOUBLE * CAST(sum(centavos) OVER (ORDER BY centavos DESC, categoria ROWS UNBOUNDED PRECEDING) AS BIGINT)
              / CAST(sum(centavos) OVER () AS BIGINT), 6) AS pct_acumulado FROM r""",
)
def cumulative_share(shop):
    per = shop.order_items().groupBy("product_id").agg(F.sum("line_cents").alias("centavos"))
    cats = per.join(shop.products().select("product_id", F.col("category").alias("categoria")), "product_id").groupBy("categoria").agg(
        F.sum("centavos").alias("centavos")
    )
    # The window holds one row per category.
    upto = F.sum("centavos").over(Window.orderBy(F.desc("centavos"), "categoria").rowsBetween(Window.unboundedPreceding, 0))
    share = F.lit(100.0) * upto / F.sum("centavos").over(Window.partitionBy(F.lit(1)))
    return cats.select("categoria", "centavos", F.round(share, 6).alias("pct_acumulado"))


DAYS_SQL = "SELECT CAST(o_orderdate AS DATE) AS dia, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS total FROM orders GROUP BY 1"


def per_day(shop):
    return shop.table("orders").groupBy(F.col("o_orderdate").cast("date").alias("dia")).agg(
        money_sum("o_totalprice").alias("total")
    )


@query(
    "running_total",
    f"SELECT dia, total, CAST(sum(total) OVER (ORDER BY dia ROWS UNBOUNDED PRECEDING) AS DECIMAL(20,2)) AS acumulado FROM ({DAYS_SQL})",
)
def running_total(shop):
    # The window holds one row per calendar day.
    upto = F.sum("total").over(Window.orderBy("dia").rowsBetween(Window.unboundedPreceding, 0))
    return per_day(shop).withColumn("acumulado", upto.cast("decimal(20,2)"))


@query(
    "moving_average",
    f"""SELECT dia, total, round(CAST(sum(total) OVER w AS DOUBLE) / count(*) OVER w, 4) AS media_7 FROM ({DAYS_SQL})
        WINDOW w AS (ORDER BY dia ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
)
def moving_average(shop):
    last = Window.orderBy("dia").rowsBetween(-6, 0)
    return per_day(shop).withColumn("media_7", F.round(F.sum("total").over(last).cast("double") / F.count(F.lit(1)).over(last), 4))


@query("head_n", "SELECT evento_id, data_hora, cidade, modal FROM mobility ORDER BY data_hora, evento_id, modal LIMIT 5")
def head_n(shop):
    return mobility.trips(shop).orderBy("data_hora", "evento_id", "modal").limit(5).select("evento_id", "data_hora", "cidade", "modal")


@query("top_k_revenue", "SELECT data, categoria, pedidos, itens, receita FROM mart_receita ORDER BY receita DESC, data, categoria LIMIT 20")
def top_k_revenue(shop):
    from quartzo.catalog.gold import mart, sales_tables

    return mart("mart_receita_categoria_dia", sales_tables(shop)).orderBy(F.desc("receita"), "data", "categoria").limit(20)


@query("sort_desc", "SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS total FROM orders ORDER BY total DESC, o_orderkey")
def sort_desc(shop):
    return shop.table("orders").select("o_orderkey", money("o_totalprice").alias("total")).orderBy(F.desc("total"), "o_orderkey")


@query("union_all", "SELECT evento_id, data_hora, modal FROM mobility")
def union_all(shop):
    once = mobility.first_trips(shop)
    return once.unionByName(once.filter(F.col("evento_id") % 53 == 0)).select("evento_id", "data_hora", "modal")


@query("replicate_rows", "SELECT event_id, user_id, CAST(c AS INTEGER) AS copia FROM events, range(1, 5) AS r(c)")
def replicate_rows(shop):
    return replicate(shop.table("events").select("event_id", "user_id"), 4)


@query("drop_duplicate_keys", "SELECT DISTINCT ON (evento_id) evento_id, data_hora, cidade, modal FROM mobility ORDER BY evento_id, data_hora NULLS FIRST, cidade NULLS FIRST, modal NULLS FIRST, distancia_km NULLS FIRST, duracao_min NULLS FIRST, status NULLS FIRST, fonte NULLS FIRST")
def drop_duplicates(shop):
    return drop_duplicate_keys(mobility.trips(shop), ["evento_id"], ["data_hora"]).select("evento_id", "data_hora", "cidade", "modal")


@query(
    "evidence_table",
    """WITH g AS (SELECT count(*) AS n, count(DISTINCT data_hora) AS i, count(DISTINCT fonte) AS f,
       count(*) FILTER (WHERE distancia_km IS NULL) AS a, count(DISTINCT cidade) AS c FROM mobility)
       SELECT 'Volume' AS v, n || ' linhas' AS evidencia, 'processar em partes' AS decisao FROM g
       UNION ALL SELECT 'Velocidade', i || ' instantes', 'lote ou fluxo' FROM g
       UNION ALL SELECT 'Variedade', f || ' fontes', 'esquema comum' FROM g
       UNION ALL SELECT 'Veracidade', a || ' distâncias ausentes', 'tratar antes de usar' FROM g
       UNION ALL SELECT 'Valor', c || ' cidades', 'indicador por cidade' FROM g""",
)
def evidence_table(shop):
    return mobility.evidence(mobility.trips(shop))
