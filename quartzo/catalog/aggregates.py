"""Aggregation."""

from __future__ import annotations

from pyspark.sql import functions as F

from quartzo.catalog.base import query
from quartzo.functions.columns import cents_to_money, money_sum
from quartzo.operators.keys import duplicated_keys
from quartzo.operators.median import exact_median
from quartzo.operators.profile import row_col_count, stacked, value_counts
from quartzo.plans import mobility, sales, silver
from quartzo.session import cut_lineage


@query("row_col_count", "SELECT count(*) AS linhas, 8 AS colunas FROM mobility")
def rows_and_columns(shop):
    return row_col_count(mobility.trips(shop))


@query("value_counts", "SELECT modal, count(*) AS linhas FROM mobility WHERE modal IS NOT NULL GROUP BY modal ORDER BY linhas DESC, modal")
def counts_per_value(shop):
    return value_counts(mobility.trips(shop), "modal")


@query("events_per_hour", "SELECT CAST(hour(ts) AS INTEGER) AS hora, count(*) AS eventos FROM events GROUP BY 1 ORDER BY 1")
def events_per_hour(shop):
    return shop.table("events").groupBy(F.hour("ts").alias("hora")).agg(F.count(F.lit(1)).alias("eventos")).orderBy("hora")


@query(
    "peak_hour",
    "SELECT CAST(hour(ts) AS INTEGER) AS hora, count(*) AS eventos FROM events GROUP BY 1 ORDER BY eventos DESC, hora LIMIT 1",
)
def peak_hour(shop):
    return events_per_hour(shop).orderBy(F.desc("eventos"), "hora").limit(1)


@query("nunique", "SELECT count(DISTINCT cidade) AS cidades, count(DISTINCT modal) AS modais, count(DISTINCT evento_id) AS viagens FROM mobility")
def nunique(shop):
    return mobility.trips(shop).agg(
        F.count_distinct("cidade").alias("cidades"), F.count_distinct("modal").alias("modais"), F.count_distinct("evento_id").alias("viagens")
    )


@query(
    "mean_by_group",
    """SELECT cidade, CAST(round(CAST(sum(distancia_km) AS DOUBLE) / count(distancia_km), 2) AS DECIMAL(12,2)) AS distancia_media,
       CAST(round(CAST(sum(duracao_min) AS DOUBLE) / count(duracao_min), 2) AS DECIMAL(12,2)) AS duracao_media, count(*) AS viagens
       FROM mob_valid GROUP BY cidade""",
)
def mean_by_group(shop):
    return mobility.means(mobility.valid(mobility.trips(shop)), "cidade")


@query(
    "sum_by_state",
    "SELECT estado, CAST(sum(valor_total) AS DECIMAL(18,2)) AS total FROM sales_total GROUP BY estado ORDER BY total DESC, estado",
)
def sum_by_state(shop):
    # Items are summed per seller first, so only one row per seller meets the states.
    per = sales.with_total(
        shop.order_items().select(
            "seller_id",
            F.col("quantity").alias("quantidade"),
            cents_to_money("unit_price_cents").alias("preco_unitario"),
            F.col("discount_pct").alias("desconto_pct"),
        )
    ).groupBy("seller_id").agg(F.sum("valor_total").alias("total"))
    states = shop.suppliers().select(F.col("supplier_id").alias("seller_id"), F.col("state").alias("estado"))
    return (
        per.join(states, "seller_id").groupBy("estado").agg(F.sum("total").cast("decimal(18,2)").alias("total")).orderBy(F.desc("total"), "estado")
    )


@query("sum_qty_by_category", "SELECT categoria, CAST(sum(quantidade) AS BIGINT) AS quantidade FROM sales GROUP BY categoria")
def sum_qty_by_category(shop):
    return sales.sales(shop).groupBy("categoria").agg(F.sum("quantidade").alias("quantidade"))


@query("global_median", "SELECT round(median(CAST(distancia_km AS DOUBLE)), 3) AS mediana FROM mobility")
def global_median(shop):
    return exact_median(mobility.trips(shop), "distancia_km").select(F.round("mediana", 3).alias("mediana"))


@query(
    "mean_raw_vs_treated",
    """SELECT round(bruto, 4) AS bruto, round(tratado, 4) AS tratado, round(tratado - bruto, 4) AS diferenca FROM
       (SELECT CAST(sum(duracao_min) AS DOUBLE) / count(duracao_min) AS bruto FROM mobility),
       (SELECT CAST(sum(duracao_min) AS DOUBLE) / count(duracao_min) AS tratado FROM mob_valid)""",
)
def mean_raw_vs_treated(shop):
    raw = mobility.trips(shop)
    side = lambda df, tag: df.select(F.lit(tag).alias("lado"), "duracao_min")
    both = side(raw, "bruto").unionByName(side(mobility.valid(raw), "tratado"))
    mean = lambda tag: (
        F.sum(F.when(F.col("lado") == tag, F.col("duracao_min"))).cast("double")
        / F.count(F.when(F.col("lado") == tag, F.col("duracao_min")))
    )
    sums = both.agg(mean("bruto").alias("b"), mean("tratado").alias("t"))
    return sums.select(
        F.round("b", 4).alias("bruto"), F.round("t", 4).alias("tratado"), F.round(F.col("t") - F.col("b"), 4).alias("diferenca")
    )


@query("count_by_event_type", "SELECT event_type, count(*) AS eventos FROM silver_events GROUP BY 1 ORDER BY eventos DESC, event_type")
def count_by_event_type(shop):
    checked = silver.check_events(shop.events(), shop.customer_ids(), shop.product_ids())
    return (
        silver.silver_events(checked).groupBy("event_type").agg(F.count(F.lit(1)).alias("eventos")).orderBy(F.desc("eventos"), "event_type")
    )


@query(
    "distinct_order_count",
    """SELECT l_partkey % 12 AS grupo, count(DISTINCT l_orderkey) AS pedidos, CAST(sum(l_quantity) AS BIGINT) AS itens,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS receita FROM lineitem GROUP BY 1""",
)
def distinct_order_count(shop):
    lines = shop.table("lineitem").select((F.col("l_partkey") % 12).alias("grupo"), "l_orderkey", "l_quantity", "l_extendedprice")
    return lines.groupBy("grupo").agg(
        F.count_distinct("l_orderkey").alias("pedidos"),
        F.sum("l_quantity").cast("bigint").alias("itens"),
        money_sum("l_extendedprice").alias("receita"),
    )


PRIORITY_SQL = """SELECT o_orderpriority AS prioridade, count(*) AS pedidos,
       CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS total FROM orders GROUP BY 1"""


@query(
    "sql_df_equivalence",
    f"SELECT t.*, v.via FROM ({PRIORITY_SQL}) t, (SELECT unnest(['sql', 'dataframe']) AS via) v",
)
def sql_df_equivalence(shop):
    orders = shop.table("orders")
    by_api = (
        orders.groupBy(F.col("o_orderpriority").alias("prioridade"))
        .agg(F.count(F.lit(1)).alias("pedidos"), money_sum("o_totalprice").alias("total"))
    )
    by_sql = shop.spark.sql(PRIORITY_SQL.replace("FROM orders", "FROM {orders}"), orders=orders)
    return stacked([by_sql.withColumn("via", F.lit("sql")), by_api.withColumn("via", F.lit("dataframe"))])


@query("group_by_all", "SELECT o_orderstatus, o_orderpriority, count(*) AS pedidos FROM orders GROUP BY ALL")
def group_by_all(shop):
    return shop.spark.sql(
        "SELECT o_orderstatus, o_orderpriority, count(*) AS pedidos FROM {orders} GROUP BY ALL", orders=shop.table("orders")
    )


@query("having_duplicates", "SELECT event_id, count(*) AS vezes FROM raw_events GROUP BY event_id HAVING count(*) > 1")
def having_duplicates(shop):
    return duplicated_keys(shop.events(), ["event_id"])


@query(
    "scalar_subquery_counts",
    """SELECT CAST(sum(b) AS BIGINT) AS bronze, CAST(sum(s) AS BIGINT) AS silver, CAST(sum(q) AS BIGINT) AS quarentena
       FROM (SELECT 1 AS b, 0 AS s, 0 AS q FROM raw_events UNION ALL SELECT 0, 1, 0 FROM silver_events
             UNION ALL SELECT 0, 0, 1 FROM (SELECT DISTINCT event_id, ocorrencia FROM violations))""",
)
def scalar_subquery_counts(shop):
    from quartzo.operators.quality import rejected
    from quartzo.plans.validate import counts

    events = shop.events()
    checked = cut_lineage(silver.check_events(events, shop.customer_ids(), shop.product_ids()))
    return counts({"bronze": events, "silver": silver.silver_events(checked), "quarentena": rejected(checked)})


@query(
    "conditional_count",
    """SELECT count(*) FILTER (WHERE distancia_km IS NULL) AS sem_distancia,
       count(*) FILTER (WHERE duracao_min <= 0 OR duracao_min > 240) AS duracao_invalida,
       count(*) FILTER (WHERE modal = 'Onibus') AS grafia FROM mobility""",
)
def conditional_count(shop):
    return mobility.trips(shop).agg(
        F.count_if(F.col("distancia_km").isNull()).alias("sem_distancia"),
        F.count_if((F.col("duracao_min") <= 0) | (F.col("duracao_min") > 240)).alias("duracao_invalida"),
        F.count_if(F.col("modal") == "Onibus").alias("grafia"),
    )


@query(
    "order_payment_matrix",
    """SELECT o.status AS pedido, p.status AS pagamento, count(*) AS pedidos FROM stg_orders o
       LEFT JOIN stg_payments p ON p.order_id = o.order_id GROUP BY ALL""",
)
def order_payment_matrix(shop):
    orders = silver.stg_orders(shop.orders()).select("order_id", F.col("status").alias("pedido"))
    payments = silver.stg_payments(shop.payments()).select("order_id", F.col("status").alias("pagamento"))
    return orders.join(payments, "order_id", "left").groupBy("pedido", "pagamento").agg(F.count(F.lit(1)).alias("pedidos"))


@query(
    "avg_ticket_by_region",
    """SELECT r_name AS regiao, count(*) AS pedidos,
       round(CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) / count(DISTINCT o_orderkey), 4) AS ticket_medio
       FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
       JOIN region ON r_regionkey = n_regionkey GROUP BY 1""",
)
def avg_ticket_by_region(shop):
    # Orders are summed per customer before they meet the customers.
    per = shop.table("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"), money_sum("o_totalprice").alias("v")
    )
    places = shop.table("nation").join(
        F.broadcast(shop.table("region")), F.col("n_regionkey") == F.col("r_regionkey")
    ).select(F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("regiao"))
    people = shop.table("customer").select("c_custkey", "c_nationkey")
    joined = per.join(people, "c_custkey").join(F.broadcast(places), "c_nationkey")
    return joined.groupBy("regiao").agg(F.sum("n").alias("pedidos"), F.sum("v").alias("v")).select(
        "regiao", "pedidos", F.round(F.col("v").cast("double") / F.col("pedidos"), 4).alias("ticket_medio")
    )


@query(
    "min_volume_filter",
    """SELECT l_partkey AS product_id, count(*) AS avaliacoes, round(CAST(CAST(sum(l_quantity) AS BIGINT) AS DOUBLE) / count(*), 4) AS nota_media
       FROM lineitem GROUP BY 1 HAVING count(*) >= 30""",
)
def min_volume_filter(shop):
    per = shop.table("lineitem").groupBy(F.col("l_partkey").alias("product_id")).agg(
        F.count(F.lit(1)).alias("avaliacoes"), F.sum("l_quantity").cast("bigint").alias("s")
    )
    return per.filter("avaliacoes >= 30").select("product_id", "avaliacoes", F.round(F.col("s").cast("double") / F.col("avaliacoes"), 4).alias("nota_media"))


@query(
    "weighted_rating",
    """WITH p AS (SELECT l_partkey AS product_id, count(*) AS v, CAST(sum(l_quantity) AS BIGINT) AS s FROM lineitem GROUP BY 1),
       g AS (SELECT CAST(sum(s) AS DOUBLE) / sum(v) AS c FROM p)
       SELECT product_id, v AS avaliacoes, round((CAST(s AS DOUBLE) + 20 * c) / (v + 20), 4) AS indicador FROM p, g""",
)
def weighted_rating(shop):
    """Mean pulled towards the global mean: v/(v+m)*R + m/(v+m)*C with m = 20."""
    per = shop.table("lineitem").groupBy(F.col("l_partkey").alias("product_id")).agg(
        F.count(F.lit(1)).alias("v"), F.sum("l_quantity").cast("bigint").alias("s")
    )
    overall = per.agg(F.sum("s").cast("double") / F.sum("v")).scalar()
    rating = (F.col("s").cast("double") + F.lit(20) * overall) / (F.col("v") + 20)
    return per.select("product_id", F.col("v").alias("avaliacoes"), F.round(rating, 4).alias("indicador"))


@query(
    "outlier_users",
    """WITH u AS (SELECT user_id, count(*) AS eventos FROM events GROUP BY user_id),
       g AS (SELECT count(*) AS n, CAST(sum(eventos) AS BIGINT) AS s, CAST(sum(eventos * eventos) AS BIGINT) AS q FROM u)
       SELECT user_id, eventos FROM u, g WHERE (n * eventos - s) * (n * eventos - s) > 4 * (n * q - s * s)""",
)
def outlier_users(shop):
    """Users more than two standard deviations from the mean number of events, in whole numbers."""
    users = shop.table("events").groupBy("user_id").agg(F.count(F.lit(1)).alias("eventos"))
    n = F.col("eventos").cast("decimal(38,0)")
    g = users.agg(F.struct(F.count(F.lit(1)).cast("decimal(12,0)").alias("n"), F.sum("eventos").cast("decimal(14,0)").alias("s"), F.sum(n * n).cast("decimal(22,0)").alias("q"))).scalar()
    size, total, squares = g.getField("n"), g.getField("s"), g.getField("q")
    gap = size * F.col("eventos").cast("decimal(12,0)") - total
    return users.filter(gap.cast("decimal(18,0)") * gap.cast("decimal(18,0)") > (size * squares - total * total) * 4)


@query(
    "delay_by_carrier_route_period",
    """SELECT carrier, state AS rota, CAST(year(promised_at) AS INTEGER) AS ano, count(*) AS entregas,
       count(*) FILTER (WHERE delivered_at > promised_at) AS atrasadas,
       round(CAST(CAST(coalesce(sum(date_diff('day', promised_at, delivered_at)), 0) AS BIGINT) AS DOUBLE) / greatest(count(delivered_at), 1), 4) AS atraso_medio
       FROM (SELECT * FROM chk_shipments WHERE motivos = '') s JOIN stg_orders o ON o.order_id = s.order_id
       JOIN stg_customers c ON c.customer_id = o.customer_id GROUP BY ALL""",
)
def delay_by_carrier_route_period(shop):
    orders = silver.stg_orders(shop.orders()).select("order_id", "customer_id")
    done = silver.check_shipments(shop.shipments(), orders).filter("motivos = ''")
    routes = orders.join(shop.customers().select("customer_id", F.col("state").alias("rota")), "customer_id")
    joined = done.join(routes, "order_id")
    late = F.datediff("delivered_at", "promised_at")
    return joined.groupBy("carrier", "rota", F.year("promised_at").alias("ano")).agg(
        F.count(F.lit(1)).alias("entregas"),
        F.count_if(late > 0).alias("atrasadas"),
        F.round(F.coalesce(F.sum(late), F.lit(0)).cast("double") / F.greatest(F.count(late), F.lit(1)), 4).alias("atraso_medio"),
    )


@query(
    "compare_periods",
    """WITH m AS (SELECT o_orderstatus AS status, CAST(year(o_orderdate) AS INTEGER) AS ano,
       CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS total FROM orders GROUP BY 1, 2)
       SELECT status, ano, total, CAST(total - lag(total) OVER (PARTITION BY status ORDER BY ano) AS DECIMAL(18,2)) AS diferenca FROM m""",
)
def compare_periods(shop):
    from pyspark.sql import Window

    years = shop.table("orders").groupBy(F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("ano")).agg(
        money_sum("o_totalprice").alias("total")
    )
    before = F.lag("total").over(Window.partitionBy("status").orderBy("ano"))
    return years.withColumn("diferenca", (F.col("total") - before).cast("decimal(18,2)"))
