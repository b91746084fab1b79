"""Dimensions, facts, marts and their validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from quartzo.catalog.base import query
from quartzo.catalog.lake import checked_catalog, checked_events, checked_shipments
from quartzo.operators import changes, quality
from quartzo.operators.keys import drop_duplicate_keys, surrogate_key
from quartzo.operators.profile import stacked
from quartzo.plans import gold, lineage, refresh, silver, validate, warehouse
from quartzo.plans.storefront import Storefront
from quartzo.session import cut_lineage, scratch
from quartzo.sources import formats
from quartzo.sources.history import History


def silver_tables(shop: Storefront, checked=None) -> dict:
    """Approved Silver frames, parents before children; ``checked``: events that were checked already."""
    customers, suppliers = silver.stg_customers(shop.customers()), silver.stg_suppliers(shop.suppliers())
    products, orders = silver.stg_products(shop.products()), silver.stg_orders(shop.orders())
    return {
        "customers": customers,
        "suppliers": suppliers,
        "products": products,
        "campaigns": shop.campaigns(),
        "orders": orders,
        "payments": silver.stg_payments(shop.payments()),
        "order_items": silver.stg_order_items(shop.order_items()),
        "catalog": quality.approved(silver.check_catalog(shop.catalog(), suppliers)),
        "inventory": quality.approved(silver.check_inventory(shop.inventory())),
        "shipments": quality.approved(silver.check_shipments(shop.shipments(), orders)),
        "events": silver.silver_events(silver.check_events(shop.events(), customers, products) if checked is None else checked),
    }


def gold_tables(shop: Storefront) -> dict:
    return gold.build(silver_tables(shop))


def calendar(shop: Storefront):
    """The days of all three facts."""
    return gold.dim_date((shop.orders(), "created_at"), (silver.silver_events(checked_events(shop)), "event_at"), (quality.approved(checked_shipments(shop)), "promised_at"))


def sales_tables(shop: Storefront) -> dict:
    """Just the tables and columns that sales figures read."""
    orders, keyed = silver.stg_orders(shop.orders()), gold.product_keys(silver.stg_products(shop.products()))
    customers = surrogate_key(shop.customer_ids(), "customer_id", "sk_cliente")
    items, payments = silver.stg_order_items(shop.order_items()), silver.stg_payments(shop.payments())
    return {
        "dim_data": gold.dim_date((shop.orders(), "created_at")),  # the part of the calendar that sales need
        "dim_cliente": customers,
        "dim_produto": keyed.withColumnRenamed("category", "categoria"),
        "fato_vendas": gold.fact_sales(items, orders, payments, customers, keyed),
    }


def event_tables(shop: Storefront) -> dict:
    """Just the tables and columns that navigation figures read."""
    people = surrogate_key(shop.customer_ids(), "customer_id", "sk_cliente")
    keyed = surrogate_key(shop.product_ids(), "product_id", "sk_produto")
    return {
        "dim_campanha": gold.dim_campaign(shop.campaigns()),
        "dim_produto": keyed,
        "fato_eventos": gold.fact_events(silver.silver_events(checked_events(shop)), people, keyed),
    }


def mart(name: str, tables: dict):
    return gold.MARTS[name](tables)


@query("dim_data", "SELECT * FROM dim_data")
def dim_data(shop):
    return calendar(shop)


@query("dim_cliente", "SELECT * FROM dim_cliente")
def dim_cliente(shop):
    return gold.dim_customer(silver.stg_customers(shop.customers()))


@query("dim_produto", "SELECT * FROM dim_produto")
def dim_produto(shop):
    suppliers = silver.stg_suppliers(shop.suppliers())
    catalog = quality.approved(silver.check_catalog(shop.catalog(), suppliers))
    return gold.dim_product(gold.product_keys(silver.stg_products(shop.products())), catalog, suppliers)


@query("dim_campanha", "SELECT * FROM dim_campanha")
def dim_campanha(shop):
    return gold.dim_campaign(shop.campaigns())


@query("fato_vendas", "SELECT * FROM fato_vendas")
def fato_vendas(shop):
    return sales_tables(shop)["fato_vendas"]


@query("fato_eventos", "SELECT * FROM fato_eventos")
def fato_eventos(shop):
    return event_tables(shop)["fato_eventos"]


@query("fato_entregas", "SELECT * FROM fato_entregas")
def fato_entregas(shop):
    return gold.fact_deliveries(quality.approved(checked_shipments(shop)))


@query("scd1", "SELECT order_id, customer_id, status, updated_at FROM raw_orders QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC, customer_id, status, channel, total_cents, created_at) = 1")
def scd1(shop):
    return changes.scd1(shop.orders(), ["order_id"], ["updated_at"]).select("order_id", "customer_id", "status", "updated_at")


HISTORY = {
    "cambios": """SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS dia, o_orderpriority AS segmento FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC, o_orderpriority) = 1""",
    "inicios": """SELECT * FROM cambios QUALIFY lag(customer_id) OVER (PARTITION BY customer_id ORDER BY dia) IS NULL
        OR segmento IS DISTINCT FROM lag(segmento) OVER (PARTITION BY customer_id ORDER BY dia)""",
    "vigencias": """SELECT customer_id, segmento, dia AS valido_de,
        coalesce(lead(dia) OVER (PARTITION BY customer_id ORDER BY dia), DATE '9999-12-31') AS valido_ate,
        lead(dia) OVER (PARTITION BY customer_id ORDER BY dia) IS NULL AS atual FROM inicios""",
}


def customer_changes(shop: Storefront):
    rows = shop.table("orders").select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").cast("date").alias("dia"),
        F.col("o_orderpriority").alias("segmento"), (-F.col("o_orderkey")).alias("_last"),
    )
    return drop_duplicate_keys(rows, ["customer_id", "dia"], ["_last"]).drop("_last")


@query("scd2", "SELECT * FROM vigencias", **HISTORY)
def scd2(shop):
    return changes.scd2(customer_changes(shop), "customer_id", ["segmento"], "dia")


@query("scd2_by_batches", "SELECT * FROM vigencias", **HISTORY)
def scd2_by_batches(shop):
    """The same spans from stored history that took the changes in three batches, the latest days first."""
    found = cut_lineage(customer_changes(shop))
    store = History(shop.spark, scratch(shop.spark, "history"), "customer_id", ["segmento"], "dia", "customer_id bigint, dia date, segmento string", buckets=8)
    for batch, days in enumerate(("dia >= '1997-01-01'", "dia < '1994-06-01'", "dia >= '1994-06-01' and dia < '1997-01-01'")):
        store.merge(found.filter(days), batch)
    return store.spans()


@query(
    "scd2_asof_lookup",
    """SELECT o.o_orderkey AS order_id, o.customer_id, o.dia, v.segmento FROM
       (SELECT o_orderkey, o_custkey AS customer_id, CAST(o_orderdate AS DATE) + 20 AS dia FROM orders) o
       LEFT JOIN vigencias v ON v.customer_id = o.customer_id AND v.valido_de <= o.dia AND o.dia < v.valido_ate""",
    **HISTORY,
)
def scd2_asof_lookup(shop):
    # A dimension is a stored table; facts are looked up against the stored copy.
    history = cut_lineage(changes.scd2(customer_changes(shop), "customer_id", ["segmento"], "dia"))
    facts = shop.table("orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.date_add(F.col("o_orderdate").cast("date"), 20).alias("dia"),
    )
    return changes.asof_dim(facts, history, "customer_id", "dia", ["segmento"])


@query("receita_bruta", "SELECT CAST(sum(valor_bruto) AS DECIMAL(18,2)) AS receita FROM fato_vendas")
def receita_bruta(shop):
    return gold.gross_revenue(sales_tables(shop)["fato_vendas"])


@query("receita_aprovada", "SELECT CAST(sum(valor_bruto) AS DECIMAL(18,2)) AS receita FROM vendas_validas")
def receita_aprovada(shop):
    return gold.gross_revenue(gold.approved_sales(sales_tables(shop)["fato_vendas"]))


@query("mart_receita_categoria_dia", "SELECT * FROM mart_receita")
def mart_receita_categoria_dia(shop):
    return mart("mart_receita_categoria_dia", sales_tables(shop))


FUNNEL_SQL = "SELECT origem, " + ", ".join(
    f"count(DISTINCT CASE WHEN tipo = '{s}' THEN session_id END) AS {s}" for s in ("page_view", "view_product", "add_to_cart", "checkout", "purchase")
) + " FROM fato_eventos GROUP BY origem"


@query("mart_funil_origem", FUNNEL_SQL)
def mart_funil_origem(shop):
    return mart("mart_funil_origem", event_tables(shop))


DELIVERIES_SQL = """SELECT transportadora, count(*) AS entregas, count(*) - count(no_prazo) AS em_aberto,
       CAST(round(count(*) FILTER (WHERE no_prazo) * 100.0::DOUBLE / nullif(count(no_prazo), 0), 4) AS DECIMAL(10,4)) AS pct_no_prazo,
       CAST(round(CAST(sum(dias_atraso) AS DOUBLE) / nullif(count(no_prazo), 0), 4) AS DECIMAL(10,4)) AS atraso_medio
       FROM fato_entregas GROUP BY transportadora"""


@query("mart_entregas_transportadora", DELIVERIES_SQL)
def mart_entregas_transportadora(shop):
    return gold.mart_deliveries_by_carrier(gold.fact_deliveries(quality.approved(checked_shipments(shop))))


@query(
    "mart_campanhas",
    """SELECT sk_campanha, nome, canal, count(event_id) AS eventos, count(DISTINCT session_id) AS sessoes,
       count(*) FILTER (WHERE tipo = 'purchase') AS compras, count(DISTINCT CASE WHEN tipo = 'purchase' THEN session_id END) AS sessoes_com_compra
       FROM dim_campanha LEFT JOIN fato_eventos ON origem = canal GROUP BY ALL""",
)
def mart_campanhas(shop):
    return mart("mart_campanhas", event_tables(shop))


@query("named_query", DELIVERIES_SQL)
def named_query(shop):
    deliveries = gold.fact_deliveries(quality.approved(checked_shipments(shop)))
    return gold.named_query("entregas-transportadora", {"fato_entregas": deliveries})


@query("mart_as_view_or_table", "SELECT t.*, v.forma FROM (SELECT * FROM mart_receita) t, (SELECT unnest(['view', 'tabela']) AS forma) v")
def mart_as_view_or_table(shop):
    """The revenue mart read through a view and from a materialised table."""
    revenue = mart("mart_receita_categoria_dia", sales_tables(shop))
    path = scratch(shop.spark, "mart")
    formats.write_parquet(revenue, path)
    table = shop.spark.read.parquet(path)
    view = shop.spark.sql("SELECT * FROM {revenue}", revenue=revenue)
    return stacked([view.withColumn("forma", F.lit("view")), table.withColumn("forma", F.lit("tabela"))])


@query(
    "bronze_preserves_landing",
    "SELECT 'bronze_preserva_landing' AS verificacao, true AS ok, count(*) || ' = ' || count(*) AS detalhe FROM raw_events",
)
def bronze_preserves_landing(shop):
    from quartzo.catalog.lake import EVENT_SCHEMA, RUN, landed_events
    from quartzo.sources import lake as layers

    lake = landed_events(shop)
    stored = layers.bronze(shop.spark, lake, "events", "jsonl", RUN, EVENT_SCHEMA)
    return validate.bronze_preserves_landing(layers.read_landing(shop.spark, lake.path("landing", "events"), "jsonl", EVENT_SCHEMA), stored)


@query(
    "silver_unique_event",
    """SELECT 'silver_sem_event_id_repetido' AS verificacao, count(*) = count(DISTINCT event_id) AS ok,
       CAST(count(*) - count(DISTINCT event_id) AS VARCHAR) || ' chaves repetidas' AS detalhe FROM silver_events""",
)
def silver_unique_event(shop):
    return validate.unique_key(silver.silver_events(checked_events(shop)), "event_id", "silver_sem_event_id_repetido")


@query(
    "fact_grain",
    """SELECT 'grao_fato_vendas' AS verificacao, count(*) = count(DISTINCT item_id) AS ok,
       count(*) || ' = ' || count(DISTINCT item_id) AS detalhe FROM fato_vendas
       UNION ALL SELECT 'grao_sem_dedupe', count(*) = count(DISTINCT item_id), count(*) || ' = ' || count(DISTINCT item_id) FROM raw_order_items""",
)
def fact_grain(shop):
    """The fact passes; the captured lines, which repeat items, must not."""
    raw = validate.fact_grain(shop.order_items()).withColumn("verificacao", F.lit("grao_sem_dedupe"))
    return stacked([validate.fact_grain(sales_tables(shop)["fato_vendas"]), raw])


@query(
    "dim_keys_unique",
    """SELECT 'chaves_dimensoes_unicas' AS verificacao, count(*) = 0 AS ok, count(*) || ' chaves repetidas' AS detalhe
       FROM (SELECT d, k FROM (SELECT 'data' AS d, sk_data AS k FROM dim_data UNION ALL SELECT 'cliente', sk_cliente FROM dim_cliente
                               UNION ALL SELECT 'produto', sk_produto FROM dim_produto UNION ALL SELECT 'campanha', sk_campanha FROM dim_campanha)
             GROUP BY d, k HAVING count(*) > 1)""",
)
def dim_keys_unique(shop):
    t = {**sales_tables(shop), "dim_data": calendar(shop), "dim_campanha": gold.dim_campaign(shop.campaigns())}
    return validate.dim_keys_unique({name: (t[f"dim_{name}"], key) for name, key in validate.DIMENSIONS.items()})


@query(
    "no_orphan_keys",
    """SELECT 'fatos_sem_chaves_orfas' AS verificacao, count(*) = 0 AS ok, count(*) || ' chaves orfas' AS detalhe
       FROM (SELECT 'data' AS d, sk_data AS k FROM fato_vendas UNION SELECT 'data', sk_data FROM fato_eventos UNION SELECT 'data', sk_data FROM fato_entregas
             UNION SELECT 'cliente', sk_cliente FROM fato_vendas UNION SELECT 'cliente', sk_cliente FROM fato_eventos
             UNION SELECT 'produto', sk_produto FROM fato_vendas UNION SELECT 'produto', sk_produto FROM fato_eventos
             EXCEPT (SELECT 'data', sk_data FROM dim_data UNION ALL SELECT 'cliente', sk_cliente FROM dim_cliente UNION ALL SELECT 'produto', sk_produto FROM dim_produto))
       WHERE k IS NOT NULL""",
)
def no_orphan_keys(shop):
    t = {**event_tables(shop), **sales_tables(shop), "dim_data": calendar(shop), "fato_entregas": gold.fact_deliveries(quality.approved(checked_shipments(shop)))}
    return validate.no_orphan_keys(validate.links(t))


@query(
    "approved_revenue_valid_only",
    """SELECT 'receita_somente_pedidos_validos' AS verificacao,
       (SELECT CAST(sum(valor_bruto) AS DECIMAL(18,2)) FROM vendas_validas) = (SELECT CAST(sum(receita) AS DECIMAL(18,2)) FROM mart_receita) AS ok,
       (SELECT CAST(sum(valor_bruto) AS DECIMAL(18,2)) FROM vendas_validas) || ' = ' || (SELECT CAST(sum(receita) AS DECIMAL(18,2)) FROM mart_receita) AS detalhe""",
)
def approved_revenue_valid_only(shop):
    t = sales_tables(shop)
    t["fato_vendas"] = cut_lineage(t["fato_vendas"])
    return validate.approved_revenue_valid_only(t["fato_vendas"], mart("mart_receita_categoria_dia", t))


@query(
    "validate_all",
    """SELECT 'bronze_preserva_landing' AS verificacao, (SELECT count(*) FROM events) <= count(*) AS ok FROM raw_events
       UNION ALL SELECT 'bronze_igual_silver_mais_quarentena', (SELECT count(*) FROM raw_events) = count(*) FILTER (WHERE motivos = '') + count(*) FILTER (WHERE motivos <> '') FROM chk_events
       UNION ALL SELECT 'silver_sem_event_id_repetido', count(*) = count(DISTINCT event_id) FROM silver_events
       UNION ALL SELECT 'grao_fato_vendas', count(*) = count(DISTINCT item_id) FROM fato_vendas
       UNION ALL SELECT 'chaves_dimensoes_unicas', (SELECT count(*) = count(DISTINCT sk_cliente) FROM dim_cliente) AND (SELECT count(*) = count(DISTINCT sk_produto) FROM dim_produto)
         AND (SELECT count(*) = count(DISTINCT sk_campanha) FROM dim_campanha) AND (SELECT count(*) = count(DISTINCT sk_data) FROM dim_data)
       UNION ALL SELECT 'fatos_sem_chaves_orfas', NOT EXISTS (SELECT 1 FROM fato_vendas ANTI JOIN dim_produto USING (sk_produto)) AND NOT EXISTS (SELECT 1 FROM fato_vendas ANTI JOIN dim_cliente USING (sk_cliente))
         AND NOT EXISTS (SELECT 1 FROM fato_eventos ANTI JOIN dim_cliente USING (sk_cliente)) AND NOT EXISTS (SELECT 1 FROM (SELECT sk_data FROM fato_vendas UNION SELECT sk_data FROM fato_eventos UNION SELECT sk_data FROM fato_entregas) ANTI JOIN dim_data USING (sk_data))
       UNION ALL SELECT 'receita_somente_pedidos_validos', (SELECT CAST(sum(valor_bruto) AS DECIMAL(18,2)) FROM vendas_validas) = (SELECT CAST(sum(receita) AS DECIMAL(18,2)) FROM mart_receita)""",
)
def validate_all(shop):
    """Over a run's own files: events land, go to Bronze, are checked and split; Gold is written; then all is read back."""
    from quartzo.catalog.lake import EVENT_SCHEMA, RUN, landed_events
    from quartzo.sources import lake as layers

    lake = landed_events(shop)
    bronze = layers.bronze(shop.spark, lake, "events", "jsonl", RUN, EVENT_SCHEMA)
    checked = cut_lineage(silver.check_events(bronze, shop.customer_ids(), shop.product_ids()))
    parts = silver_tables(shop, checked)
    parts["events"] = lake.stage(parts["events"], "silver", "events")
    quarantine = lake.stage(silver.quarantine(checked, RUN), "quarantine", "events")
    landing = layers.read_landing(shop.spark, lake.path("landing", "events"), "jsonl", EVENT_SCHEMA)
    with warehouse.database(shop.spark, "gold") as name:
        tables = warehouse.publish(shop.spark, {n: d for n, d in gold.build(parts).items() if n not in gold.MARTS}, name)
        results = cut_lineage(validate.validate_all(landing, bronze, parts["events"], quarantine, tables))
    return results.select("verificacao", "ok")


@query(
    "lineage_trace",
    """WITH i AS (SELECT min(item_id) AS item_id FROM fato_vendas)
       SELECT f.item_id, 'lineitem.parquet' AS arquivo_landing, (SELECT count(*) FROM raw_order_items r WHERE r.item_id = f.item_id) AS linhas_bronze,
       CAST(1 AS BIGINT) AS linhas_silver, f.order_id, d.data, p.categoria, f.valor_bruto
       FROM fato_vendas f JOIN i USING (item_id) JOIN dim_data d USING (sk_data) JOIN dim_produto p USING (sk_produto)""",
)
def lineage_trace(shop):
    t, raw = sales_tables(shop), shop.order_items()
    bronze = shop.table("lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("item_id"), F.col("_metadata.file_name").alias("_source_file")
    )
    first = t["fato_vendas"].agg(F.min("item_id")).first()[0]
    return lineage.trace(first, bronze, silver.stg_order_items(raw), t["fato_vendas"], t["dim_data"], t["dim_produto"])


@query("full_refresh", "SELECT event_date, count(*) AS eventos FROM silver_events GROUP BY 1")
def full_refresh(shop):
    path = scratch(shop.spark, "silver")
    approved = cut_lineage(silver.silver_events(checked_events(shop)).select("event_id", "event_type", "event_date"))
    # the first run also has a day that is gone in the second
    formats.write_partitioned(approved.unionByName(approved.withColumn("event_date", F.lit("1999-12-31").cast("date"))), path, ["event_date"])
    formats.write_partitioned(approved, path, ["event_date"], full=True)
    return shop.spark.read.parquet(path).groupBy("event_date").agg(F.count(F.lit(1)).alias("eventos"))


@query(
    "partition_refresh",
    """SELECT event_date, count(*) AS eventos, count(*) FILTER (WHERE event_date >= DATE '2024-01-20') AS refeitos FROM silver_events GROUP BY 1""",
)
def partition_refresh(shop):
    """Only the days from the 20th on are written again; the older folders stay."""
    path = scratch(shop.spark, "silver")
    approved = cut_lineage(silver.silver_events(checked_events(shop)).select("event_id", "event_date"))
    formats.write_partitioned(approved.withColumn("refeito", F.lit(False)), path, ["event_date"])
    recent = approved.filter(F.col("event_date") >= F.lit("2024-01-20").cast("date")).withColumn("refeito", F.lit(True))
    formats.write_partitioned(recent, path, ["event_date"])
    return shop.spark.read.parquet(path).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("eventos"), F.count_if("refeito").alias("refeitos")
    )


@query(
    "mart_day_refresh",
    """SELECT d.data, CASE WHEN p.product_id = 100 THEN 'outra' ELSE p.categoria END AS categoria, count(DISTINCT v.order_id) AS pedidos,
       CAST(sum(v.quantidade) AS BIGINT) AS itens, CAST(sum(v.valor_bruto) AS DECIMAL(18,2)) AS receita
       FROM vendas_validas v JOIN dim_data d USING (sk_data) JOIN dim_produto p USING (sk_produto) GROUP BY 1, 2""",
)
def mart_day_refresh(shop):
    """The last days come in, and a product changes its category: the stored mart is refreshed, not rebuilt."""
    t = sales_tables(shop)
    fact = cut_lineage(t["fato_vendas"])
    dates, products = t["dim_data"], t["dim_produto"].select("sk_produto", "product_id", "categoria")
    moved = products.withColumn("categoria", F.when(F.col("product_id") == 100, "outra").otherwise(F.col("categoria")))
    path = scratch(shop.spark, "mart")
    new = F.col("sk_data") >= 19980725
    refresh.write_revenue(gold.mart_revenue_by_category_day(fact.filter(~new), dates, products), path)
    days = refresh.affected_days([fact], fact.filter(new).select("sk_data"), refresh.changed_rows(products, moved, ["sk_produto"]))
    refresh.refresh_revenue(path, fact, dates, moved, days)
    return shop.spark.read.parquet(path).select("data", "categoria", "pedidos", "itens", "receita")


@query(
    "dependency_order",
    """SELECT * FROM (VALUES (1, 'customers', (SELECT count(*) FROM stg_customers)), (2, 'suppliers', (SELECT count(*) FROM stg_suppliers)),
       (3, 'products', (SELECT count(*) FROM stg_products)), (4, 'campaigns', (SELECT count(*) FROM raw_campaigns)),
       (5, 'orders', (SELECT count(*) FROM stg_orders)), (6, 'payments', (SELECT count(*) FROM stg_payments)),
       (7, 'order_items', (SELECT count(*) FROM stg_order_items)), (8, 'catalog', (SELECT count(*) FROM chk_catalog WHERE motivos = '')),
       (9, 'inventory', (SELECT count(*) FROM chk_inventory WHERE motivos = '')), (10, 'shipments', (SELECT count(*) FROM chk_shipments WHERE motivos = '')),
       (11, 'events', (SELECT count(*) FROM silver_events))) AS t(posicao, tabela, linhas)""",
)
def dependency_order(shop):
    """Silver tables in the order they are built, parents first, with their rows."""
    rows = [
        d.agg(F.lit(i).alias("posicao"), F.lit(n).alias("tabela"), F.count(F.lit(1)).alias("linhas"))
        for i, (n, d) in enumerate(silver_tables(shop).items(), 1)
    ]
    return stacked(rows)
