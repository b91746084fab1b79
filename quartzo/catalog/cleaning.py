"""Projection, filter and scalar cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from quartzo.catalog.base import query
from quartzo.functions import columns as c
from quartzo.functions.domains import MODAL_SPELLING
from quartzo.operators.lookup import list_ordered, point_lookup, search
from quartzo.plans import academic, bookstore, mobility, sales
from quartzo.plans.silver import event_base


@query("point_lookup", "SELECT id, titulo, isbn, preco, estoque, autor_id FROM livros WHERE id = 1")
def lookup(shop):
    return point_lookup(bookstore.books(shop), "id", 1)


@query("title_search", "SELECT id, titulo, isbn, preco FROM livros WHERE titulo ILIKE '%RING%' ORDER BY titulo, id")
def title_search(shop):
    return search(bookstore.books(shop), "titulo", "RING", ["titulo", "id"]).select("id", "titulo", "isbn", "preco")


@query("title_search_unordered", "SELECT id, titulo FROM livros WHERE titulo ILIKE '%bolt%'")
def title_search_unordered(shop):
    return search(bookstore.books(shop), "titulo", "bolt").select("id", "titulo")


@query("list_ordered", "SELECT titulo, id, preco FROM livros ORDER BY titulo, id")
def listed(shop):
    return list_ordered(bookstore.books(shop), ["titulo", "id"]).select("titulo", "id", "preco")


@query("project_columns", "SELECT estado, categoria, quantidade FROM sales")
def project_columns(shop):
    return sales.sales(shop).select("estado", "categoria", "quantidade")


@query("derived_total", "SELECT item_id, data_hora, quantidade, preco_unitario, desconto_pct, valor_total FROM sales_total")
def derived_total(shop):
    return sales.with_total(sales.sales(shop)).select(
        "item_id", "data_hora", "quantidade", "preco_unitario", "desconto_pct", "valor_total"
    )


@query(
    "bulk_line_total",
    "SELECT item_id, CAST(quantity * CAST(unit_price_cents / 100.0 AS DECIMAL(12,2)) AS DECIMAL(18,2)) AS valor_bruto FROM raw_order_items",
)
def bulk_line_total(shop):
    return shop.order_items().select("item_id", c.line_total("quantity", c.cents_to_money("unit_price_cents")).alias("valor_bruto"))


@query("parse_timestamp", "SELECT event_id, date_trunc('second', ts) AS at FROM events")
def parse_timestamp(shop):
    text = shop.table("events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("text"))
    return text.select("event_id", F.to_timestamp_ntz("text", F.lit("yyyy-MM-dd HH:mm:ss")).alias("at"))


@query("try_parse_timestamp", "SELECT event_id, _source_file, try_cast(event_at AS TIMESTAMP) AS event_at FROM raw_events")
def try_parse_timestamp(shop):
    return shop.events().select("event_id", "_source_file", c.utc_or_null("event_at").alias("event_at"))


@query("try_parse_number", "SELECT id_aluno, try_cast(nota AS DOUBLE) AS nota FROM matriculas")
def try_parse_number(shop):
    return academic.enrolments(shop).select("id_aluno", c.number_or_null("nota").alias("nota"))


@query("strict_parse_number", "SELECT c_custkey AS id_aluno, CAST((c_custkey % 101) / 10.0 AS DECIMAL(4,1)) AS nota FROM customer")
def strict_parse_number(shop):
    return academic.enrolments(shop, with_bad_grades=False).select("id_aluno", c.strict_number("nota", "decimal(4,1)").alias("nota"))


@query("cents_to_decimal", "SELECT order_id, updated_at, CAST(total_cents / 100.0 AS DECIMAL(12,2)) AS total FROM raw_orders")
def cents_to_decimal(shop):
    return shop.orders().select("order_id", "updated_at", c.cents_to_money("total_cents").alias("total"))


@query("extract_hour", "SELECT event_id, CAST(hour(ts) AS INTEGER) AS hora FROM events")
def extract_hour(shop):
    return shop.table("events").select("event_id", F.hour("ts").alias("hora"))


@query("to_event_date", "SELECT event_id, _source_file, CAST(event_at AS DATE) AS event_date FROM event_base")
def to_event_date(shop):
    return event_base(shop.events()).select("event_id", "_source_file", F.col("event_at").cast("date").alias("event_date"))


@query("date_key", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS sk_data FROM orders")
def date_key(shop):
    return shop.table("orders").select("o_orderkey", c.date_key("o_orderdate").alias("sk_data"))


@query(
    "trim_lower",
    "SELECT event_id, _source_file, nullif(lower(trim(event_type)), '') AS event_type, nullif(lower(trim(device)), '') AS device FROM raw_events",
)
def trim_lower(shop):
    return shop.events().select("event_id", "_source_file", c.code("event_type").alias("event_type"), c.code("device").alias("device"))


@query("upper_trim", "SELECT product_id, _source_file, upper(trim(category)) AS category FROM raw_catalog")
def upper_trim(shop):
    return shop.catalog().select("product_id", "_source_file", c.upper_trim("category").alias("category"))


@query("replace_value", "SELECT evento_id, data_hora, CASE modal WHEN 'Onibus' THEN 'ônibus' ELSE modal END AS modal FROM mobility")
def replace_value(shop):
    return mobility.trips(shop).select("evento_id", "data_hora", c.mapped("modal", MODAL_SPELLING).alias("modal"))


@query(
    "coalesce_zero",
    "SELECT m.id_aluno, coalesce(a.quantidade_acessos, 0) AS quantidade_acessos FROM matriculas m LEFT JOIN acessos a USING (id_aluno)",
)
def coalesce_zero(shop):
    joined = academic.enrolments(shop).select("id_aluno").join(academic.accesses(shop), "id_aluno", "left")
    return joined.withColumn("quantidade_acessos", F.coalesce("quantidade_acessos", F.lit(0)))


@query("filter_open_interval", "SELECT evento_id, data_hora, duracao_min FROM mobility WHERE duracao_min > 0 AND duracao_min < 240")
def filter_open_interval(shop):
    return mobility.trips(shop).filter(c.inside_open("duracao_min", 0, 240)).select("evento_id", "data_hora", "duracao_min")


@query("filter_not_null", "SELECT evento_id, distancia_km FROM mobility WHERE distancia_km IS NOT NULL")
def filter_not_null(shop):
    return mobility.trips(shop).filter("distancia_km is not null").select("evento_id", "distancia_km")


@query(
    "concat_reasons",
    """SELECT evento_id, data_hora, concat_ws(', ', CASE WHEN distancia_km IS NULL THEN 'distancia_ausente' END,
       CASE WHEN duracao_min <= 0 OR duracao_min > 240 THEN 'duracao_invalida' END,
       CASE WHEN modal = 'Onibus' THEN 'grafia' END) AS motivos FROM mobility""",
)
def concat_reasons(shop):
    broken = c.reasons(
        [
            ("distancia_ausente", F.col("distancia_km").isNull()),
            ("duracao_invalida", (F.col("duracao_min") <= 0) | (F.col("duracao_min") > 240)),
            ("grafia", F.col("modal") == "Onibus"),
        ]
    )
    return mobility.trips(shop).select("evento_id", "data_hora", broken.alias("motivos"))


@query("star_except", "SELECT * EXCLUDE (fonte, status) FROM mobility")
def star_except(shop):
    return mobility.trips(shop).drop("fonte", "status")


@query(
    "explode_nested",
    """SELECT o.order_id, o.customer_id, i.item_id, i.quantity FROM stg_orders o LEFT JOIN raw_order_items i ON i.order_id = o.order_id""",
)
def explode_nested(shop):
    from quartzo.plans.silver import stg_orders

    # In long form: an order may have any number of items.
    items = shop.order_items().select("order_id", "item_id", "quantity")
    return stg_orders(shop.orders()).select("order_id", "customer_id").join(items, "order_id", "left")


@query(
    "mask_pii",
    "SELECT sha256('sal-' || CAST(customer_id AS VARCHAR)) AS cliente, count(*) AS pedidos FROM stg_orders GROUP BY 1",
)
def mask_pii(shop):
    from quartzo.plans.silver import stg_orders

    masked = stg_orders(shop.orders()).select(c.pseudonym("customer_id", "sal-").alias("cliente"))
    return masked.groupBy("cliente").agg(F.count(F.lit(1)).alias("pedidos"))
