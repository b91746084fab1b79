"""Silver to Gold: dimensions, facts and marts."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartzo.functions import columns as c
from quartzo.functions.domains import FUNNEL_STEPS
from quartzo.operators.keys import surrogate_key


def dim_date(*days: tuple[DataFrame, str]) -> DataFrame:
    """The calendar that all facts share: every day from the first to the last of the given columns.

    Weeks start on Monday = 1. Each column gives two values; days without any fact between them are there too.
    """
    ends = [d.agg(F.min(day).cast("date").alias("lo"), F.max(day).cast("date").alias("hi")) for d, day in days]
    both = reduce(DataFrame.unionByName, ends).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter("lo is not null")
    return both.select(F.explode(F.sequence("lo", "hi")).alias("data")).select(
        c.date_key("data").alias("sk_data"),
        "data",
        F.year("data").alias("ano"),
        F.month("data").alias("mes"),
        (F.weekday("data") + 1).alias("dia_semana"),
        (F.weekday("data") >= 5).alias("fim_de_semana"),
    )


def dim_customer(customers: DataFrame) -> DataFrame:
    shaped = customers.select(
        "customer_id", F.col("name").alias("nome"), F.col("state").alias("uf"), F.col("since").alias("cliente_desde")
    )
    return surrogate_key(shaped, "customer_id", "sk_cliente")


def product_keys(products: DataFrame) -> DataFrame:
    """Products with their surrogate key: all that facts need of the dimension."""
    return surrogate_key(products, "product_id", "sk_produto")


def dim_product(keyed: DataFrame, catalog: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Name, category and price from sales, weight from the approved catalogue, supplier by the sales system's id.

    Catalogue and suppliers must have unique keys.
    """
    weights = catalog.select("product_id", F.col("weight_kg").alias("peso_kg"))
    owners = suppliers.select("supplier_id", F.col("name").alias("fornecedor"), F.col("state").alias("uf_fornecedor"))
    return keyed.join(weights, "product_id", "left").join(owners, "supplier_id", "left").select(
        "sk_produto",
        "product_id",
        "sku",
        F.col("name").alias("nome"),
        F.col("category").alias("categoria"),
        F.col("price").alias("preco_atual"),
        "peso_kg",
        "fornecedor",
        "uf_fornecedor",
    )


def dim_campaign(campaigns: DataFrame) -> DataFrame:
    shaped = campaigns.select("campaign_id", F.col("name").alias("nome"), F.col("channel").alias("canal"))
    return surrogate_key(shaped, "campaign_id", "sk_campanha")


def fact_sales(
    items: DataFrame, orders: DataFrame, payments: DataFrame, customers: DataFrame, products: DataFrame
) -> DataFrame:
    """One row per order item.

    Context is gathered on the order side first: orders are fewer than items, and orders
    and payments already lie on the order key, so items are shuffled for that key once.
    """
    paid = orders.join(
        payments.select("order_id", F.col("status").alias("status_pagamento"), F.col("method").alias("metodo_pagamento")),
        "order_id",
        "left",
    ).join(customers.select("customer_id", "sk_cliente"), "customer_id")
    context = paid.select(
        "order_id",
        c.date_key("created_at").alias("sk_data"),
        "sk_cliente",
        F.col("channel").alias("canal"),
        F.col("status").alias("status_pedido"),
        "status_pagamento",
        "metodo_pagamento",
    )
    return (
        items.join(context, "order_id")
        .join(products.select("product_id", "sk_produto"), "product_id")
        .select(
            "item_id",
            "order_id",
            "sk_data",
            "sk_cliente",
            "sk_produto",
            "canal",
            "status_pedido",
            "status_pagamento",
            "metodo_pagamento",
            F.col("quantity").alias("quantidade"),
            F.col("unit_price").alias("preco_unitario"),
            c.line_total("quantity", "unit_price").alias("valor_bruto"),
        )
    )


def orphan_items(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Items the inner joins of :func:`fact_sales` would drop, with the parent they lack."""
    no_order = items.join(orders.select("order_id"), "order_id", "left_anti").select("item_id", F.lit("pedido").alias("falta"))
    no_product = items.join(products.select("product_id"), "product_id", "left_anti").select("item_id", F.lit("produto").alias("falta"))
    return no_order.unionByName(no_product)


def fact_events(events: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """One row per approved event."""
    return (
        events.join(customers.select("customer_id", "sk_cliente"), "customer_id")
        .join(products.select("product_id", "sk_produto"), "product_id", "left")
        .select(
            "event_id",
            "session_id",
            c.date_key("event_at").alias("sk_data"),
            "sk_cliente",
            "sk_produto",
            F.col("event_type").alias("tipo"),
            F.col("device").alias("dispositivo"),
            F.col("source").alias("origem"),
            "order_id",
        )
    )


def fact_deliveries(shipments: DataFrame) -> DataFrame:
    """One row per approved delivery; delay against the promised day."""
    return shipments.select(
        "shipment_id",
        "order_id",
        c.date_key("promised_at").alias("sk_data"),
        F.col("carrier").alias("transportadora"),
        "status",
        F.datediff("delivered_at", "promised_at").alias("dias_atraso"),
        (F.col("delivered_at") <= F.col("promised_at")).alias("no_prazo"),
    )


def approved_sales(fact: DataFrame) -> DataFrame:
    """The one definition of revenue: order not cancelled and payment approved."""
    return fact.filter((F.col("status_pedido") != "cancelled") & (F.col("status_pagamento") == "approved"))


def gross_revenue(fact: DataFrame) -> DataFrame:
    return fact.agg(F.sum("valor_bruto").cast("decimal(18,2)").alias("receita"))


def mart_revenue_by_category_day(fact: DataFrame, dates: DataFrame, products: DataFrame) -> DataFrame:
    """``pedidos`` counts distinct orders per cell; it must not be summed over cells."""
    valid = approved_sales(fact).select("sk_data", "sk_produto", "order_id", "quantidade", "valor_bruto")
    return (
        valid.join(dates.select("sk_data", "data"), "sk_data")
        .join(products.select("sk_produto", "categoria"), "sk_produto")
        .groupBy("data", "categoria")
        .agg(
            F.count_distinct("order_id").alias("pedidos"),
            F.sum("quantidade").alias("itens"),
            F.sum("valor_bruto").cast("decimal(18,2)").alias("receita"),
        )
    )


def mart_funnel_by_source(events: DataFrame, steps: list[str] = FUNNEL_STEPS) -> DataFrame:
    """Distinct sessions that reached each step, per source; steps count independently.

    Sessions are folded to one row of flags first. That replaces one distinct count per
    step, each of which would copy every row.
    """
    flags = [F.max(F.col("tipo") == s).alias(s) for s in steps]
    sessions = events.filter(F.col("tipo").isin(steps)).groupBy("origem", "session_id").agg(*flags)
    return sessions.groupBy("origem").agg(*[F.count_if(s).alias(s) for s in steps])


def mart_deliveries_by_carrier(fact: DataFrame) -> DataFrame:
    done = F.col("no_prazo").isNotNull()
    sums = fact.groupBy("transportadora").agg(
        F.count(F.lit(1)).alias("entregas"),
        F.count_if(done).alias("concluidas"),
        F.count_if("no_prazo").alias("no_prazo"),
        F.sum("dias_atraso").alias("_delay"),
    )
    ratio = lambda top, bottom: F.when(bottom > 0, F.round(top.cast("decimal(20,0)") / bottom.cast("decimal(20,0)"), 4))
    return sums.select(
        "transportadora",
        "entregas",
        (F.col("entregas") - F.col("concluidas")).alias("em_aberto"),
        ratio(F.col("no_prazo") * 100, F.col("concluidas")).cast("decimal(10,4)").alias("pct_no_prazo"),
        ratio(F.col("_delay"), F.col("concluidas")).cast("decimal(10,4)").alias("atraso_medio"),
    )


def mart_campaigns(campaigns: DataFrame, events: DataFrame) -> DataFrame:
    """Traffic and purchases on each campaign's channel; events are summed per channel before the join."""
    sessions = events.groupBy("origem", "session_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("tipo") == "purchase").alias("p")
    )
    traffic = sessions.groupBy("origem").agg(
        F.sum("n").alias("eventos"),
        F.count(F.lit(1)).alias("sessoes"),
        F.sum("p").alias("compras"),
        F.count_if(F.col("p") > 0).alias("sessoes_com_compra"),
    )
    measures = ["eventos", "sessoes", "compras", "sessoes_com_compra"]
    return campaigns.join(traffic, campaigns["canal"] == traffic["origem"], "left").select(
        "sk_campanha", "nome", "canal", *[F.coalesce(m, F.lit(0)).alias(m) for m in measures]
    )


def build(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All Gold tables and marts from the approved Silver frames."""
    keyed = product_keys(silver["products"])
    t = {
        "dim_data": dim_date((silver["orders"], "created_at"), (silver["events"], "event_at"), (silver["shipments"], "promised_at")),
        "dim_cliente": dim_customer(silver["customers"]),
        "dim_produto": dim_product(keyed, silver["catalog"], silver["suppliers"]),
        "dim_campanha": dim_campaign(silver["campaigns"]),
    }
    t["fato_vendas"] = fact_sales(
        silver["order_items"], silver["orders"], silver["payments"], t["dim_cliente"], keyed
    )
    t["fato_eventos"] = fact_events(silver["events"], t["dim_cliente"], keyed)
    t["fato_entregas"] = fact_deliveries(silver["shipments"])
    return {**t, **marts(t)}


def marts(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: builder(t) for name, builder in MARTS.items()}


MARTS: dict[str, Callable[[dict[str, DataFrame]], DataFrame]] = {
    "mart_receita_categoria_dia": lambda t: mart_revenue_by_category_day(t["fato_vendas"], t["dim_data"], t["dim_produto"]),
    "mart_funil_origem": lambda t: mart_funnel_by_source(t["fato_eventos"]),
    "mart_entregas_transportadora": lambda t: mart_deliveries_by_carrier(t["fato_entregas"]),
    "mart_campanhas": lambda t: mart_campaigns(t["dim_campanha"], t["fato_eventos"]),
}

NAMED = {
    "receita-categoria": "mart_receita_categoria_dia",
    "funil-origem": "mart_funil_origem",
    "entregas-transportadora": "mart_entregas_transportadora",
    "campanhas": "mart_campanhas",
}


def named_query(name: str, tables: dict[str, DataFrame]) -> DataFrame:
    if name not in NAMED:
        raise KeyError(f"unknown query {name!r}; known: {', '.join(sorted(NAMED))}")
    return MARTS[NAMED[name]](tables)
