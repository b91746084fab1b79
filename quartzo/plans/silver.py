"""Bronze to Silver: newest versions, standard values, rules and quarantine."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartzo.functions import columns as c
from quartzo.functions.domains import CATEGORIES, SHIPMENT_STATUSES
from quartzo.operators import quality
from quartzo.operators.joins import domain_join, reference_join
from quartzo.operators.keys import latest_version, occurrence
from quartzo.operators.quality import Rule

STANDARDS = {
    "text": c.tidy_text,
    "code": c.code,
    "utc": c.utc_or_null,
    "cents": c.cents_to_money,
    "money": c.money,
    "long": lambda x: c.number_or_null(x, "bigint"),
    "double": lambda x: c.number_or_null(x, "double"),
    "date": lambda x: c.column(x).try_cast("date"),
    "date_key": c.date_key,
}


def standardize(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """Bring columns to their standard: ``spec`` names one of STANDARDS per column."""
    unknown = set(spec.values()) - set(STANDARDS)
    if unknown:
        raise ValueError(f"unknown standards {sorted(unknown)}")
    return df.withColumns({name: STANDARDS[kind](name) for name, kind in spec.items()})


def newest(df: DataFrame, key: str) -> DataFrame:
    """Newest captured version; among equal change times the last ingested one."""
    return latest_version(df, [key], ["updated_at"] + (["_ingested_at"] if "_ingested_at" in df.columns else []))


def stg_customers(raw: DataFrame) -> DataFrame:
    return standardize(raw, {"name": "text", "state": "text"})


def stg_suppliers(raw: DataFrame) -> DataFrame:
    return standardize(raw, {"name": "text", "state": "text"})


def stg_products(raw: DataFrame) -> DataFrame:
    tidy = standardize(raw, {"name": "text", "category": "text"})
    return tidy.select("product_id", "sku", "name", "category", c.cents_to_money("price_cents").alias("price"), "supplier_id")


def stg_orders(raw: DataFrame) -> DataFrame:
    last = newest(raw, "order_id")
    return last.select(
        "order_id",
        "customer_id",
        c.code("status").alias("status"),
        c.code("channel").alias("channel"),
        c.cents_to_money("total_cents").alias("total"),
        "created_at",
        "updated_at",
    )


def stg_payments(raw: DataFrame) -> DataFrame:
    """One payment per order, so that joining it cannot multiply order items."""
    return standardize(newest(raw, "order_id"), {"status": "code", "method": "code"})


def stg_order_items(raw: DataFrame) -> DataFrame:
    last = latest_version(raw, ["item_id"], ["shipped_on"] if "shipped_on" in raw.columns else ["updated_at"])
    price = c.cents_to_money("unit_price_cents").alias("unit_price")
    return last.select("item_id", "order_id", "product_id", "quantity", price)


#: Copies of an event that earlier batches of a stream had.
EARLIER = "_earlier"


def event_base(events: DataFrame) -> DataFrame:
    """Cast and fold event columns; number the copies of each event."""
    extra = [x for x in ("injected_issue", EARLIER) if x in events.columns]
    counted = occurrence(
        events.select(
            "event_id", "session_id", "customer_id", "product_id", "order_id", "event_type", "event_at", "device", "source",
            "_source_file", *extra,
        ),
        ["event_id"],
        ["_source_file", "event_at"],
    )
    return counted.select(
        "event_id", "session_id", "customer_id", "product_id", "order_id",
        c.code("event_type").alias("event_type"),
        c.utc_or_null("event_at").alias("event_at"),
        F.col("event_at").alias("event_at_raw"),
        c.code("device").alias("device"),
        c.code("source").alias("source"),
        "_source_file", *extra, "ocorrencia",
    )


def event_rules() -> list[Rule]:
    """In the order in which reasons are listed."""
    return [
        Rule("duplicado", F.col("ocorrencia") > 1),
        Rule("tipo_ausente", F.col("event_type").isNull()),
        Rule("data_invalida", F.col("event_at").isNull()),
        Rule("dispositivo_ausente", F.col("device").isNull()),
        Rule("cliente_inexistente", F.col("_customer").isNull()),
        Rule("produto_inexistente", F.col("product_id").isNotNull() & F.col("_product").isNull()),
    ]


def check_events(events: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Events with ``motivos``; empty text means approved. Parents must have unique keys."""
    return _with_reasons(event_base(events), customers, products)


def recheck_events(rejected: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Quarantined events against changed parents or rules; their place among copies stays."""
    return _with_reasons(rejected.drop("motivos", "quarantined_at"), customers, products)


def _with_reasons(base: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    with_parents = reference_join(base, customers.select(F.col("customer_id").alias("_customer")), "customer_id", "_customer", "event_id")
    with_parents = reference_join(with_parents, products.select(F.col("product_id").alias("_product")), "product_id", "_product", "event_id")
    return quality.check(with_parents, event_rules()).drop("_customer", "_product")


def silver_events(checked: DataFrame) -> DataFrame:
    return quality.approved(checked).drop("ocorrencia").withColumn("event_date", F.col("event_at").cast("date"))


def quarantine(checked: DataFrame, run_ts: datetime | Column) -> DataFrame:
    stamp = run_ts if isinstance(run_ts, Column) else F.lit(run_ts).cast("timestamp_ntz")
    return quality.rejected(checked).withColumn("quarantined_at", stamp)


def check_catalog(catalog: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Catalogue rows: spelling of the category is corrected, the rest is checked."""
    numbered = occurrence(catalog, ["product_id"], ["_source_file"])
    spelled = domain_join(numbered.withColumnRenamed("category", "category_raw"), "category_raw", CATEGORIES, "category")
    typed = spelled.select(
        c.number_or_null("product_id", "bigint").alias("product_id"),
        "category_raw",
        "category",
        c.tidy_text("weight_kg").try_cast("decimal(8,2)").alias("weight_kg"),
        c.number_or_null("supplier_id", "bigint").alias("supplier_id"),
        "_source_file",
        "ocorrencia",
    )
    joined = typed.join(
        suppliers.select(F.col("supplier_id").alias("_supplier")), F.col("supplier_id") == F.col("_supplier"), "left"
    )
    rules = [
        Rule("peso_ausente", F.col("weight_kg").isNull()),
        Rule("fornecedor_inexistente", F.col("_supplier").isNull()),
        Rule("duplicado", F.col("ocorrencia") > 1),
        Rule("categoria_invalida", F.col("category").isNull()),
    ]
    return quality.check(joined, rules).drop("_supplier")


def check_inventory(inventory: DataFrame) -> DataFrame:
    """A text that is no number is a violation of its own; a missing quantity is allowed."""
    typed = inventory.withColumn("_text", c.tidy_text("quantity")).withColumn("quantity", c.number_or_null("quantity", "bigint"))
    lost = F.col("_text").isNotNull() & F.col("quantity").isNull()
    return quality.check(typed, [Rule("estoque_negativo", F.col("quantity") < 0), Rule("quantidade_ilegivel", lost)]).drop("_text")


def check_shipments(shipments: DataFrame, orders: DataFrame) -> DataFrame:
    typed = standardize(shipments, {"carrier": "code", "status": "code", "delivered_at": "date"})
    joined = typed.join(orders.select(F.col("order_id").alias("_order")), F.col("order_id") == F.col("_order"), "left")
    rules = [
        Rule("entrega_sem_data", (F.col("status") == "delivered") & F.col("delivered_at").isNull()),
        Rule("pedido_inexistente", F.col("_order").isNull()),
        Rule("status_invalido", F.col("status").isNull() | ~F.col("status").isin(SHIPMENT_STATUSES)),
    ]
    return quality.check(joined, rules).drop("_order")


def cancelled_but_delivered(orders: DataFrame, shipments: DataFrame) -> DataFrame:
    """Alert: cancelled orders with a completed delivery. Records stay where they are."""
    done = shipments.filter(F.col("status") == "delivered").select("order_id", "shipment_id", "delivered_at")
    return orders.filter(F.col("status") == "cancelled").select("order_id", "status").join(done, "order_id")


def category_disagreement(products: DataFrame, catalog: DataFrame) -> DataFrame:
    """Products for which catalogue and sales system name different categories."""
    other = catalog.select("product_id", F.col("category").alias("categoria_catalogo"))
    mine = products.select("product_id", F.col("category").alias("categoria_vendas"))
    both = mine.join(other, "product_id")
    return both.filter(~F.col("categoria_vendas").eqNullSafe(F.col("categoria_catalogo")))


def tracking_gaps(campaigns: DataFrame, events: DataFrame) -> DataFrame:
    """Campaigns on channels no event names as its source."""
    sources = events.select(F.col("source").alias("channel")).distinct()
    return campaigns.join(sources, "channel", "left_anti").select("campaign_id", "name", "channel")
