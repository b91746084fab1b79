"""One full run: landing to Bronze, Silver and quarantine, Gold, checks."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartzo.operators import quality
from quartzo.plans import gold, silver, validate, warehouse
from quartzo.session import cut_lineage
from quartzo.sources import lake as layers
from quartzo.sources.lake import Lake


@dataclass(frozen=True)
class Source:
    """Format and columns of a landing dataset; dates arrive as text."""

    fmt: str
    schema: str | None = None


SOURCES = {
    "customers": Source("jsonl", "customer_id bigint, name string, state string, since string"),
    "suppliers": Source("jsonl", "supplier_id bigint, name string, state string"),
    "products": Source("jsonl", "product_id bigint, sku string, name string, category string, price_cents bigint, supplier_id bigint"),
    "campaigns": Source("json", "campaign_id bigint, name string, channel string"),
    "orders": Source(
        "jsonl", "order_id bigint, customer_id bigint, status string, channel string, total_cents bigint, created_at string, updated_at string"
    ),
    "payments": Source("jsonl", "order_id bigint, status string, method string, updated_at string"),
    "order_items": Source(
        "jsonl", "item_id bigint, order_id bigint, product_id bigint, quantity bigint, unit_price_cents bigint, updated_at string"
    ),
    "catalog": Source("csv"),
    "inventory": Source("csv"),
    "shipments": Source(
        "jsonl", "shipment_id bigint, order_id bigint, carrier string, status string, promised_at string, delivered_at string"
    ),
    "events": Source(
        "jsonl",
        "event_id bigint, session_id string, customer_id bigint, product_id bigint, order_id bigint, event_type string, "
        "event_at string, device string, source string",
    ),
}
CHECKED = ("catalog", "inventory", "shipments", "events")
TABLES = ("dim_data", "dim_cliente", "dim_produto", "dim_campanha", "fato_vendas", "fato_eventos", "fato_entregas")


class Medallion:
    """Stages of a run over one lake; each can be repeated and publishes a new version of its output.

    ``max_quarantine_pct``: share of records set apart that blocks a run, one figure or one for each checked dataset.
    """

    def __init__(self, spark: SparkSession, base: str, run_ts: datetime, database: str = "gold", max_quarantine_pct: int | dict[str, int] = 10):
        self.spark = spark
        self.lake = Lake(spark, base)
        self.run_ts = run_ts
        self.database = database
        limits = max_quarantine_pct
        self.max_pct = {n: limits.get(n, 10) if isinstance(limits, dict) else limits for n in CHECKED}

    def landing(self, dataset: str) -> DataFrame:
        source = SOURCES[dataset]
        return layers.read_landing(self.spark, self.lake.path("landing", dataset), source.fmt, source.schema)

    def bronze(self) -> dict:
        for name, source in SOURCES.items():
            layers.bronze(self.spark, self.lake, name, source.fmt, self.run_ts, source.schema)
        counted = validate.stacked(
            [
                layers.read_bronze(self.lake, n).groupBy("_source_file").agg(F.count(F.lit(1)).alias("n")).agg(
                    F.lit(n).alias("dataset"), F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")
                )
                for n in SOURCES
            ]
        ).collect()
        return {"stage": "bronze", "source_files": sum(r.files for r in counted), "rows": sum(r.rows for r in counted), "status": "success"}

    def _bronze(self, dataset: str, **kinds: str) -> DataFrame:
        return silver.standardize(layers.read_bronze(self.lake, dataset), kinds)

    def _plain(self) -> dict[str, DataFrame]:
        return {
            "customers": silver.stg_customers(self._bronze("customers", since="date")).drop("_source_file", "_ingested_at"),
            "suppliers": silver.stg_suppliers(self._bronze("suppliers")).drop("_source_file", "_ingested_at"),
            "products": silver.stg_products(self._bronze("products")),
            "campaigns": self._bronze("campaigns").drop("_source_file", "_ingested_at"),
            "orders": silver.stg_orders(self._bronze("orders", created_at="date", updated_at="utc")),
            "payments": silver.stg_payments(self._bronze("payments", updated_at="utc")).drop("_source_file", "_ingested_at"),
            "order_items": silver.stg_order_items(self._bronze("order_items", updated_at="utc")),
        }

    def _stage_silver(self) -> None:
        """Parents first; all checked datasets pass the gate before any table is published."""
        for name, df in self._plain().items():
            self.lake.stage(df, "silver", name)
        parent = lambda n: self.lake.read("silver", n)
        checks = {
            "catalog": silver.check_catalog(self._bronze("catalog"), parent("suppliers")),
            "inventory": silver.check_inventory(self._bronze("inventory")),
            "shipments": silver.check_shipments(self._bronze("shipments", promised_at="date"), parent("orders")),
            "events": silver.check_events(self._bronze("events"), parent("customers"), parent("products")),
        }
        for name, df in checks.items():
            checked = cut_lineage(df)
            # events are judged file by file, the others as a whole
            quality.gate(checked, F.col("_source_file") if name == "events" else F.lit(name), self.max_pct[name])
            good = silver.silver_events(checked) if name == "events" else quality.approved(checked)
            self.lake.stage(good, "silver", name, ["event_date"] if name == "events" else None)
            self.lake.stage(silver.quarantine(checked, self.run_ts), "quarantine", name)

    def silver(self) -> list:
        """Silver and quarantine; what the gate blocks is never seen."""
        with self._published():
            self._stage_silver()
        return self.quality_report().collect()

    @contextmanager
    def _published(self) -> Iterator[None]:
        """Publish what was staged in the block; if it fails, nothing."""
        try:
            yield
        except BaseException:
            self.lake.discard()
            raise
        self.lake.publish()

    def quality_report(self) -> DataFrame:
        """Per checked dataset, from what was written."""
        parts = []
        for name in CHECKED:
            good = self.lake.read("silver", name).select(F.lit("").alias("motivos"))
            bad = self.lake.read("quarantine", name).select("motivos")
            parts.append(quality.report(good.unionByName(bad), name))
        return validate.stacked(parts)

    def reasons(self) -> DataFrame:
        return validate.stacked(
            [quality.reason_counts(self.lake.read("quarantine", n)).select(F.lit(n).alias("fonte"), "*") for n in CHECKED]
        )

    def _stage_gold(self) -> None:
        approved = {n: self.lake.read("silver", n) for n in SOURCES}
        tables = {name: df for name, df in gold.build(approved).items() if name not in gold.MARTS}
        warehouse.side_by_side(lambda name, df: self.lake.stage(df, "gold", name), tables)

    def gold(self) -> dict[str, DataFrame]:
        """Dimensions and facts; marts are views over them."""
        with self._published():
            self._stage_gold()
        return self.register()

    def register(self) -> dict[str, DataFrame]:
        """The published tables under their names in the database."""
        places = {n: self.lake.location("gold", n) for n in TABLES}
        return warehouse.register(self.spark, places, self.database, self.lake.path("gold"))

    def tables(self) -> dict[str, DataFrame]:
        """Gold as staged by this run, or else as published."""
        stored = {n: self.lake.read("gold", n) for n in TABLES}
        return {**stored, **gold.marts(stored)}

    def validate(self) -> DataFrame:
        return validate.validate_all(
            self.landing("events"),
            layers.read_bronze(self.lake, "events"),
            self.lake.read("silver", "events"),
            self.lake.read("quarantine", "events"),
            self.tables(),
        )

    def run(self) -> list:
        """Write, check, publish: all of Silver, quarantine and Gold become visible together, or a failed check leaves
        every published table as it was."""
        self.bronze()
        with self._published():
            self._stage_silver()
            self._stage_gold()
            results = cut_lineage(self.validate())
            validate.require(results)
        self.register()
        return results.collect()
