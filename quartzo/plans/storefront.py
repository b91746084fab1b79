"""A shop's raw tables, derived from the given star-schema tables.

The given tables have no defects, so defects are put in by key: the same formula always
breaks the same rows. Nothing here is cleaned; that is the job of the silver plans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quartzo.functions.columns import to_cents
from quartzo.functions.domains import CATEGORIES, FUNNEL_STEPS

GHOST = 1_000_000_000  # added to a key so that it points nowhere


def every(key: str, n: int, rest: int = 0) -> Column:
    return F.col(key) % n == rest


def pick(index: Column, values: list[str]) -> Column:
    """values[index mod length]; a chain of conditions keeps it inside codegen."""
    spot = index % len(values)
    out = F.when(spot == 0, F.lit(values[0]))
    for i, value in enumerate(values[1:], 1):
        out = out.when(spot == i, F.lit(value))
    return out


def add_days(day: Column, days: Column) -> Column:
    return F.date_add(day, days.cast("int"))


_SCHEMAS: dict[str, StructType] = {}  # reading footers again for each use of a table costs a job


class Storefront:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        path = f"{self.dir}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    # reference data -----------------------------------------------------

    def suppliers(self) -> DataFrame:
        nation = self.table("nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("state"))
        # nation has 25 rows at any scale
        joined = self.table("supplier").join(F.broadcast(nation), "s_nationkey", "left")
        return joined.select(F.col("s_suppkey").alias("supplier_id"), F.col("s_name").alias("name"), "state")

    def customers(self) -> DataFrame:
        nation = self.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("state"))
        joined = self.table("customer").join(F.broadcast(nation), "c_nationkey", "left")
        return joined.select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("name"),
            "state",
            add_days(F.lit("2020-01-01").cast("date"), F.col("c_custkey") % 1000).alias("since"),
        )

    def customer_ids(self) -> DataFrame:
        """Just the keys, for checking references."""
        return self.table("customer").select(F.col("c_custkey").alias("customer_id"))

    def product_ids(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("product_id"))

    def products(self) -> DataFrame:
        key = F.col("p_partkey")
        return self.table("part").select(
            key.alias("product_id"),
            F.concat(F.lit("SKU-"), key.cast("string")).alias("sku"),
            F.col("p_name").alias("name"),
            pick(key, CATEGORIES).alias("category"),
            to_cents("p_retailprice").alias("price_cents"),
            F.when(every("p_partkey", 97), key + GHOST).otherwise(key % 10).alias("supplier_id"),
        )

    def catalog(self) -> DataFrame:
        """As read from CSV: every value is text, spelling varies, one file repeats rows."""
        key = F.col("p_partkey")
        official = pick((key / 3).cast("bigint"), CATEGORIES)
        received = (
            F.when(every("p_partkey", 11, 0), F.upper(official))
            .when(every("p_partkey", 11, 1), F.lower(official))
            .when(every("p_partkey", 11, 2), F.concat(F.lit(" "), official))
            .when(every("p_partkey", 11, 3), F.replace(official, F.lit("o"), F.lit("0")))
            .when(every("p_partkey", 11, 4) & every("p_partkey", 7), F.lit("Desconhecida"))
            .otherwise(official)
        )
        first = self.table("part").select(
            key.cast("string").alias("product_id"),
            received.alias("category"),
            F.when(every("p_partkey", 83), "").otherwise(F.concat(F.col("p_size").cast("string"), F.lit(".5"))).alias("weight_kg"),
            F.when(every("p_partkey", 89), key + GHOST).otherwise(key % 10).cast("string").alias("supplier_id"),
            F.lit("csv/catalog.csv").alias("_source_file"),
        )
        late = first.filter(F.col("product_id").cast("bigint") % 101 == 0).withColumn(
            "_source_file", F.lit("csv/catalog_late.csv")
        )
        return first.unionByName(late)

    def inventory(self) -> DataFrame:
        """Five weekly snapshots per product."""
        part = self.table("part").select("p_partkey", "p_size", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("week"))
        level = F.when((F.col("p_partkey") + F.col("week")) % 173 == 0, -F.col("p_size")).otherwise(F.col("p_size") + F.col("week"))
        return part.select(
            F.col("p_partkey").alias("product_id"),
            add_days(F.lit("2024-01-01").cast("date"), F.col("week") * 7).alias("snapshot_date"),
            level.cast("string").alias("quantity"),
        )

    def campaigns(self) -> DataFrame:
        channel = pick(F.col("n_nationkey"), ["direct", "email", "organic", "search", "social", "affiliate"])
        return self.table("nation").select(
            F.col("n_nationkey").cast("bigint").alias("campaign_id"),
            F.concat(F.lit("Campanha "), F.lpad(F.col("n_nationkey").cast("string"), 4, "0")).alias("name"),
            channel.alias("channel"),
        )

    # sales ----------------------------------------------------------------

    def orders(self) -> DataFrame:
        """Captured versions: every eighth order was seen before its last change."""
        key = F.col("o_orderkey")
        day = F.col("o_orderdate").cast("date")
        final = (
            F.when(every("o_orderkey", 7), "CANCELLED")
            .when(F.col("o_orderstatus") == "F", "DELIVERED")
            .when(F.col("o_orderstatus") == "O", "shipped")
            .otherwise(" paid ")
        )
        base = self.table("orders").select(
            key.alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            final.alias("status"),
            pick(key, ["WEB", "app", "Marketplace"]).alias("channel"),
            to_cents("o_totalprice").alias("total_cents"),
            day.alias("created_at"),
            add_days(day, key % 10 + 1).alias("updated_at"),
        )
        early = base.filter(F.col("order_id") % 8 == 0).withColumns(
            {"status": F.lit("paid"), "updated_at": F.col("created_at")}
        )
        return base.unionByName(early)

    def payments(self) -> DataFrame:
        key = F.col("o_orderkey")
        day = F.col("o_orderdate").cast("date")
        final = self.table("orders").filter(~every("o_orderkey", 29)).select(
            key.alias("order_id"),
            F.when(every("o_orderkey", 7), "refunded").otherwise("APPROVED").alias("status"),
            pick(key, ["pix", "card", "boleto"]).alias("method"),
            add_days(day, F.lit(2)).alias("updated_at"),
        )
        early = final.filter(F.col("order_id") % 31 == 0).withColumns(
            {"status": F.lit("pending"), "updated_at": F.date_sub("updated_at", 1)}
        )
        return final.unionByName(early)

    def order_items(self) -> DataFrame:
        """Order lines as captured; (order, line) repeats, so lines still need a dedupe."""
        cents, qty = to_cents("l_extendedprice"), F.col("l_quantity").cast("bigint")
        return self.table("lineitem").select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("item_id"),
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            qty.alias("quantity"),
            # unit price to the cent, half up, in whole cents
            F.call_function("div", cents * 2 + qty, qty * 2).alias("unit_price_cents"),
            F.col("l_suppkey").alias("seller_id"),
            cents.alias("line_cents"),
            to_cents("l_discount").alias("discount_pct"),
            F.col("l_shipdate").cast("date").alias("shipped_on"),
        )

    def shipments(self) -> DataFrame:
        key = F.col("o_orderkey")
        day = F.col("o_orderdate").cast("date")
        status = (
            F.when(every("o_orderkey", 67), "UNKNOWN_VALUE")
            .when(every("o_orderkey", 5), "IN_TRANSIT")
            .when(every("o_orderkey", 5, 1), "Delivered ")
            .otherwise("DELIVERED")
        )
        arrived = ~every("o_orderkey", 67) & ~every("o_orderkey", 5) & ~every("o_orderkey", 71)
        return self.table("orders").select(
            key.alias("shipment_id"),
            F.when(every("o_orderkey", 61), key + GHOST).otherwise(key).alias("order_id"),
            pick(F.col("o_custkey"), ["carrier-a", "carrier-b", "carrier-c", "carrier-d"]).alias("carrier"),
            status.alias("status"),
            add_days(day, F.lit(7)).alias("promised_at"),
            F.when(arrived, add_days(day, key % 12).cast("string")).alias("delivered_at"),
        )

    # navigation -----------------------------------------------------------

    def events(self) -> DataFrame:
        """One JSON-lines file per day, plus a late file that repeats some events."""
        key = F.col("event_id")
        k = F.get_json_object("props", "$.k").cast("bigint")
        day = F.col("ts").cast("date").cast("string")
        step = mapped_step()
        kind = (
            F.when(every("event_id", 67), F.lit(None))
            .when(every("event_id", 4, 1), F.upper(step))
            .when(every("event_id", 4, 2), F.concat(F.lit("  "), step, F.lit(" ")))
            .otherwise(step)
        )
        defect = [
            ("cliente", every("event_id", 59)),
            ("data", every("event_id", 53)),
            ("dispositivo", every("event_id", 61)),
            ("produto", ~every("event_id", 5) & every("event_id", 71)),
            ("tipo", every("event_id", 67)),
        ]
        injected = F.coalesce(*[F.when(cond, F.lit(name)) for name, cond in defect])
        first = self.table("events").select(
            key,
            F.concat_ws("-", F.col("user_id").cast("string"), day).alias("session_id"),
            F.when(every("event_id", 59), F.col("user_id") + GHOST).otherwise(F.col("user_id")).alias("customer_id"),
            F.when(every("event_id", 5), F.lit(None)).when(every("event_id", 71), k + GHOST).otherwise(k).alias("product_id"),
            F.when(step == "purchase", key).alias("order_id"),
            kind.alias("event_type"),
            F.when(every("event_id", 53), "data-invalida")
            .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
            .alias("event_at"),
            F.when(every("event_id", 61), F.lit(None)).otherwise(pick(key, ["WEB", "mobile", " Tablet"])).alias("device"),
            pick(k, ["direct", "email", "organic", "search", "social"]).alias("source"),
            F.concat(F.lit("events/events_"), day, F.lit(".jsonl")).alias("_source_file"),
            injected.alias("injected_issue"),
        )
        late = first.filter(every("event_id", 97)).withColumns(
            {"_source_file": F.lit("events/events_late.jsonl"), "injected_issue": F.lit("duplicado")}
        )
        return first.unionByName(late)


def mapped_step() -> Column:
    """The five event types stand for the five steps of the funnel."""
    out = None
    for name, step in zip(["view", "click", "signup", "error", "purchase"], FUNNEL_STEPS):
        cond = F.col("event_type") == name
        out = F.when(cond, step) if out is None else out.when(cond, step)
    return out
