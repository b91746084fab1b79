"""Sources, sinks and formats."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartzo.catalog.base import query
from quartzo.functions.columns import money
from quartzo.operators.compare import contents_equal
from quartzo.plans import warehouse
from quartzo.plans.storefront import Storefront
from quartzo.session import scratch
from quartzo.sources import files, formats, packing, relational
from quartzo.sources.lake import Lake

ACCOUNTS_SQL = "SELECT c_custkey, c_name, CAST(c_acctbal AS DECIMAL(12,2)) AS c_acctbal, c_mktsegment FROM customer"
ACCOUNTS_SCHEMA = "c_custkey bigint, c_name string, c_acctbal decimal(12,2), c_mktsegment string"


def accounts(shop: Storefront) -> DataFrame:
    return shop.table("customer").select("c_custkey", "c_name", money("c_acctbal").alias("c_acctbal"), "c_mktsegment")


def written(shop: Storefront, df: DataFrame, fmt: str, label: str) -> str:
    path = scratch(shop.spark, label)
    formats.write_as(df, fmt, path)
    return path


@query("read_csv_inferred", ACCOUNTS_SQL)
def read_csv_inferred(shop):
    back = formats.read_csv(shop.spark, written(shop, accounts(shop), "csv", "csv"))
    return back.select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name", money("c_acctbal").alias("c_acctbal"), "c_mktsegment")


@query(
    "read_csv_all_text",
    "SELECT CAST(product_id AS VARCHAR) AS product_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date, quantity FROM raw_inventory",
)
def read_csv_all_text(shop):
    return formats.read_csv_text(shop.spark, written(shop, shop.inventory(), "csv", "csv-text"))


@query("read_jsonl", "SELECT event_id, session_id, customer_id, product_id, event_type, event_at, device, source FROM raw_events")
def read_jsonl(shop):
    back = formats.read_jsonl(shop.spark, written(shop, shop.events(), "jsonl", "jsonl"))
    return back.select("event_id", "session_id", "customer_id", "product_id", "event_type", "event_at", "device", "source")


@query("read_json_array", ACCOUNTS_SQL)
def read_json_array(shop):
    # One document per 100,000 keys, so no document grows with the table.
    batch = F.expr("c_custkey div 100000").alias("lote")
    docs = accounts(shop).groupBy(batch).agg(F.to_json(F.collect_list(F.struct("*"))).alias("value"))
    path = scratch(shop.spark, "json-array")
    docs.write.partitionBy("lote").text(path)
    return formats.read_json_array(shop.spark, f"{path}/*", ACCOUNTS_SCHEMA).select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"


@query("read_parquet", ORDERS_SQL)
def read_parquet(shop):
    return formats.read_parquet(shop.spark, f"{shop.dir}/orders.parquet")


@query("read_parquet_columns", "SELECT o_orderstatus, o_totalprice FROM orders")
def read_parquet_columns(shop):
    return formats.read_parquet(shop.spark, f"{shop.dir}/orders.parquet", ["o_orderstatus", "o_totalprice"])


@query(
    "read_parquet_glob_union",
    """SELECT event_id, source, CASE WHEN _source_file >= 'events/events_2024-01-16.jsonl' THEN device END AS device FROM raw_events""",
)
def read_parquet_glob_union(shop):
    events = shop.events().select("event_id", "source", "device", "_source_file")
    recent = F.col("_source_file") >= "events/events_2024-01-16.jsonl"
    base = scratch(shop.spark, "union")
    formats.write_parquet(events.filter(~recent).select("event_id", "source"), f"{base}/bronze/events/old/a")
    formats.write_parquet(events.filter(recent).select("event_id", "source", "device"), f"{base}/bronze/events/new")
    return formats.read_union_by_name(shop.spark, f"{base}/bronze/events").select("event_id", "source", "device")


@query(
    "read_hive_partitions",
    "SELECT event_id, user_id, CAST(ts AS DATE) AS event_date FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-14'",
)
def read_hive_partitions(shop):
    path = scratch(shop.spark, "by-day")
    events = shop.table("events").select("event_id", "user_id", F.col("ts").cast("date").alias("event_date"))
    formats.write_partitioned(events, path, ["event_date"])
    return shop.spark.read.parquet(path).filter(F.col("event_date") == F.lit("2024-01-14").cast("date"))


@query("read_jdbc_query", ORDERS_SQL)
def read_jdbc_query(shop):
    # No JDBC driver is at hand: the same key-range conditions cut a Parquet stand-in.
    orders = shop.table("orders")
    low, high = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    return reduce(DataFrame.unionByName, [orders.filter(p) for p in relational.range_predicates("o_orderkey", low or 0, high or 0, 4)])


@query("write_parquet", ACCOUNTS_SQL)
def write_parquet(shop):
    path = scratch(shop.spark, "parquet")
    formats.write_parquet(accounts(shop), path, "snappy")
    return formats.read_parquet(shop.spark, path)


@query(
    "write_parquet_zstd",
    f"SELECT codec, c_custkey, c_name, c_acctbal FROM ({ACCOUNTS_SQL}), (SELECT unnest(['zstd', 'snappy', 'gzip']) AS codec)",
)
def write_parquet_zstd(shop):
    parts = []
    for codec in ("zstd", "snappy", "gzip"):
        path = scratch(shop.spark, f"parquet-{codec}")
        formats.write_parquet(accounts(shop), path, codec)
        parts.append(formats.read_parquet(shop.spark, path, ["c_custkey", "c_name", "c_acctbal"]).withColumn("codec", F.lit(codec)))
    return reduce(DataFrame.unionByName, parts)


@query(
    "write_partitioned",
    """SELECT year(o_orderdate) AS ano, o_orderstatus, count(*) AS linhas, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(18,2)) AS total
       FROM orders GROUP BY ALL""",
)
def write_partitioned(shop):
    path = scratch(shop.spark, "by-year")
    orders = shop.table("orders").select(
        "o_orderkey", money("o_totalprice").alias("total"), F.year("o_orderdate").alias("ano"), "o_orderstatus"
    )
    formats.write_partitioned(orders, path, ["ano", "o_orderstatus"])
    # A rerun for one year replaces that year's folders and leaves the others alone.
    formats.write_partitioned(orders.filter("ano = 1996"), path, ["ano", "o_orderstatus"])
    back = shop.spark.read.parquet(path)
    return back.groupBy(F.col("ano").cast("bigint").alias("ano"), "o_orderstatus").agg(
        F.count(F.lit(1)).alias("linhas"), F.sum("total").cast("decimal(18,2)").alias("total")
    )


@query(
    "convert_format",
    f"SELECT origem, c_custkey, c_name, c_acctbal, c_mktsegment FROM ({ACCOUNTS_SQL}), (SELECT unnest(['csv', 'jsonl']) AS origem)",
)
def convert_format(shop):
    parts = []
    for fmt in ("csv", "jsonl"):
        source = written(shop, accounts(shop), fmt, f"convert-{fmt}")
        target = scratch(shop.spark, f"converted-{fmt}")
        parts.append(formats.convert_to_parquet(shop.spark, source, fmt, target, ACCOUNTS_SCHEMA).withColumn("origem", F.lit(fmt)))
    return reduce(DataFrame.unionByName, parts)


@query("format_size_report")
def format_size_report(shop):
    paths = {fmt: written(shop, shop.table("events"), fmt, f"size-{fmt}") for fmt in ("csv", "jsonl", "parquet")}
    return formats.size_report(shop.spark, paths)


@query("contents_equal", "SELECT true AS mesmas_colunas, CAST(0 AS BIGINT) AS linhas_diferentes, count(*) AS linhas FROM customer")
def equal_contents(shop):
    left = formats.read_csv(shop.spark, written(shop, accounts(shop), "csv", "eq-csv"), ACCOUNTS_SCHEMA)
    right = formats.read_jsonl(shop.spark, written(shop, accounts(shop), "jsonl", "eq-json"), ACCOUNTS_SCHEMA)
    rows = left.agg(F.count(F.lit(1))).scalar()
    return contents_equal(left, right).withColumn("linhas", rows)


@query(
    "inspect_layer",
    """SELECT event_id, session_id, event_type, event_at, device, source, _source_file FROM raw_events
       ORDER BY event_id NULLS FIRST, _source_file NULLS FIRST, session_id NULLS FIRST, event_type NULLS FIRST, event_at NULLS FIRST, device NULLS FIRST, source NULLS FIRST LIMIT 20""",
)
def inspect_layer(shop):
    lake = Lake(shop.spark, scratch(shop.spark, "lake"))
    lake.write(shop.events(), "bronze", "events")
    sample = lake.inspect("bronze", "events", 20, ["event_id", "_source_file", "session_id", "event_type", "event_at", "device", "source"])
    return sample.select("event_id", "session_id", "event_type", "event_at", "device", "source", "_source_file")


@query(
    "list_gold_objects",
    """SELECT * FROM (VALUES ('dim_campanha', 'TABLE'), ('dim_cliente', 'TABLE'), ('dim_data', 'TABLE'), ('dim_produto', 'TABLE'),
       ('fato_entregas', 'TABLE'), ('fato_eventos', 'TABLE'), ('fato_vendas', 'TABLE'), ('mart_campanhas', 'VIEW'),
       ('mart_entregas_transportadora', 'VIEW'), ('mart_funil_origem', 'VIEW'), ('mart_receita_categoria_dia', 'VIEW'))
       AS t(objeto, tipo)""",
)
def list_gold_objects(shop):
    from quartzo.catalog.gold import gold_tables

    with warehouse.database(shop.spark, "gold") as name:
        warehouse.publish(shop.spark, gold_tables(shop), name)
        return warehouse.objects(shop.spark, name)


@query(
    "changed_files",
    """SELECT 1 AS rodada, count(DISTINCT CAST(ts AS DATE)) AS pastas_enviadas, CAST(0 AS BIGINT) AS pastas_ignoradas FROM events
       UNION ALL SELECT 2, 0, count(DISTINCT CAST(ts AS DATE)) FROM events
       UNION ALL SELECT 3, 1, count(DISTINCT CAST(ts AS DATE)) - 1 FROM events""",
)
def changed(shop):
    """Publish by content: all folders first, none when repeated, one after one day changed."""
    path = scratch(shop.spark, "publish")
    events = shop.table("events").select("event_id", "user_id", "value", F.col("ts").cast("date").alias("dia"))
    formats.write_partitioned(events, path, ["dia"])
    first = files.manifest(shop.spark, path)
    target = scratch(shop.spark, "published")
    formats.write_parquet(first, target)
    published = shop.spark.read.parquet(target)
    again = scratch(shop.spark, "manifest-again")
    formats.write_parquet(files.manifest(shop.spark, path), again)
    day = events.agg(F.min("dia")).first()[0]
    formats.write_partitioned(events.filter(F.col("dia") == F.lit(day)).withColumn("value", F.col("value") + 1), path, ["dia"])
    folder = F.element_at(F.split("key", "/"), 1)

    def folders(source: DataFrame, known: DataFrame | None, turn: int) -> DataFrame:
        new = source if known is None else files.changed_files(source, known)
        marked = source.select("key", F.lit(0).alias("n")).unionByName(new.select("key", F.lit(1).alias("n")))
        per = marked.groupBy(folder.alias("pasta")).agg(F.max("n").alias("n"))
        return per.agg(
            F.lit(turn).alias("rodada"), F.count_if(F.col("n") == 1).alias("pastas_enviadas"), F.count_if(F.col("n") == 0).alias("pastas_ignoradas")
        )

    turns = [
        folders(published, None, 1),
        folders(shop.spark.read.parquet(again), published, 2),
        folders(files.manifest(shop.spark, path), published, 3),
    ]
    return reduce(DataFrame.unionByName, turns)


@query(
    "compact_small_files",
    """SELECT l_linenumber AS pasta, count(*) AS linhas, sum(l_orderkey) AS soma, count(DISTINCT l_linenumber) AS arquivos
       FROM lineitem GROUP BY l_linenumber""",
)
def compact_small_files(shop):
    """24 files a folder become one, as a folder holds less than the target."""
    path = scratch(shop.spark, "many")
    lines = shop.table("lineitem").select("l_orderkey", F.col("l_linenumber").alias("pasta"))
    formats.write_partitioned(lines.repartition(24), path, ["pasta"], gather=False)
    packing.pack(shop.spark, path)
    back = shop.spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("arquivo"))
    return back.groupBy("pasta").agg(
        F.count(F.lit(1)).alias("linhas"), F.sum("l_orderkey").alias("soma"), F.count_distinct("arquivo").alias("arquivos")
    )
