"""Bronze, Silver and quality."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from quartzo.catalog.base import query
from quartzo.catalog.views import GHOST
from quartzo.functions import columns as c
from quartzo.functions.domains import COURSE_NAMES
from quartzo.operators import changes, joins, quality
from quartzo.operators.keys import priority_dedupe
from quartzo.operators.profile import stacked
from quartzo.operators.quality import Rule
from quartzo.plans import academic, silver
from quartzo.plans.storefront import Storefront, every
from quartzo.session import cut_lineage, scratch
from quartzo.sources import formats
from quartzo.sources import lake as layers
from quartzo.sources.control import Control, changed_after
from quartzo.sources.files import new_files, relative_key

RUN = datetime(2024, 2, 1)
EVENT_SCHEMA = (
    "event_id bigint, session_id string, customer_id bigint, product_id bigint, order_id bigint, event_type string, "
    "event_at string, device string, source string, injected_issue string, dia string"
)


def checked_events(shop: Storefront):
    return silver.check_events(shop.events(), shop.customer_ids(), shop.product_ids())


def checked_catalog(shop: Storefront):
    return silver.check_catalog(shop.catalog(), shop.suppliers())


def checked_shipments(shop: Storefront):
    return silver.check_shipments(shop.shipments(), silver.stg_orders(shop.orders()))


def landed_events(shop: Storefront) -> layers.Lake:
    """Event files in a landing area, one folder per source file."""
    lake = layers.Lake(shop.spark, scratch(shop.spark, "lake"))
    events = shop.events()
    folder = F.regexp_extract("_source_file", "events_(.+)[.]jsonl", 1)
    out = events.withColumns({"arquivo": folder, "dia": folder}).drop("_source_file")
    out.hint("rebalance", "arquivo").write.partitionBy("arquivo").json(lake.path("landing", "events"))
    return lake


BRONZE_SQL = """SELECT event_id, event_type, event_at, device, regexp_extract(_source_file, 'events_(.+)[.]jsonl', 1) AS origem FROM raw_events"""


@query("bronze_ingest", BRONZE_SQL)
def bronze_ingest(shop):
    lake = landed_events(shop)
    stored = layers.bronze(shop.spark, lake, "events", "jsonl", RUN, EVENT_SCHEMA)
    origin = F.regexp_extract("_source_file", "^events/arquivo=([^/]+)/", 1)
    return stored.select("event_id", "event_type", "event_at", "device", origin.alias("origem"))


@query(
    "bronze_idempotent",
    """SELECT 1 AS rodada, count(*) AS linhas, count(DISTINCT _source_file) AS origens FROM raw_events
       UNION ALL SELECT 2, count(*), count(DISTINCT _source_file) FROM raw_events""",
)
def bronze_idempotent(shop):
    lake = landed_events(shop)
    runs = []
    for turn in (1, 2):
        stored = layers.bronze(shop.spark, lake, "events", "jsonl", RUN, EVENT_SCHEMA)
        origin = F.regexp_extract("_source_file", "arquivo=([^/]+)/", 1)
        counted = stored.groupBy(origin.alias("o")).agg(F.count(F.lit(1)).alias("n"))
        kept = scratch(shop.spark, "bronze-count")
        formats.write_parquet(
            counted.agg(F.lit(turn).alias("rodada"), F.sum("n").alias("linhas"), F.count(F.lit(1)).alias("origens")), kept
        )
        runs.append(shop.spark.read.parquet(kept))
    return stacked(runs)


@query(
    "incremental_extract",
    """SELECT 1 AS lote, order_id, updated_at FROM orders_last WHERE updated_at > DATE '1996-12-31' AND
       (updated_at < DATE '1998-06-30' OR updated_at = DATE '1998-06-30' AND order_id % 2 = 0)
       UNION ALL SELECT 2, order_id, updated_at FROM orders_last o WHERE updated_at > DATE '1998-06-30' OR updated_at = DATE '1998-06-30' AND order_id >
       (SELECT coalesce(max(order_id), 0) FROM orders_last WHERE updated_at = DATE '1998-06-30' AND order_id % 2 = 0)""",
)
def incremental_extract(shop):
    """The first extract sees only some orders of its last day; the second goes on behind the last of these, on the same day."""
    orders = shop.orders().filter("order_id % 8 <> 0 or updated_at <> created_at").select("order_id", "updated_at")
    control = Control(shop.spark, scratch(shop.spark, "control"))
    batches = []
    for turn, seen in ((1, "updated_at < date'1998-06-30' or updated_at = date'1998-06-30' and order_id % 2 = 0"), (2, "true")):
        place = control.place("orders", "1996-12-31", "date", "bigint")
        batch = changed_after(orders.filter(seen), "updated_at", "order_id", place, "date").withColumn("lote", F.lit(turn))
        path = scratch(shop.spark, "extract")
        formats.write_parquet(batch, path)
        stored = shop.spark.read.parquet(path)
        last = stored.agg(F.max(F.struct("updated_at", "order_id")).alias("p")).select("p.*").first()
        if last.updated_at:
            control.advance("orders", str(last.updated_at), str(last.order_id))
        batches.append(stored.select("lote", "order_id", "updated_at"))
    return stacked(batches)


@query("file_manifest_skip", "SELECT event_id, CAST(ts AS DATE) AS dia FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-10'")
def file_manifest_skip(shop):
    path = scratch(shop.spark, "daily")
    events = shop.table("events").select("event_id", F.col("ts").cast("date").alias("dia"))
    formats.write_partitioned(events.withColumn("data", F.col("dia").cast("string")), path, ["data"])
    folder = F.regexp_extract("key", "^data=([0-9-]+)/", 1)
    listing = formats.file_sizes(shop.spark, path).select(relative_key(F.col("path"), path).alias("key")).withColumn("data", folder)
    todo = new_files(listing, listing.filter(F.col("data") <= "2024-01-10"))
    # The folder column prunes whole folders at run time, the file key decides inside them.
    stored = shop.spark.read.schema("event_id bigint, dia date, data string").parquet(path)
    tagged = stored.withColumn("key", relative_key(F.col("_metadata.file_path"), path))
    return tagged.join(todo, ["data", "key"], "left_semi").select("event_id", "dia")


@query("run_tagging", "SELECT order_id, status, 'carga-2024-02-01' AS run_id FROM stg_orders")
def run_tagging(shop):
    return silver.stg_orders(shop.orders()).select("order_id", "status").withColumn("run_id", F.lit("carga-2024-02-01"))


CHANGES_SQL = f"""SELECT order_id, 'returned' AS status, updated_at + 100 AS updated_at FROM stg_orders WHERE order_id % 10 = 3
       UNION ALL SELECT order_id, 'stale', updated_at - 100 FROM stg_orders WHERE order_id % 10 = 4
       UNION ALL SELECT order_id + {GHOST}, 'paid', updated_at FROM stg_orders WHERE order_id % 50 = 0"""


def order_changes(orders):
    return stacked(
        [
            orders.filter("order_id % 10 = 3").withColumns({"status": F.lit("returned"), "updated_at": F.date_add("updated_at", 100)}),
            orders.filter("order_id % 10 = 4").withColumns({"status": F.lit("stale"), "updated_at": F.date_sub("updated_at", 100)}),
            orders.filter("order_id % 50 = 0").withColumns({"order_id": F.col("order_id") + GHOST, "status": F.lit("paid")}),
        ]
    )


@query(
    "upsert_by_key",
    f"""SELECT order_id, status, updated_at FROM (SELECT order_id, status, updated_at FROM stg_orders UNION ALL {CHANGES_SQL})
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC) = 1""",
)
def upsert_by_key(shop):
    base = cut_lineage(silver.stg_orders(shop.orders()).select("order_id", "status", "updated_at"))
    return changes.upsert(base, order_changes(base), ["order_id"], "updated_at")


@query(
    "upsert_in_folders",
    f"""SELECT order_id, status, updated_at, order_id < 3000 AS refeito FROM (SELECT order_id, status, updated_at FROM stg_orders UNION ALL
        SELECT order_id, 'returned', updated_at + 100 FROM stg_orders WHERE order_id < 3000 AND order_id % 10 = 3)
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC) = 1""",
)
def upsert_in_folders(shop):
    """Changes of one range of ids: only its folder of the stored table is read and written."""
    path = scratch(shop.spark, "orders")
    base = cut_lineage(silver.stg_orders(shop.orders()).select("order_id", "status", "updated_at"))
    faixa = F.floor(F.col("order_id") / 3000).cast("bigint")
    formats.write_partitioned(base.withColumns({"refeito": F.lit(False), "faixa": faixa}), path, ["faixa"])
    late = base.filter("order_id < 3000 and order_id % 10 = 3").select(
        "order_id", F.lit("returned").alias("status"), F.date_add("updated_at", 100).alias("updated_at"), F.lit(True).alias("refeito")
    )
    changes.upsert_folders(shop.spark, path, late, ["order_id"], "updated_at", "faixa", faixa, touch={"refeito": F.lit(True)})
    return shop.spark.read.parquet(path).select("order_id", "status", "updated_at", "refeito")


@query("delete_by_key", "SELECT id, titulo, isbn FROM livros WHERE estoque % 10 <> 0")
def delete_by_key(shop):
    from quartzo.plans.bookstore import books

    shelf = books(shop)
    return changes.delete_keys(shelf, shelf.filter("estoque % 10 = 0"), ["id"]).select("id", "titulo", "isbn")


@query(
    "apply_cdc",
    f"""WITH ch AS (SELECT order_id, 'shipped' AS status, 1 AS seq, 'U' AS op FROM stg_orders WHERE order_id % 6 = 0
       UNION ALL SELECT order_id, 'delivered', 2, 'U' FROM stg_orders WHERE order_id % 12 = 0
       UNION ALL SELECT order_id, status, 3, 'D' FROM stg_orders WHERE order_id % 36 = 0
       UNION ALL SELECT order_id + {GHOST}, 'paid', 4, 'I' FROM stg_orders WHERE order_id % 40 = 0),
       l AS (SELECT * FROM ch QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY seq DESC) = 1)
       SELECT order_id, status FROM stg_orders WHERE order_id NOT IN (SELECT order_id FROM l)
       UNION ALL SELECT order_id, status FROM l WHERE op <> 'D'""",
)
def apply_cdc(shop):
    base = cut_lineage(silver.stg_orders(shop.orders()).select("order_id", "status"))
    change = lambda cond, status, seq, op, move=0: base.filter(cond).select(
        (F.col("order_id") + move).alias("order_id"), status.alias("status"), F.lit(seq).alias("seq"), F.lit(op).alias("op")
    )
    log = stacked(
        [
            change("order_id % 6 = 0", F.lit("shipped"), 1, "U"),
            change("order_id % 12 = 0", F.lit("delivered"), 2, "U"),
            change("order_id % 36 = 0", F.col("status"), 3, "D"),
            change("order_id % 40 = 0", F.lit("paid"), 4, "I", GHOST),
        ]
    )
    return changes.apply_cdc(base, log, ["order_id"], "seq", "op")


@query(
    "standardize_silver",
    """SELECT order_id, updated_at, lower(trim(status)) AS status, lower(trim(channel)) AS channel,
       CAST(total_cents / 100.0 AS DECIMAL(12,2)) AS total_cents FROM raw_orders""",
)
def standardize_silver(shop):
    orders = shop.orders().select("order_id", "updated_at", "status", "channel", "total_cents")
    return silver.standardize(orders, {"status": "code", "channel": "code", "total_cents": "cents"})


@query(
    "priority_dedupe",
    """SELECT product_id, category, weight_kg, _source_file FROM raw_catalog
       QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY CASE WHEN weight_kg <> '' THEN 0 ELSE 1 END, _source_file DESC, category, weight_kg, supplier_id) = 1""",
)
def best_row(shop):
    complete = F.when(F.col("weight_kg") != "", 0).otherwise(1)
    best = priority_dedupe(shop.catalog(), ["product_id"], [complete.asc(), F.col("_source_file").desc()])
    return best.select("product_id", "category", "weight_kg", "_source_file")


@query(
    "reject_reason_split",
    """SELECT m AS motivos, count(*) AS linhas, CAST(sum(line_cents) AS BIGINT) AS centavos FROM
       (SELECT line_cents, concat_ws(', ', CASE WHEN quantity > 45 THEN 'quantidade_alta' END,
       CASE WHEN discount_pct >= 9 THEN 'desconto_alto' END, CASE WHEN shipped_on < DATE '1996-01-01' THEN 'antigo' END) AS m
       FROM raw_order_items) GROUP BY m""",
)
def reject_reason_split(shop):
    rules = [
        Rule("quantidade_alta", F.col("quantity") > 45),
        Rule("desconto_alto", F.col("discount_pct") >= 9),
        Rule("antigo", F.col("shipped_on") < F.lit("1996-01-01").cast("date")),
    ]
    checked = quality.check(shop.order_items(), rules)
    return checked.groupBy("motivos").agg(F.count(F.lit(1)).alias("linhas"), F.sum("line_cents").alias("centavos"))


@query("silver_latest", "SELECT order_id, customer_id, status, channel, total, created_at, updated_at FROM stg_orders")
def silver_latest(shop):
    return silver.stg_orders(shop.orders())


@query("domain_standardize", "SELECT product_id, category_raw, category, _source_file FROM chk_catalog")
def domain_standardize(shop):
    return checked_catalog(shop).select("product_id", "category_raw", "category", "_source_file")


@query("check_events", "SELECT * EXCLUDE (injected_issue) FROM chk_events")
def check_events(shop):
    return checked_events(shop).drop("injected_issue")


@query("check_catalog", "SELECT * FROM chk_catalog")
def check_catalog(shop):
    return checked_catalog(shop)


@query("check_inventory", "SELECT * FROM chk_inventory")
def check_inventory(shop):
    return silver.check_inventory(shop.inventory())


@query("check_shipments", "SELECT * FROM chk_shipments")
def check_shipments(shop):
    return checked_shipments(shop)


@query("split_silver", "SELECT event_id, event_type, device, source, event_date FROM silver_events")
def split_silver(shop):
    lake = layers.Lake(shop.spark, scratch(shop.spark, "lake"))
    lake.write(silver.silver_events(checked_events(shop)), "silver", "events", ["event_date"])
    return lake.read("silver", "events").select("event_id", "event_type", "device", "source", "event_date")


@query(
    "split_quarantine",
    """SELECT event_id, event_at_raw, motivos, _source_file, TIMESTAMP '2024-02-01 00:00:00' AS quarantined_at FROM chk_events WHERE motivos <> ''""",
)
def split_quarantine(shop):
    lake = layers.Lake(shop.spark, scratch(shop.spark, "lake"))
    lake.write(silver.quarantine(checked_events(shop), RUN), "quarantine", "events")
    return lake.read("quarantine", "events").select("event_id", "event_at_raw", "motivos", "_source_file", "quarantined_at")


@query(
    "quarantine_reasons",
    "SELECT unnest(string_split(motivos, ', ')) AS motivo, count(*) AS linhas FROM chk_events WHERE motivos <> '' GROUP BY 1",
)
def quarantine_reasons(shop):
    return quality.reason_counts(checked_events(shop))


def _report_sql(view: str, name: str) -> str:
    return f"""SELECT '{name}' AS fonte, count(*) AS lidos, count(*) FILTER (WHERE motivos = '') AS aprovados,
        count(*) FILTER (WHERE motivos <> '') AS quarentena,
        CAST(round(count(*) FILTER (WHERE motivos <> '') * 100.0::DOUBLE / greatest(count(*), 1), 2) AS DECIMAL(7,2)) AS percentual FROM {view}"""


@query(
    "quality_report",
    " UNION ALL ".join(_report_sql(f"chk_{n}", n) for n in ("events", "catalog", "shipments", "inventory")),
)
def quality_report(shop):
    return stacked(
        [
            quality.report(checked_events(shop), "events"),
            quality.report(checked_catalog(shop), "catalog"),
            quality.report(checked_shipments(shop), "shipments"),
            quality.report(silver.check_inventory(shop.inventory()), "inventory"),
        ]
    )


@query(
    "reconcile",
    """SELECT 'events' AS fonte, (SELECT count(*) FROM raw_events) AS lidos, count(*) FILTER (WHERE motivos = '') AS aprovados,
       count(*) FILTER (WHERE motivos <> '') AS quarentena, (SELECT count(*) FROM raw_events) = count(*) AS fecha FROM chk_events
       UNION ALL SELECT 'shipments', (SELECT count(*) FROM raw_shipments), count(*) FILTER (WHERE motivos = ''),
       count(*) FILTER (WHERE motivos <> ''), (SELECT count(*) FROM raw_shipments) = count(*) FROM chk_shipments""",
)
def reconcile(shop):
    # Stored once: both sides of a split read the same checked rows.
    events, shipments = cut_lineage(checked_events(shop)), cut_lineage(checked_shipments(shop))
    return stacked(
        [
            quality.reconcile(shop.events(), *quality.split(events), "events"),
            quality.reconcile(shop.shipments(), *quality.split(shipments), "shipments"),
        ]
    )


@query(
    "blocking_threshold",
    """SELECT _source_file AS lote, count(*) AS lidos, count(*) FILTER (WHERE motivos <> '') AS quarentena,
       count(*) FILTER (WHERE motivos <> '') * 100 > count(*) * 10 AS bloqueia FROM chk_events GROUP BY 1""",
)
def blocking_threshold(shop):
    ratios = quality.ratio_by(checked_events(shop), F.col("_source_file"))
    return ratios.withColumn("bloqueia", F.col("quarentena") * 100 > F.col("lidos") * 10)


@query(
    "alert_coherence",
    """SELECT o.order_id, o.status, s.shipment_id, s.delivered_at FROM stg_orders o JOIN chk_shipments s ON s.order_id = o.order_id
       WHERE o.status = 'cancelled' AND s.status = 'delivered' AND s.motivos = ''""",
)
def alert_coherence(shop):
    return silver.cancelled_but_delivered(silver.stg_orders(shop.orders()), quality.approved(checked_shipments(shop)))


@query(
    "source_disagreement",
    """SELECT p.product_id, p.category AS categoria_vendas, k.category AS categoria_catalogo FROM stg_products p
       JOIN chk_catalog k ON k.product_id = p.product_id WHERE k.motivos = '' AND p.category IS DISTINCT FROM k.category""",
)
def source_disagreement(shop):
    return silver.category_disagreement(silver.stg_products(shop.products()), quality.approved(checked_catalog(shop)))


@query(
    "tracking_gap",
    "SELECT campaign_id, name, channel FROM raw_campaigns WHERE channel NOT IN (SELECT source FROM silver_events WHERE source IS NOT NULL)",
)
def tracking_gap(shop):
    return silver.tracking_gaps(shop.campaigns(), silver.silver_events(checked_events(shop)))


@query(
    "source_of_truth_merge",
    """SELECT p.product_id, p.name, p.category, p.price, k.weight_kg, s.name AS supplier FROM stg_products p
       LEFT JOIN (SELECT * FROM chk_catalog WHERE motivos = '') k ON k.product_id = p.product_id
       LEFT JOIN stg_suppliers s ON s.supplier_id = p.supplier_id""",
)
def source_of_truth_merge(shop):
    sales = silver.stg_products(shop.products())
    catalog = quality.approved(checked_catalog(shop)).select("product_id", "weight_kg")
    owners = shop.suppliers().select("supplier_id", F.col("name").alias("supplier"))
    merged = sales.join(catalog, "product_id", "left").join(owners, "supplier_id", "left")
    return merged.select("product_id", "name", "category", "price", "weight_kg", "supplier")


@query(
    "rule_scorecard",
    """SELECT count(*) FILTER (WHERE injected_issue IS NOT NULL AND motivos = '') AS nao_detectados,
       count(*) FILTER (WHERE injected_issue IS NULL AND motivos <> '') AS falsos_positivos,
       count(*) FILTER (WHERE injected_issue IS NOT NULL AND motivos <> '') AS detectados,
       count(*) FILTER (WHERE injected_issue IS NULL AND motivos = '') AS corretos FROM chk_events""",
)
def rule_scorecard(shop):
    return quality.scorecard(checked_events(shop), F.col("injected_issue").isNotNull())


@query(
    "reprocess_quarantine",
    f"""SELECT event_id, _source_file, concat_ws(', ',
       CASE WHEN ocorrencia > 1 THEN 'duplicado' END, CASE WHEN event_type IS NULL THEN 'tipo_ausente' END,
       CASE WHEN event_at IS NULL THEN 'data_invalida' END, CASE WHEN device IS NULL THEN 'dispositivo_ausente' END,
       CASE WHEN customer_id NOT IN (SELECT customer_id FROM stg_customers) AND customer_id NOT IN (SELECT customer_id + {GHOST} FROM stg_customers)
            THEN 'cliente_inexistente' END,
       CASE WHEN product_id IS NOT NULL AND product_id NOT IN (SELECT product_id FROM stg_products) THEN 'produto_inexistente' END) AS motivos
       FROM chk_events WHERE motivos <> ''""",
)
def reprocess_quarantine(shop):
    """The missing customers were registered meanwhile: part of the quarantine can return."""
    known = shop.customer_ids()
    registered = known.unionByName(known.select((F.col("customer_id") + GHOST).alias("customer_id")))
    held = silver.quarantine(checked_events(shop), RUN)
    return silver.recheck_events(held, registered, shop.product_ids()).select("event_id", "_source_file", "motivos")


@query("range_gate", "SELECT id_aluno, nota FROM (SELECT id_aluno, try_cast(nota AS DECIMAL(4,2)) AS nota FROM matriculas) WHERE nota IS NOT NULL")
def range_gate(shop):
    return quality.range_gate(academic.treated(academic.enrolments(shop)), "nota", 0, 10).select("id_aluno", "nota")


TREATED_SQL = """SELECT id_aluno, upper(trim(curso)) AS curso, try_cast(nota AS DECIMAL(4,2)) AS nota FROM matriculas
       WHERE try_cast(nota AS DECIMAL(4,2)) IS NOT NULL"""


@query(
    "post_load_checks",
    f"""SELECT count(*) AS linhas, count(DISTINCT id_aluno) AS alunos, count(*) FILTER (WHERE NOT (nota BETWEEN 0 AND 10)) AS fora_da_faixa
        FROM ({TREATED_SQL})""",
)
def post_load_checks(shop):
    path = scratch(shop.spark, "treated")
    formats.write_parquet(academic.treated(academic.enrolments(shop)), path)
    return academic.loaded_checks(shop.spark.read.parquet(path))


@query(
    "academic_etl",
    """SELECT c_custkey AS id_aluno, 'SISTEMAS DE INFORMAÇÃO' AS curso, CAST((c_custkey % 101) / 10.0 AS DECIMAL(4,2)) AS nota,
       coalesce(quantidade_acessos, 0) AS quantidade_acessos FROM customer LEFT JOIN acessos ON id_aluno = c_custkey""",
)
def academic_etl(shop):
    students, visits, out = scratch(shop.spark, "matriculas"), scratch(shop.spark, "acessos"), scratch(shop.spark, "alunos")
    # CSV readers trim nothing by default, so the padded names arrive as they were written.
    academic.enrolments(shop, with_bad_grades=False).write.option("header", True).option("ignoreTrailingWhiteSpace", False).option(
        "ignoreLeadingWhiteSpace", False
    ).csv(students)
    formats.write_as(academic.accesses(shop), "jsonl", visits)
    extracted = formats.read_csv(shop.spark, students, "id_aluno bigint, curso string, nota string")
    counted = formats.read_jsonl(shop.spark, visits, "id_aluno bigint, quantidade_acessos bigint")
    formats.write_parquet(academic.transform(extracted, counted), out)
    return shop.spark.read.parquet(out)


@query("elt_treated_table", TREATED_SQL)
def elt_treated_table(shop):
    raw, out = scratch(shop.spark, "raw-grades"), scratch(shop.spark, "treated-grades")
    formats.write_parquet(academic.enrolments(shop), raw)
    loaded = shop.spark.read.parquet(raw)
    treated = shop.spark.sql(
        """SELECT id_aluno, upper(trim(curso)) AS curso, try_cast(nota AS decimal(4,2)) AS nota FROM {loaded}
           WHERE try_cast(nota AS decimal(4,2)) IS NOT NULL""",
        loaded=loaded,
    )
    formats.write_parquet(treated, out)
    return shop.spark.read.parquet(out)


@query("course_identity_map", "SELECT id_aluno, curso AS codigo, 'SISTEMAS DE INFORMAÇÃO' AS curso FROM matriculas")
def course_identity_map(shop):
    names = shop.spark.createDataFrame(list(COURSE_NAMES.items()), "_code string, oficial string")
    coded = academic.enrolments(shop).select("id_aluno", F.col("curso").alias("codigo"))
    joined = coded.join(F.broadcast(names), F.trim("codigo") == F.col("_code"), "left")
    return joined.select("id_aluno", "codigo", F.col("oficial").alias("curso"))


@query(
    "freshness",
    """SELECT 'events' AS fonte, CAST(date_diff('second', max(ts), TIMESTAMP '2024-01-31 12:00:00') // 3600 AS BIGINT) AS idade_horas,
       date_diff('second', max(ts), TIMESTAMP '2024-01-31 12:00:00') // 3600 > 24 AS atrasado FROM (SELECT date_trunc('second', ts) AS ts FROM events)
       UNION ALL SELECT 'orders', CAST(date_diff('second', max(o_orderdate), TIMESTAMP '2024-01-31 12:00:00') // 3600 AS BIGINT),
       date_diff('second', max(o_orderdate), TIMESTAMP '2024-01-31 12:00:00') // 3600 > 24 FROM orders""",
)
def freshness(shop):
    now = F.unix_timestamp(F.lit("2024-01-31 12:00:00").cast("timestamp"))

    def age(table: str, column: str):
        newest = F.unix_timestamp(F.max(column).cast("timestamp"))
        hours = shop.table(table).agg(F.floor((now - newest) / 3600).cast("bigint").alias("idade_horas"))
        return hours.select(F.lit(table).alias("fonte"), "idade_horas", (F.col("idade_horas") > 24).alias("atrasado"))

    return stacked([age("events", "ts"), age("orders", "o_orderdate")])
