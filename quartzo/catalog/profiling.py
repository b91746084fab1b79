"""Profiling and volume."""

from __future__ import annotations

from pyspark.sql import functions as F

from quartzo.catalog.base import query
from quartzo.operators import profile
from quartzo.plans import mobility
from quartzo.sources.formats import file_sizes


@query(
    "column_types",
    """SELECT * FROM (SELECT 'o_orderkey' AS coluna, 'bigint' AS tipo, count(o_orderkey) AS preenchidos FROM orders
       UNION ALL SELECT 'o_custkey', 'bigint', count(o_custkey) FROM orders
       UNION ALL SELECT 'o_orderstatus', 'string', count(o_orderstatus) FROM orders
       UNION ALL SELECT 'o_totalprice', 'double', count(o_totalprice) FROM orders
       UNION ALL SELECT 'o_orderdate', 'timestamp_ntz', count(o_orderdate) FROM orders
       UNION ALL SELECT 'o_orderpriority', 'string', count(o_orderpriority) FROM orders)""",
)
def column_types(shop):
    return profile.column_types(shop.table("orders"))


_TRIP_COLUMNS = ["evento_id", "data_hora", "cidade", "modal", "distancia_km", "duracao_min", "status", "fonte"]


@query(
    "null_pct_by_column",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS coluna, count(*) - count({c}) AS ausentes,
        CAST(round((count(*) - count({c})) * 100.0::DOUBLE / greatest(count(*), 1), 2) AS DECIMAL(7,2)) AS pct FROM mobility"""
        for c in _TRIP_COLUMNS
    ),
)
def null_pct_by_column(shop):
    return profile.null_pct(mobility.trips(shop))


@query(
    "quality_audit",
    """SELECT count(*) AS linhas, count(*) FILTER (WHERE distancia_km IS NULL) AS distancia_ausente,
       count(*) FILTER (WHERE duracao_min <= 0 OR duracao_min > 240) AS duracao_invalida,
       count(*) - count(DISTINCT evento_id) AS ids_repetidos, count(*) FILTER (WHERE modal = 'Onibus') AS grafia_errada FROM mobility""",
)
def quality_audit(shop):
    return mobility.audit(mobility.trips(shop))


@query("clean_mobility", "SELECT evento_id, data_hora, cidade, modal, distancia_km, duracao_min, status, fonte FROM mob_clean")
def clean_mobility(shop):
    return mobility.clean(mobility.trips(shop))


@query(
    "post_clean_checks",
    """SELECT count(*) - count(DISTINCT evento_id) AS ids_repetidos, count(*) FILTER (WHERE distancia_km IS NULL) AS distancia_ausente,
       count(*) FILTER (WHERE NOT (duracao_min > 0 AND duracao_min < 240)) AS duracao_fora FROM mob_clean""",
)
def post_clean_checks(shop):
    return mobility.post_checks(mobility.clean(mobility.trips(shop)))


@query(
    "growth_curve",
    """SELECT CAST(f AS INTEGER) AS fator, n * f AS linhas, CAST(b * f AS BIGINT) AS bytes FROM
       (SELECT count(*) AS n, CAST(sum(32 + strlen(event_type) + strlen(props)) AS BIGINT) AS b FROM events), (SELECT unnest([1, 2, 4, 8]) AS f)""",
)
def growth_curve(shop):
    width = F.lit(32) + F.octet_length("event_type") + F.octet_length("props")
    return profile.growth(shop.table("events"), [1, 2, 4, 8], width)


@query("table_footprint")
def table_footprint(shop):
    parts = []
    for name in ("events", "orders", "lineitem"):
        df = shop.table(name)
        size = file_sizes(shop.spark, f"{shop.dir}/{name}.parquet").agg(F.sum("length")).scalar()
        parts.append(profile.row_col_count(df).select(F.lit(name).alias("tabela"), "linhas", "colunas").withColumn("bytes", size))
    return profile.stacked(parts)
