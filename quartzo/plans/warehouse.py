"""Gold as a database: tables for dimensions and facts, views or tables for marts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from quartzo.plans.gold import MARTS, NAMED
from quartzo.session import scratch


def side_by_side(save: Callable[[str, DataFrame], DataFrame], tables: dict[str, DataFrame], at_once: int = 4) -> dict[str, DataFrame]:
    """Save tables that don't depend on each other as jobs that share the cluster."""
    with ThreadPoolExecutor(at_once) as pool:
        return dict(zip(tables, pool.map(save, tables, tables.values())))


def publish(
    spark: SparkSession, tables: dict[str, DataFrame], database: str, location: str | None = None, marts_as_views: bool = True
) -> dict[str, DataFrame]:
    """Save dimensions and facts, then marts computed from the saved tables.

    A mart that is a view is worked out at each read; one that is a table was worked out
    once. Views last as long as the session.
    """
    location = location or scratch(spark, "warehouse")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")

    def save(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").option("path", f"{location}/{name}").option("compression", "zstd").saveAsTable(f"{database}.{name}")
        return spark.table(f"{database}.{name}")

    saved = side_by_side(save, {name: df for name, df in tables.items() if name not in MARTS})
    for name, builder in MARTS.items():
        mart = builder(saved)
        if marts_as_views:
            mart.createOrReplaceTempView(name)
            saved[name] = mart
        else:
            saved[name] = save(name, mart)
    return saved


def register(spark: SparkSession, places: dict[str, str], database: str, location: str) -> dict[str, DataFrame]:
    """Name tables that are stored already, and the mart views over them."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    tables = {}
    for name, place in places.items():
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.sql(f"CREATE TABLE {database}.{name} USING parquet LOCATION '{place}'")
        tables[name] = spark.table(f"{database}.{name}")
    for name, builder in MARTS.items():
        tables[name] = builder(tables)
        tables[name].createOrReplaceTempView(name)
    return tables


def objects(spark: SparkSession, database: str) -> DataFrame:
    """Tables of the database and its mart views, by name; one row per object."""
    found = {(t.name, "VIEW" if t.isTemporary else "TABLE") for t in spark.catalog.listTables(database)}
    shown = sorted(o for o in found if o[1] == "TABLE" or o[0] in MARTS)
    return spark.createDataFrame(shown, "objeto string, tipo string")


def drop(spark: SparkSession, database: str) -> None:
    """Forget tables and views; data files stay where they are."""
    for name in MARTS:
        spark.catalog.dropTempView(name)
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


@contextmanager
def database(spark: SparkSession, prefix: str) -> Iterator[str]:
    """A database under a name of its own, forgotten at the end."""
    name = f"{prefix}_{uuid.uuid4().hex[:8]}"
    try:
        yield name
    finally:
        drop(spark, name)


def query(spark: SparkSession, database_name: str, name: str) -> DataFrame:
    """A named query over the published tables."""
    mart = NAMED[name]
    return MARTS[mart]({t.name: spark.table(f"{database_name}.{t.name}") for t in spark.catalog.listTables(database_name) if not t.isTemporary})
