"""Comparing plans: the same indicator computed in better and worse ways."""

from __future__ import annotations

import contextlib
import io
import re
import time
from collections.abc import Callable, Iterator

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quartzo.functions.columns import money_sum


def plan_text(df: DataFrame) -> str:
    """What ``explain`` prints."""
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        df.explain("simple")
    return shown.getvalue()


def exchanges(df: DataFrame) -> int:
    """Shuffles in the plan before it runs; broadcasts do not count."""
    return len(re.findall(r"(?<!Broadcast)(?<!Reused)\bExchange ", plan_text(df)))


@contextlib.contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame that several outputs read, and let it go afterwards."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def revenue_join_first(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """All lines are shuffled to the orders, then summed."""
    joined = lines.hint("merge").join(orders, "order_id")
    return joined.groupBy("status").agg(F.count(F.lit(1)).alias("linhas"), F.sum("valor").cast("decimal(18,2)").alias("valor"))


def revenue_sum_first(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines are summed per order before the shuffle; one row per order meets the orders."""
    per = lines.groupBy("order_id").agg(F.count(F.lit(1)).alias("linhas"), F.sum("valor").alias("valor"))
    joined = per.hint("merge").join(orders, "order_id")
    return joined.groupBy("status").agg(F.sum("linhas").alias("linhas"), F.sum("valor").cast("decimal(18,2)").alias("valor"))


def salted_sum(df: DataFrame, key: str, value: str, spread: list[str], salts: int = 16) -> DataFrame:
    """Two-stage sum: first per key and salt, then per key.

    Spark's own partial aggregation already does this for sums; the salt matters where
    partial aggregation is given up because keys hardly repeat inside a task.
    """
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts)).alias("_salt")
    first = df.groupBy(key, salt).agg(F.count(F.lit(1)).alias("linhas"), F.sum(value).alias("valor"))
    return first.groupBy(key).agg(F.sum("linhas").alias("linhas"), F.sum("valor").cast("decimal(18,2)").alias("valor"))


def early(table: DataFrame, since: str) -> DataFrame:
    """Filter on the raw column and two columns only: both reach the scan."""
    recent = table.filter(F.col("o_orderdate") >= F.lit(since).cast("timestamp_ntz"))
    return recent.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("pedidos"), money_sum("o_totalprice").alias("total"))


def late(table: DataFrame, since: str) -> DataFrame:
    """The same filter on a computed text: every row has to be read."""
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    wide = table.withColumn("dia", text).filter(F.col("dia") >= since)
    return wide.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("pedidos"), money_sum("o_totalprice").alias("total"))


def measured(spark: SparkSession, steps: dict[str, Callable[[], DataFrame]]) -> DataFrame:
    """Seconds and shuffles per step, written out with no sink."""
    rows = []
    for name, build in steps.items():
        df = build()
        shuffles = exchanges(df)
        start = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        rows.append((name, round(time.perf_counter() - start, 3), shuffles))
    return spark.createDataFrame(rows, "etapa string, segundos double, trocas int")
