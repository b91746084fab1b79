"""Plans: what must reach the scan, and what must not appear."""

import os

import pytest
from pyspark.sql import functions as F

from quartzo.operators import joins, keys, lookup, stock
from quartzo.plans import gold, tuning
from quartzo.plans.storefront import Storefront
from quartzo.plans.tuning import exchanges, plan_text

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def shop(spark):
    return Storefront(spark, DATA)


def test_newest_version_is_cut_before_the_shuffle(shop):
    plan = plan_text(keys.latest_version(shop.table("orders"), ["o_custkey"], ["o_orderdate"]))
    assert "Partial" in plan[plan.index("Exchange") :] and plan.count("WindowGroupLimit") == 2
    assert exchanges(keys.latest_version(shop.table("orders"), ["o_custkey"], ["o_orderdate"])) == 1


def test_lookup_reaches_the_scan(shop):
    plan = plan_text(lookup.point_lookup(shop.table("orders"), "o_orderkey", 7))
    assert "EqualTo(o_orderkey,7)" in plan


def test_only_needed_columns_are_read(shop):
    plan = plan_text(shop.table("orders").select("o_orderstatus"))
    assert "ReadSchema: struct<o_orderstatus:string>" in plan


def test_early_filter(shop):
    orders = shop.table("orders")
    assert "GreaterThanOrEqual(o_orderdate" in plan_text(tuning.early(orders, "1999-01-01"))
    assert "GreaterThanOrEqual(o_orderdate" not in plan_text(tuning.late(orders, "1999-01-01"))


def test_day_filter_skips_folders(spark, shop, tmp_path):
    events = shop.table("events").select("event_id", F.col("ts").cast("date").alias("d"))
    events.write.partitionBy("d").parquet(str(tmp_path / "e"))
    plan = plan_text(spark.read.parquet(str(tmp_path / "e")).filter(F.col("d") == F.lit("2024-01-14").cast("date")))
    assert "PartitionFilters: [isnotnull(d" in plan


def test_top_k_sorts_no_more_than_k(shop):
    assert "TakeOrderedAndProject" in plan_text(shop.table("orders").orderBy(F.desc("o_totalprice")).limit(20))


def test_sum_first_needs_no_more_shuffles(shop):
    lines = shop.table("lineitem").select(F.col("l_orderkey").alias("order_id"), F.col("l_quantity").alias("valor"))
    orders = shop.table("orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"))
    assert exchanges(tuning.revenue_sum_first(lines, orders)) <= exchanges(tuning.revenue_join_first(lines, orders))


def test_domain_lookup_needs_no_join(shop):
    plan = plan_text(joins.domain_join(shop.catalog(), "category", ["Pet"], "c"))
    assert "Join" not in plan and "Exchange" not in plan


def test_broadcast_only_after_a_size_check(shop):
    orders, customers = shop.table("orders").withColumnRenamed("o_custkey", "k"), shop.table("customer").withColumnRenamed("c_custkey", "k")
    assert "BroadcastHashJoin" in plan_text(joins.size_checked_join(orders, customers, ["k"]))
    known = orders.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    orders.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        assert "SortMergeJoin" in plan_text(joins.size_checked_join(orders, customers, ["k"]))
    finally:
        orders.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", known)


def test_funnel_shuffles_sessions_not_copies(spark):
    events = spark.createDataFrame([("a", "s", "purchase")], "origem string, session_id string, tipo string")
    plan = plan_text(gold.mart_funnel_by_source(events))
    assert "Expand" not in plan and plan.count("Exchange") == 2


def test_settling_keeps_books_in_parallel(spark):
    df = spark.createDataFrame([(1, 1, 1)], "livro bigint, vez bigint, qtd bigint")
    shelf = spark.createDataFrame([(1, 1)], "livro bigint, estoque int")
    plan = plan_text(stock.settle(df, shelf, "livro", "vez", "qtd"))
    assert "hashpartitioning(livro" in plan and "SinglePartition" not in plan
