"""Registered queries against their SQL twins on the smallest tables."""

import os
import sys

import pytest

from quartzo import catalog

DATA = "/root/testdata/sf0.001"
ROWS_ONLY = {"format_size_report", "table_footprint", "optimization_log"}
SAMPLE = [
    "mart_receita_categoria_dia",
    "dim_produto",
    "check_catalog",
    "check_shipments",
    "global_median",
    "rank_per_group",
    "sale_with_items",
    "outlier_users",
    "compare_periods",
    "settle_sales",
    "file_manifest_skip",
    "stream_hourly_counts",
]


def test_every_query_has_a_twin():
    assert set(catalog.queries()) - set(catalog.oracle_sql()) == ROWS_ONLY


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", SAMPLE)
def test_same_rows(spark, name):
    pytest.importorskip("duckdb")
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
    from check import compare, duck

    assert compare(catalog.queries()[name](spark, DATA), duck(DATA), catalog.oracle_sql()[name]) == ""
