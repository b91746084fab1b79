"""All registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quartzo.catalog import (  # noqa: F401  (importing registers the queries)
    aggregates,
    books,
    cleaning,
    formats,
    gold,
    joins,
    lake,
    profiling,
    streams,
    tuning,
    windows,
)
from quartzo.catalog.base import REGISTRY, runner


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: runner(q.build) for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in REGISTRY.items() if q.sql}
