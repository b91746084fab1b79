"""Registry of named queries: a Spark builder each, and SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from quartzo.catalog.views import with_views
from quartzo.plans.storefront import Storefront
from quartzo.session import prepare

Builder = Callable[[Storefront], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Builder
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, recursive: bool = False, **views: str) -> Callable[[Builder], Builder]:
    """Register a builder; ``sql`` may name any derived view. Without SQL only rows are checked."""

    def register(build: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"query {name!r} is registered twice")
        REGISTRY[name] = Query(build, with_views(sql, recursive, **views) if sql else None)
        return build

    return register


def runner(build: Builder) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(Storefront(prepare(spark), sf_dir))
