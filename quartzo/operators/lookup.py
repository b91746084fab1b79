"""Lookup and search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def point_lookup(df: DataFrame, key: str, value) -> DataFrame:
    """No row or one row; the equality reaches the Parquet scan."""
    return df.filter(F.col(key) == F.lit(value))


def search(df: DataFrame, column: str, fragment: str, order_by: list[str] | None = None) -> DataFrame:
    """Rows whose text contains the fragment in any case; % and _ in it are plain text."""
    found = df.filter(F.contains(F.lower(column), F.lit(fragment.lower())))
    return found.orderBy(*order_by) if order_by else found


def list_ordered(df: DataFrame, order_by: list[str]) -> DataFrame:
    """All rows in order; end the list with a unique column, so that no run of equal values stays in one task."""
    return df.orderBy(*order_by)


def query_with(df: DataFrame, text: str, **values) -> DataFrame:
    """Parameterised SQL over the frame, which the text names ``{source}``."""
    return df.sparkSession.sql(text, args=values or None, source=df)
