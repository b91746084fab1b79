"""Ranks and running values by a segmented scan: one plan, whatever the size of a key.

Rows are range-partitioned by key and order together, so a key of any size is cut into several ranges. Inside a range a
plain window does the work; what earlier ranges hold of a range's first key is carried over by the boundary keys of every
range, at most two small rows each. Ties of the order are broken by all other columns, exact copies by their place.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from quartzo.session import cut_lineage

#: Bits that a row's place takes in an increasing id, below the number of its partition.
PLACE_BITS = 33


@dataclass
class Ranges:
    """Rows in ranges: ``rows`` has the frame's columns, _range, _at (place in the range) and _key (struct of the keys)."""

    rows: DataFrame
    columns: list[str]

    @property
    def inside(self) -> WindowSpec:
        return Window.partitionBy("_range", "_key").orderBy("_at")

    def boundary(self, partial: Column, carry: Callable[[WindowSpec], Column]) -> DataFrame:
        """_range, _key and _carry for the first and last key of every range: two rows each at most, safe to broadcast."""
        ends = self.rows.groupBy("_range").agg(F.min_by("_key", "_at").alias("_first"), F.max_by("_key", "_at").alias("_last"))
        edge = self.rows.join(F.broadcast(ends), "_range").where((F.col("_key") == F.col("_first")) | (F.col("_key") == F.col("_last")))
        parts = edge.groupBy("_range", "_key").agg(partial.alias("_part"))
        return F.broadcast(parts.select("_range", "_key", carry(Window.partitionBy("_key").orderBy("_range")).alias("_carry")))

    def with_carry(self, local: Column, partial: Column, carry: Callable[[WindowSpec], Column], merge: Callable[[Column, Column], Column], name: str) -> DataFrame:
        """Add ``name``: the value inside the range, merged with what the ranges before (or after) carry over."""
        rows = self.rows.withColumn("_local", local).join(self.boundary(partial, carry), ["_range", "_key"], "left")
        return rows.select(*self.columns, merge(F.col("_local"), F.col("_carry")).alias(name))


def before(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def upto(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, 0)


def _sortable(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(_sortable(f.dataType) for f in kind.fields)
    return _sortable(kind.elementType) if isinstance(kind, ArrayType) else kind.typeName() not in ("map", "variant")


def ranges(df: DataFrame, keys: list[str], order: list[str | Column]) -> Ranges:
    """Lay the rows out by keys, order, the other columns (nulls first), and store them."""
    given = [F.col(o).asc_nulls_first() if isinstance(o, str) else o for o in order]
    named = {o for o in order if isinstance(o, str)}
    sortable = [f.name for f in df.schema.fields if _sortable(f.dataType)]
    rest = [F.col(c).asc_nulls_first() for c in sortable if c not in keys and c not in named]
    total = [*(F.col(k).asc_nulls_first() for k in keys), *given, *rest, F.col("_copy").asc()]
    rows = df.withColumn("_copy", F.monotonically_increasing_id()).repartitionByRange(*total).sortWithinPartitions(*total)
    rows = rows.withColumn("_id", F.monotonically_increasing_id())
    laid = rows.select(
        *df.columns, F.struct(*keys).alias("_key") if keys else F.struct(F.lit(0).alias("all")).alias("_key"),
        F.shiftright("_id", PLACE_BITS).cast("int").alias("_range"), F.col("_id").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).alias("_at"),
    )
    return Ranges(cut_lineage(laid), df.columns)


def number(df: DataFrame, keys: list[str], order: list[str | Column], name: str, of: str | None = None) -> DataFrame:
    """1, 2, ... inside each key; without keys over all rows. ``of``: a column for the key's number of rows."""
    laid = ranges(df, keys, order)
    if not keys:  # a row's place in its range and the sizes of the ranges before say it all
        sizes = laid.rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
        ahead = F.coalesce(F.sum("_n").over(before(Window.orderBy("_range"))), F.lit(0))
        sizes = sizes.select("_range", ahead.alias("_ahead"), F.sum("_n").over(Window.partitionBy(F.lit(0))).alias("_all"))
        out = laid.rows.join(F.broadcast(sizes), "_range")
        return out.select(*df.columns, (F.col("_at") + F.col("_ahead") + 1).cast("bigint").alias(name), *([F.col("_all").alias(of)] if of else []))
    here = F.struct(F.row_number().over(laid.inside).alias("n"), F.count(F.lit(1)).over(Window.partitionBy("_range", "_key")).alias("all"))
    ahead = lambda w: F.struct(F.coalesce(F.sum("_part").over(before(w)), F.lit(0)).alias("n"), F.sum("_part").over(Window.partitionBy("_key")).alias("all"))
    merge = lambda here, carry: F.struct(
        (here["n"] + F.coalesce(carry["n"], F.lit(0))).cast("bigint").alias("n"), F.coalesce(carry["all"], here["all"]).alias("all")
    )
    out = laid.with_carry(here, F.count(F.lit(1)), ahead, merge, "_number")
    return out.select(*df.columns, F.col("_number.n").alias(name), *([F.col("_number.all").alias(of)] if of else []))


def running_sum(df: DataFrame, keys: list[str], order: list[str | Column], value: str, name: str) -> DataFrame:
    """Sum of ``value`` up to and including the row; NULL while there is none but NULL."""
    laid = ranges(df, keys, order)
    return laid.with_carry(
        F.sum(value).over(upto(laid.inside)), F.sum(value), lambda w: F.sum("_part").over(before(w)),
        lambda here, ahead: F.coalesce(here + ahead, here, ahead), name,
    )


def neighbour(df: DataFrame, keys: list[str], order: list[str | Column], values: list[str], name: str, following: bool = False) -> DataFrame:
    """Struct of ``values`` of the key's previous (or following) row; NULL at the end."""
    laid = ranges(df, keys, order)
    move, edge, payload = (F.lead, F.min_by, F.struct(*values)) if following else (F.lag, F.max_by, F.struct(*values))
    return laid.with_carry(
        move(payload).over(laid.inside), edge(payload, F.col("_at")), lambda w: move("_part").over(w),
        lambda here, beyond: F.coalesce(here, beyond), name,
    )


def last_known(df: DataFrame, keys: list[str], order: list[str | Column], value: str, name: str) -> DataFrame:
    """The key's last non-null ``value`` up to and including the row, in the total order."""
    laid = ranges(df, keys, order)
    last = lambda column, w: F.last(column, ignorenulls=True).over(w)
    present = F.when(F.col(value).isNotNull(), F.col("_at"))
    return laid.with_carry(
        last(value, upto(laid.inside)), F.max_by(value, present), lambda w: last("_part", before(w)),
        lambda here, ahead: F.coalesce(here, ahead), name,
    )
