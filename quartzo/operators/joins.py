"""Joins with guarantees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartzo.functions.columns import fold_spelling


def size_checked_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join that broadcasts the right side if its bytes pass the session's threshold, and else shuffles.

    No hint and no count: Spark checks the size it knows while planning, and again, by adaptive execution, the size it has
    measured; skewed partitions of a shuffled join are split.
    """
    return left.join(right, on, how)


def reference_join(left: DataFrame, right: DataFrame, key: str, other: str, spread: str) -> DataFrame:
    """Left join of rows to the one row that ``key`` refers to, on ``other``; a missing key refers to nothing.

    Rows without a key would all be shuffled to one task. They travel by the hash of ``spread`` instead, and can't match.
    """
    kind = right.schema[other].dataType
    place = F.coalesce(F.col(key).cast(kind), F.xxhash64(spread).cast(kind))
    return left.join(right, (place == F.col(other)) & F.col(key).isNotNull(), "left")


def salted_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left", salts: int = 16) -> DataFrame:
    """Join that splits every key of a large left side into ``salts`` parts, dealt by the rows' other columns.

    The right side comes ``salts`` times, so it is for a right side that is much smaller than the left. Rows of a key that
    are equal in all columns stay together; rows without a key are spread and match nothing.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    dealt = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salts)))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    return dealt.join(copies, [*on, "_salt"], how).drop("_salt")


def _single(df: DataFrame, on: list[str], side: str) -> DataFrame:
    """One row per key; the job fails as soon as a key has two.

    The grouping shuffles on the join key, which the join that follows uses again.
    """
    values = [c for c in df.columns if c not in on]
    packed = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"), F.max(F.struct(F.lit(1).alias("_"), *values)).alias("_row"))
    guard = F.when(
        F.col("_n") > 1, F.raise_error(F.concat(F.lit(f"repeated key on the {side} side: "), F.to_json(F.struct(*on)))).cast("bigint")
    ).otherwise(F.col("_n"))
    return packed.select(*on, guard.alias(f"_once_{side}"), *[F.col("_row")[v].alias(v) for v in values])


def join_validated(left: DataFrame, right: DataFrame, on: list[str], how: str = "left", validate: str = "1:1") -> DataFrame:
    """Join that fails when a side declared as unique repeats its key.

    ``validate`` is one of ``1:1``, ``1:m`` (left unique) and ``m:1`` (right unique).
    """
    if validate not in ("1:1", "1:m", "m:1"):
        raise ValueError(f"unknown validation {validate!r}")
    first, second = validate.split(":")
    guards = []
    if first == "1":
        left, guards = _single(left, on, "left"), ["_once_left"]
    if second == "1":
        right, guards = _single(right, on, "right"), [*guards, "_once_right"]
    joined = left.join(right, on, how)
    # The guards stay in use after the join: otherwise a query that reads no column of a
    # side would have that side, and its check, optimised away.
    for guard in guards:
        joined = joined.filter(F.coalesce(guard, F.lit(1)) == 1)
    return joined.drop(*guards)


def domain_join(df: DataFrame, received: str, values: list[str], name: str) -> DataFrame:
    """Official spelling of ``received`` from a fixed list; NULL without a match.

    The list is a literal of the plan, so the lookup is a map access inside the scan's
    stage and needs no join at all.
    """
    entries = []
    for value in values:
        entries += [F.lower(F.lit(value)), F.lit(value)]
    return df.withColumn(name, F.try_element_at(F.create_map(*entries), fold_spelling(received)))


def domain_table_join(df: DataFrame, received: str, domain: DataFrame, domain_col: str, name: str) -> DataFrame:
    """The same lookup against a domain table."""
    table = domain.select(F.lower(domain_col).alias("_fold"), F.col(domain_col).alias(name))
    return df.join(table, fold_spelling(received) == F.col("_fold"), "left").drop("_fold")


def rows_added_by_join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Rows of the left side, rows after the left join, and the difference.

    Works on counts per key, so the multiplied rows are never produced.
    """
    l = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_l"))
    r = right.groupBy(*on).agg(F.count(F.lit(1)).alias("_r"))
    joined = l.join(r, on, "left")
    return joined.agg(
        F.coalesce(F.sum("_l"), F.lit(0)).alias("linhas_antes"),
        F.coalesce(F.sum(F.col("_l") * F.coalesce("_r", F.lit(1))), F.lit(0)).alias("linhas_depois"),
    ).withColumn("linhas_a_mais", F.col("linhas_depois") - F.col("linhas_antes"))


def nested(
    parent: DataFrame, child: DataFrame, on: list[str], order: list[str], fields: list[str], name: str, most: int | None = 1000
) -> DataFrame:
    """One row per parent with its children as a sorted list; NULL without a child.

    ``most`` is the caller's bound on the children of a parent: one with more fails the job. Only the first ``most`` + 1
    children leave a map task, so no task ever holds a longer list. None: no bound, a parent's list is one row whatever its
    length. Remaining columns break ties of ``order``. Children without a key belong to no parent.
    """
    rest = [c for c in child.columns if c not in on and c not in order]
    child = child.dropna(subset=on)
    if most is None:
        held = F.sort_array(F.collect_list(F.struct(*order, *rest)))
        lists = child.groupBy(*on).agg(held.alias("_list"))
        return parent.join(lists.select(*on, _only("_list", fields).alias(name)), on, "left")
    over = Window.partitionBy(*on).orderBy(*[F.col(c).asc_nulls_first() for c in order + rest])
    placed = child.withColumn("_position", F.row_number().over(over)).filter(F.col("_position") <= int(most) + 1)
    lists = placed.groupBy(*on).agg(F.sort_array(F.collect_list(F.struct("_position", *fields))).alias("_list"))
    too_long = F.raise_error(F.concat(F.lit(f"more than {int(most)} children: "), F.to_json(F.struct(*on))))
    shaped = _only("_list", fields)
    guarded = F.when(F.size("_list") > int(most), too_long.cast(lists.select(shaped).schema[0].dataType)).otherwise(shaped)
    return parent.join(lists.select(*on, guarded.alias(name)), on, "left")


def _only(held: str, fields: list[str]) -> Column:
    return F.transform(held, lambda x: F.struct(*[x[f].alias(f) for f in fields]))
