"""Upserts, deletes, change capture and dimension history on plain Parquet tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quartzo.functions.domains import FAR_FUTURE
from quartzo.operators.keys import latest_version, surrogate_key
from quartzo.operators.scan import last_known, neighbour
from quartzo.session import cut_lineage


def upsert(base: DataFrame, changes: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Insert or replace by key; of several changes the one with the highest ``seq`` counts.

    A change older than the base row is ignored; a missing ``seq`` is older than any other, and of equal ones the change
    counts. Keys compare null-safe, so each key comes out once. The base is only filtered, never sorted:
    with few changes Spark broadcasts them and leaves the base where it is.
    """
    newest = latest_version(changes.select(*base.columns), keys, [seq])
    incoming = newest.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(seq).alias("_seq"))
    current = base.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col(seq).alias("_seq"))
    kept = base.join(incoming, _match(base, incoming, keys) & ~_newer(base[seq], incoming["_seq"]), "left_anti")
    applied = newest.join(current, _match(newest, current, keys) & _newer(current["_seq"], newest[seq]), "left_anti")
    return kept.unionByName(applied)


def upsert_folders(
    spark: SparkSession, path: str, changes: DataFrame, keys: list[str], seq: str, folder: str, place: Column, touch: dict[str, Column] | None = None
) -> list:
    """Upsert into a stored table that lies in folders by ``place``, an expression of the keys; returns the folders written.

    Only folders that hold a changed key are read and replaced; the others keep their files. ``touch`` sets columns of all
    rows of the folders that were rewritten. There are as few folders as the table has, so their names may be listed.
    """
    came = cut_lineage(changes.withColumn(folder, place))
    hit = [r[0] for r in came.select(folder).distinct().collect()]
    if not hit:
        return []
    stored = spark.read.parquet(path)
    base = stored.filter(F.col(folder).isin(hit))
    now = upsert(base, came.select(*stored.columns), keys, seq).withColumns(touch or {})
    now = cut_lineage(now)  # the folders that are read are about to be replaced
    now.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(folder).parquet(path)
    return sorted(hit)


def _match(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_k_{k}"]) for k in keys])


def _newer(one: Column, other: Column) -> Column:
    """Whether ``one`` is later than ``other``; a missing value is earlier than any other. Never null."""
    return one.isNotNull() & (other.isNull() | (one > other))


def delete_keys(base: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return base.join(gone.select(*keys), keys, "left_anti")


def apply_cdc(
    base: DataFrame, changes: DataFrame, keys: list[str], seq: str, op: str, delete_code: str = "D"
) -> DataFrame:
    """Apply inserts, updates and deletes; the last change of a key by ``seq`` decides."""
    last = latest_version(changes, keys, [seq])
    untouched = base.join(last.select(*keys), keys, "left_anti")
    return untouched.unionByName(last.filter(F.col(op) != delete_code).select(*base.columns))


def scd1(df: DataFrame, keys: list[str], newest: list[str]) -> DataFrame:
    """Overwrite history: the latest version per key."""
    return latest_version(df, keys, newest)


def scd2(
    changes: DataFrame,
    key: str,
    attrs: list[str],
    day: str,
    surrogate: str | None = None,
) -> DataFrame:
    """One row per span in which the attributes stayed the same.

    ``changes`` holds at most one row per key and day. A span ends where the next begins;
    the open one ends on 9999-12-31 and is marked ``atual``.
    """
    seen = neighbour(changes.select(key, day, *attrs), [key], [day], [F.lit(True).alias("seen"), *attrs], "_before")
    same = reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col("_before")[a]) for a in attrs])
    starts = seen.filter(F.col("_before").isNull() | ~same).drop("_before")
    spans = neighbour(starts, [key], [day], [day], "_next", following=True)
    out = spans.select(
        key,
        *attrs,
        F.col(day).alias("valido_de"),
        F.coalesce(F.col("_next")[day], F.lit(FAR_FUTURE).cast("date")).alias("valido_ate"),
        F.col("_next").isNull().alias("atual"),
    )
    if surrogate is None:
        return out
    # Versions get keys after all natural keys exist: number (natural, start) pairs.
    ranked = out.withColumn("_pair", F.col(key) * 100_000 + F.datediff("valido_de", F.lit("1900-01-01").cast("date")))
    return surrogate_key(ranked, "_pair", surrogate).drop("_pair")


def asof_dim(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    day: str,
    attrs: list[str],
) -> DataFrame:
    """The dimension version valid on the fact's day; NULL attributes when there is none.

    Versions and facts of a key are put in one order and the last version is carried
    forward, so the work is linear: facts never meet all versions of their key.
    """
    row = F.struct(*fact.columns)
    version = F.struct("valido_ate", *attrs)
    kind = "struct<" + ",".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in fact.schema) + ">"
    shape = dim.select(version.alias("v")).schema["v"].dataType
    facts = fact.select(F.col(key).alias("_of"), F.col(day).alias("_day"), F.lit(1).alias("_kind"), row.alias("_fact"), F.lit(None).cast(shape).alias("_version"))
    versions = dim.select(
        F.col(key).alias("_of"), F.col("valido_de").alias("_day"), F.lit(0).alias("_kind"), F.lit(None).cast(kind).alias("_fact"), version.alias("_version")
    )
    merged = last_known(facts.unionByName(versions), ["_of"], ["_day", "_kind"], "_version", "_valid")
    valid = F.col("_valid")
    inside = F.col("_day") < valid["valido_ate"]
    return merged.filter("_kind = 1").select("_fact.*", *[F.when(inside, valid[a]).alias(a) for a in attrs])
