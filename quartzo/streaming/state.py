"""Keyed state that a stream carries from batch to batch in Spark's state store.

Spark shuffles a batch by key to where the key's state lies, so a batch reads its own rows and the state of its own keys,
however long the history is. State and output of a batch commit together: a repeated batch starts from the same state.

Counts by key are kept by Spark's own aggregation, without Python. What an aggregation can't say is left to a processor:
Python is called once for a bucket of keys, not for every key; inside it each key has an entry of its own in a state map.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import LongType, StringType, StructField, StructType

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Buckets of keys; a checkpoint holds on to them.
BUCKETS, BUCKET = 1024, "bucket"


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int").alias(BUCKET)


def _entry(df: DataFrame, key: str) -> StructType:
    """Schema of a map's keys."""
    return StructType([StructField("k", df.schema[key].dataType)])


def _plain(df: DataFrame) -> dict[str, str]:
    """Rows reach a processor as tuples, which rename columns that begin with an underscore: plain names go in."""
    return {c: f"c{i}" for i, c in enumerate(df.columns)}


def _stateful(df: DataFrame) -> DataFrame:
    """State of several columns needs the store on disk; it is a setting of the session that runs the stream."""
    df.sparkSession.conf.set(PROVIDER, ROCKSDB)
    return df


def counted(stream: DataFrame, key: str, name: str) -> DataFrame:
    """The stream's rows, ``name`` NULL in them, and a row for each key of the batch that has had more than one row by now:
    ``name`` is their number, this batch's included, and all columns but the key are NULL.

    For update mode. :func:`earlier` goes on from a stored batch.
    """
    so_far = _stateful(stream).groupBy(key).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)
    return stream.withColumn(name, F.lit(None).cast("bigint")).unionByName(so_far, allowMissingColumns=True)


def earlier(batch: DataFrame, key: str, name: str) -> DataFrame:
    """The rows of a stored batch of :func:`counted`; ``name`` is the number of rows that earlier batches had with their key.

    Only keys that earlier batches had meet the rows.
    """
    rows = batch.filter(F.col(name).isNull()).drop(name)
    here = rows.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_here"))
    so_far = batch.filter(F.col(name).isNotNull()).select(F.col(key).alias("_again"), F.col(name).alias("_so_far"))
    before = so_far.join(here, F.col("_again").eqNullSafe(F.col("_key"))).filter("_so_far > _here")
    before = before.select("_again", (F.col("_so_far") - F.col("_here")).alias("_before"))
    found = rows.join(before, F.col(key).eqNullSafe(F.col("_again")), "left")
    return found.select(*rows.columns, F.coalesce("_before", F.lit(0)).cast("bigint").alias(name))


def with_earlier(stream: DataFrame, key: str, name: str, keep_ms: int | None = None) -> DataFrame:
    """Add the number of rows that earlier batches had with the row's key.

    For keys that are forgotten; else :func:`counted` gives the same numbers without Python. Rows are passed on one by one, so a key with many copies in a batch needs no more memory; a task holds the keys of one
    bucket of the batch. ``keep_ms``: after this time without a row the key is forgotten.
    """
    plain = _plain(stream)
    named = _stateful(stream).withColumnsRenamed(plain)
    entry, mine = _entry(named, plain[key]), named.columns.index(plain[key])
    schema = StructType([*named.schema.fields, StructField("before", LongType())])
    made = Row(*schema.names)

    class Seen(StatefulProcessor):
        def init(self, handle):
            self.count = handle.getMapState("n", entry, "n long", keep_ms)

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
            before, now = {}, {}
            for row in rows:
                k = row[mine]
                if k not in before:
                    found = self.count.getValue((k,))
                    before[k], now[k] = found[0] if found else 0, 0
                now[k] += 1
                yield made(*row[: len(plain)], before[k])
            for k, n in now.items():
                self.count.updateValue((k,), (before[k] + n,))

        def close(self):
            pass

    dealt = named.select("*", _bucket(plain[key]))
    found = dealt.groupBy(BUCKET).transformWithState(Seen(), schema, "append", "processingTime" if keep_ms else "none")
    return found.select(*(F.col(p).alias(c) for c, p in plain.items()), F.col("before").alias(name))


def settled(stream: DataFrame, stock: DataFrame, key: str, seq: str, qty: str, on_hand: str = "estoque") -> DataFrame:
    """Requests with ``motivo`` (NULL when accepted) and ``estoque_antes``, by the stock that earlier batches left.

    ``stock``: one row per key, read once, before the first batch. Requests of a batch are settled in order of ``seq``; a
    task holds those of one bucket of keys at a time.
    """
    plain = _plain(stream)
    named = _stateful(stream).withColumnsRenamed(plain)
    entry = _entry(named, plain[key])
    mine, turn, amount = (named.columns.index(plain[c]) for c in (key, seq, qty))
    schema = StructType([*named.schema.fields, StructField("motivo", StringType()), StructField("estoque_antes", LongType())])
    made = Row(*schema.names)

    class Shelf(StatefulProcessor):
        def init(self, handle):
            self.left = handle.getMapState("left", entry, "n long")

        def handleInitialState(self, key, initialState, timerValues):
            self.left.updateValue((initialState["k"],), (initialState["stock"],))

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
            asked = sorted((tuple(r[: len(plain)]) for r in rows), key=lambda r: (r[turn] is None, r[turn] or 0))
            start, left = {}, {}
            for r in asked:
                k, q = r[mine], r[amount]
                if k not in left:
                    found = self.left.getValue((k,))
                    start[k] = left[k] = found[0] if found else None
                before = left[k]
                if before is None:
                    yield made(*r, "livro_inexistente", None)
                elif q is None or not q > 0:
                    yield made(*r, "quantidade_invalida", None)
                else:
                    yield made(*r, None if q <= before else "estoque_insuficiente", before)
                    left[k] -= int(q) if q <= before else 0
            for k, n in left.items():
                if n != start[k]:
                    self.left.updateValue((k,), (n,))

        def close(self):
            pass

    kind = entry.fields[0].dataType
    start = stock.select(F.col(key).cast(kind).alias("k"), F.col(on_hand).cast("bigint").alias("stock")).filter("stock is not null")
    begun = start.select("*", _bucket("k")).groupBy(BUCKET)
    found = named.select("*", _bucket(plain[key])).groupBy(BUCKET).transformWithState(Shelf(), schema, "append", "none", begun)
    return found.select(*(F.col(p).alias(c) for c, p in plain.items()), "motivo", "estoque_antes")
