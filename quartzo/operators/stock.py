"""Settle sale requests against stock in order.

A request is accepted when its book exists, its quantity is positive and not above the
stock left by the accepted requests before it. A rejected request changes nothing, so a
running total over all requests would be wrong.

The first ``in_task`` requests of every book are settled one after another, all books in parallel. What a book gets beyond
them is settled in rounds of prefix sums that any number of tasks share: with ``s`` left and ``top`` the highest power of
two not above ``s``, every request below ``top`` is accepted until less than ``top`` is left, and at most one request of
``top`` or more can be accepted. A round ends at the first request that leaves less than ``top``, so there are at most as
many rounds as the stock has binary digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartzo.operators.scan import running_sum
from quartzo.session import cut_lineage

#: Requests of one book that a task settles one by one.
IN_TASK = 10_000


def settle(
    requests: DataFrame, stock: DataFrame, key: str, seq: str, qty: str, on_hand: str = "estoque", in_task: int = IN_TASK
) -> DataFrame:
    """Requests with ``motivo`` (NULL when accepted) and ``estoque_antes``.

    ``stock`` has one row per key. ``seq`` numbers the requests of a key (unique, 1, 2, ...).
    """
    known = requests.join(stock.select(key, F.col(on_hand).cast("bigint").alias("_stock")), key, "left")
    named = known.withColumn(
        "_reason",
        F.when(F.col("_stock").isNull(), "livro_inexistente").when(
            F.col(qty).isNull() | (F.col(qty) <= 0), "quantidade_invalida"
        ),
    )
    cols = requests.columns
    refused = named.filter("_reason is not null").select(
        *cols, F.col("_reason").alias("motivo"), F.lit(None).cast("bigint").alias("estoque_antes")
    )
    open_ = named.filter("_reason is null").drop("_reason")
    first = _settle_in_order(open_.filter(F.col(seq) <= in_task), key, seq, qty, cols)
    later = open_.filter(F.col(seq) > in_task)
    if later.isEmpty():
        return refused.unionByName(first)
    first, later = cut_lineage(first), cut_lineage(later)
    sold = accepted(first).groupBy(key).agg(F.sum(qty).cast("bigint").alias("_sold"))
    later = later.join(sold, key, "left").withColumn("_stock", F.col("_stock") - F.coalesce("_sold", F.lit(0))).drop("_sold")
    return reduce(DataFrame.unionByName, [refused, first, _settle_in_rounds(cut_lineage(later), key, seq, qty, cols)])


def _settle_in_order(df: DataFrame, key: str, seq: str, qty: str, cols: list[str]) -> DataFrame:
    schema = T.StructType([df.schema[c] for c in cols] + [T.StructField("motivo", T.StringType()), T.StructField("estoque_antes", T.LongType())])

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        book, left = None, 0
        for batch in batches:
            before = np.empty(len(batch), dtype="int64")
            taken = np.empty(len(batch), dtype=bool)
            triples = zip(batch[key].to_numpy(), batch[qty].to_numpy(), batch["_stock"].to_numpy())
            for i, (k, q, s) in enumerate(triples):
                if k != book:
                    book, left = k, int(s)
                before[i] = left
                taken[i] = q <= left
                if taken[i]:
                    left -= int(q)
            out = batch[cols].copy()
            out["motivo"] = np.where(taken, None, "estoque_insuficiente")
            out["estoque_antes"] = before
            yield out

    return df.repartition(key).sortWithinPartitions(key, seq).mapInPandas(walk, schema)


def _settle_in_rounds(df: DataFrame, key: str, seq: str, qty: str, cols: list[str]) -> DataFrame:
    power = lambda exponent: F.pow(F.lit(2.0), exponent).cast("bigint")
    # One row per book: stock left, last request of the round before.
    state = cut_lineage(df.filter("_stock > 0").groupBy(key).agg(F.max("_stock").alias("_left"), F.lit(0).cast("bigint").alias("_from")))
    rounds = []
    while not state.isEmpty():
        # A request above the stock left can never be accepted any more.
        todo = df.drop("_stock").join(state, key).filter((F.col(seq) > F.col("_from")) & (F.col(qty) <= F.col("_left")))
        largest = todo.groupBy(key).agg(F.max(qty).alias("_largest"))
        # Above the largest request there is nothing to tell apart, so top need not be higher.
        top = F.least(power(F.floor(F.log2("_left"))), power(F.floor(F.log2("_largest")) + 1)).cast("bigint")
        now = cut_lineage(state.join(largest, key, "left").withColumn("_top", top).drop("_largest"))
        sums = _stock_before(todo.drop("_left", "_from").join(now, key), [key], seq, qty)
        rest = F.col("_before") - F.col(qty)
        ends = (rest >= 0) & (rest < F.col("_top"))
        last = cut_lineage(sums.filter(ends).groupBy(key).agg(F.min(seq).alias("_to"), F.min_by(rest, seq).alias("_rest")))
        rounds.append(now.join(last.select(key, "_to"), key, "left"))
        state = last.select(key, F.col("_rest").alias("_left"), F.col("_to").alias("_from")).filter("_left > 0")
        final = last.select(key, F.col("_rest").alias("_left"), F.col("_to").alias("_from")).filter("_left = 0")
        rounds.append(final.select(key, "_left", "_from", F.lit(1).cast("bigint").alias("_top"), F.lit(None).cast("bigint").alias("_to")))
    # Every request falls into the round whose span holds it; there are few rounds per book. A book that came here without
    # stock has one, without end.
    sold_out = df.filter("_stock <= 0").groupBy(key).agg(F.max("_stock").alias("_left"), F.lit(0).cast("bigint").alias("_from"))
    rounds.append(sold_out.select(key, "_left", "_from", F.lit(1).cast("bigint").alias("_top"), F.lit(None).cast("bigint").alias("_to")))
    spans = cut_lineage(reduce(DataFrame.unionByName, rounds))
    of_round = (F.col(seq) > F.col("_from")) & (F.col("_to").isNull() | (F.col(seq) <= F.col("_to")))
    placed = df.drop("_stock").join(spans, key).filter(of_round)
    decided = _stock_before(placed, [key, "_from"], seq, qty)
    return decided.select(
        *cols,
        F.when(F.col("_before") < F.col(qty), "estoque_insuficiente").alias("motivo"),
        F.col("_before").alias("estoque_antes"),
    )


def _stock_before(df: DataFrame, keys: list[str], seq: str, qty: str) -> DataFrame:
    """Stock each request meets, as long as its round lasts: left less the smaller requests before it."""
    small = F.when(F.col(qty) < F.col("_top"), F.col(qty)).otherwise(0).cast("bigint")
    sums = running_sum(df.withColumn("_small", small), keys, [seq], "_small", "_sum")
    return sums.withColumn("_before", F.col("_left") - F.col("_sum") + F.col("_small")).drop("_sum", "_small")


def accepted(decided: DataFrame) -> DataFrame:
    return decided.filter("motivo is null").drop("motivo")


def stock_after(stock: DataFrame, decided: DataFrame, key: str, qty: str, on_hand: str = "estoque") -> DataFrame:
    """Stock less what accepted requests took."""
    sold = accepted(decided).groupBy(key).agg(F.sum(qty).cast("bigint").alias("_sold"))
    left = (F.col(on_hand) - F.coalesce("_sold", F.lit(0))).cast("bigint")
    return stock.join(sold, key, "left").withColumn(on_hand, left).drop("_sold")
