"""A trie of the prefixes that conversations share, without building one.

Distinct conversations are sorted by their turns' digests, and each row learns the length of the common prefix with the row
before it (lcp). A prefix of length d that is new at row s is a node; its conversations are the rows from s to the last one
before an lcp under d. Every candidate prefix finds its extents on its own: a sparse table of range minima over the lcps is
searched by halving steps, to the right for the node's last row and to the left for the first row of the prefix at which
the row branches off, its parent. Sums over intervals and subtrees are differences of running sums, as rows in order are
the nodes in preorder; the smallest member is a range minimum.

Tables are cut into blocks of ``BLOCK`` rows, each with a sparse table of its own; what leaves a block goes on in the table
of the blocks' minima, in the same way, so no task holds more than a block and its candidates.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartzo.operators.scan import number
from quartzo.session import cut_lineage

#: Rows of a block; conversations of one text whose ids are joined at once before they are digested.
BLOCK, CHUNK = 1024, 4096


def sparse_table(v: np.ndarray) -> list[np.ndarray]:
    """At [k][i] the minimum of v[i : i + 2 ** k]."""
    table = [v]
    while 2 ** len(table) <= len(v):
        half = 2 ** (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    return table


def first_below(v: np.ndarray, at: np.ndarray, d: np.ndarray) -> np.ndarray:
    """For each query the smallest i from ``at`` with v[i] < d, or len(v)."""
    i = at.copy()
    for k, least in reversed(list(enumerate(sparse_table(v)))):
        fits = i + 2**k <= len(v)
        i += np.where(fits & (least[np.minimum(i, len(least) - 1)] >= d), 2**k, 0)
    return i


def range_min(v: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Minimum of v[first : last + 1], of two overlapping stretches."""
    table, out = sparse_table(v), np.empty(len(first), v.dtype)
    power = np.int64(np.log2(last - first + 1) + 1e-9)
    for k in np.unique(power):
        is_k = power == k
        out[is_k] = np.minimum(table[k][first[is_k]], table[k][last[is_k] - 2**k + 1])
    return out


def _block(at: str | Column) -> Column:
    return F.floor((F.col(at) if isinstance(at, str) else at) / BLOCK)


def _per_block(table: DataFrame, queries: DataFrame, solve, schema: str) -> DataFrame:
    """solve(values of the block in order, its first place, queries) for every block; table: at, v; queries: block and more."""

    def run(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(asked):
            return asked.iloc[:0].assign(found=[])
        rows = rows.sort_values("at")
        return asked.assign(found=solve(rows["v"].to_numpy(), int(rows["at"].iloc[0]), asked))

    rows = table.select(_block("at").alias("block"), "at", "v").groupBy("block")
    return cut_lineage(rows.cogroup(queries.groupBy("block")).applyInPandas(run, schema))


def _minima(table: DataFrame) -> DataFrame:
    return cut_lineage(table.groupBy(_block("at").alias("block")).agg(F.min("v").alias("v")).select(F.col("block").alias("at"), "v"))


def search(table: DataFrame, size: int, queries: DataFrame) -> DataFrame:
    """at, d and found: the smallest place from ``at`` with v < d, else ``size``.

    ``table``: at (0 to size - 1), v. ``queries``: at (to size), d; distinct.
    """

    def local(asked: DataFrame) -> DataFrame:
        def solve(v: np.ndarray, first: int, q: pd.DataFrame) -> np.ndarray:
            return first + first_below(v, q["at"].to_numpy() - first, q["d"].to_numpy())

        return _per_block(table, asked.select(_block("at").alias("block"), "at", "d"), solve, "block long, at long, d long, found long")

    beyond = queries.where(F.col("at") >= size).select("at", "d", F.lit(size).cast("long").alias("found"))
    here = local(queries.where(F.col("at") < size))
    blocks = -(-size // BLOCK)
    inside = F.col("found") < F.least((F.col("block") + 1) * BLOCK, F.lit(size))
    if blocks <= 1:
        return here.select("at", "d", "found").union(beyond)
    # all that leave a block with the same d go the same way
    open_ = here.where(~inside).select("at", "d", (F.col("block") + 1).alias("next"))
    over = search(_minima(table), blocks, open_.select(F.col("next").alias("at"), "d").distinct())
    over = cut_lineage(over.select(F.col("at").alias("next"), "d", F.col("found").alias("target")))
    last = local(over.where(F.col("target") < blocks).select((F.col("target") * BLOCK).alias("at"), "d").distinct())
    ends = last.select(F.col("block").alias("target"), "d", "found")
    far = open_.join(over.join(ends, ["target", "d"], "left"), ["next", "d"])
    far = far.select("at", "d", F.coalesce("found", F.lit(size)).alias("found"))
    return here.where(inside).select("at", "d", "found").union(far).union(beyond)


def least(table: DataFrame, size: int, queries: DataFrame) -> DataFrame:
    """first, last and found: the minimum of v over the places from first to last. ``queries``: first, last; distinct."""
    asked = queries.withColumns({"block": _block("first"), "end": _block("last")})

    def solve(v: np.ndarray, start: int, q: pd.DataFrame) -> np.ndarray:
        return range_min(v, q["first"].to_numpy() - start, q["last"].to_numpy() - start)

    near = asked.where("block = end").select("block", "first", "last")
    near = _per_block(table, near, solve, "block long, first long, last long, found long").select("first", "last", "found")
    if size <= BLOCK:
        return near
    order = Window.partitionBy(_block("at"))
    sides = table.select(
        "at", F.min("v").over(order.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)).alias("head"),
        F.min("v").over(order.orderBy("at").rowsBetween(0, Window.unboundedFollowing)).alias("tail"),
    )
    sides = cut_lineage(sides)
    wide = asked.where("block < end").withColumns({"from": F.col("block") + 1, "to": F.col("end") - 1})
    mid = least(_minima(table), -(-size // BLOCK), wide.where("from <= to").select(F.col("from").alias("first"), F.col("to").alias("last")).distinct())
    wide = wide.join(sides.select(F.col("at").alias("first"), "tail"), "first").join(sides.select(F.col("at").alias("last"), "head"), "last")
    wide = wide.join(mid.select(F.col("first").alias("from"), F.col("last").alias("to"), F.col("found").alias("mid")), ["from", "to"], "left")
    return near.union(wide.select("first", "last", F.least("tail", "head", "mid")))


def running(rows: DataFrame, size: int, names: list[str]) -> DataFrame:
    """at, and for each name the sum up to and including the place; ``rows``: at (0 to size - 1) and the names."""
    order = Window.partitionBy(_block("at")).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.select("at", *(F.sum(n).over(order).alias(n) for n in names))
    if size <= BLOCK:
        return inside
    sums = rows.groupBy(_block("at").alias("block")).agg(*(F.sum(n).alias(n) for n in names)).withColumnRenamed("block", "at")
    ahead = running(sums, -(-size // BLOCK), names).select((F.col("at") + 1).alias("block"), *(F.col(n).alias(f"{n}_ahead") for n in names))
    both = inside.withColumn("block", _block("at")).join(ahead, "block", "left")
    return both.select("at", *((F.col(n) + F.coalesce(f"{n}_ahead", F.lit(0))).alias(n) for n in names))


def _ends(members: DataFrame) -> DataFrame:
    """sid and ends_sha256 of its conversations' ids in order. A digest is sequential: ids are joined in parallel, by chunk,
    and one task reads a text's chunks one after the other."""
    placed = number(members, ["sid"], ["conv"], "k").groupBy("sid", F.floor((F.col("k") - 1) / CHUNK).alias("chunk"))
    chunks = placed.agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sid, state = None, hashlib.sha256()
        for batch in batches:
            done = []
            for s, ids in zip(batch["sid"], batch["ids"]):
                if s != sid:
                    done += [(sid, state.hexdigest())] * (sid is not None)
                    sid, state = s, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield pd.DataFrame(done, columns=["sid", "ends_sha256"], dtype=object)
        if sid is not None:
            yield pd.DataFrame([(sid, state.hexdigest())], columns=["sid", "ends_sha256"])

    return chunks.repartition("sid").sortWithinPartitions("sid", "chunk").select("sid", "ids").mapInPandas(run, "sid string, ends_sha256 string")


def step_digest(role: Column, text: Column) -> Column:
    """Hex SHA-256 of a turn; null role or text is empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)


def _sorted_rows(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, int]:
    """The distinct conversations in order: at, lcp, next (lcp of the following row), len, conv (smallest), n, words, ends."""
    told = turns.select("conv", F.struct("by", "step", "words").alias("turn")).union(convs.select("conv", F.lit(None)))
    each = told.where("conv is not null").groupBy("conv").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    each = each.select("conv", F.col("turns.step").alias("key"), F.col("turns.words").alias("words"))
    each = cut_lineage(each.withColumn("sid", F.sha2(F.array_join("key", "").cast("binary"), 256)))
    texts = each.groupBy("sid").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n"), F.first("key").alias("key"), F.first("words").alias("words"))
    texts = number(texts.join(_ends(each.select("sid", "conv")), "sid").drop("sid"), [], ["key"], "at").withColumn("at", F.col("at") - 1)
    # rows at the ends of a block are shown to its neighbour as well
    block = _block("at")
    shown = F.array(block, F.when(F.col("at") % BLOCK == BLOCK - 1, block + 1), F.when(F.col("at") % BLOCK == 0, block - 1))
    order = Window.partitionBy("block").orderBy("at")
    near = texts.withColumn("block", F.explode(F.array_compact(shown)))

    def common(other: Column) -> Column:
        differs = F.array_position(F.zip_with("key", other, lambda a, b: a.eqNullSafe(b)), F.lit(False))
        return F.when(other.isNull(), F.lit(-1)).when(differs == 0, F.size("key")).otherwise(differs - 1).cast("long")

    near = near.withColumns({"lcp": common(F.lag("key").over(order)), "next": common(F.lead("key").over(order))})
    rows = near.where(F.col("block") == block).select("at", "lcp", "next", F.size("key").cast("long").alias("len"), "conv", "n", "words", "ends_sha256")
    rows = cut_lineage(rows)
    return rows, rows.count()


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row for each distinct sequence of a conversation's first turns, the empty one included.

    ``turns``: conv (long), by (their order; distinct within a conversation), step (hex digest of what makes turns equal) and
    words. ``convs``: conv, one row for each conversation; one without turns ends at the root. Result, all long but the
    digest: conv_id (smallest member), depth, parent_conv_id (the parent's conv_id; root: null), n_convs, n_children,
    n_leaves (childless nodes of the subtree, itself included), saved_tokens (over the subtree, words of each node's last turn
    times its conversations but one), ends_sha256 (of the members that have no further turn: ids in order, comma-joined).
    Turns that tie in ``by`` are ordered by step; rows without a conversation are left out, other columns ignored, a
    conversation may be named in either frame and repeatedly in ``convs``. Copies of a conversation are one row with a count.
    No conversation gives no node. The digests of the longest
    conversation bound what a row holds.
    """
    rows, size = _sorted_rows(turns, convs)
    lcps = rows.select("at", F.col("lcp").alias("v"))
    # candidate prefixes that are new at their row, and those at which it branches off
    own = rows.select("at", F.explode(F.sequence(F.col("lcp") + 1, F.col("len"))).alias("depth"), "lcp", "next", "len", "conv", "n", "words", "ends_sha256")
    wide = own.where("depth <= next").select((F.col("at") + 1).alias("at"), F.col("depth").alias("d"))
    right = search(lcps, size, wide).select((F.col("at") - 1).alias("at"), F.col("d").alias("depth"), (F.col("found") - 1).alias("end"))
    mirrored = lcps.select((size - 1 - F.col("at")).alias("at"), "v")
    left = search(mirrored, size, rows.where("at > 0").select((size - F.col("at")).alias("at"), F.col("lcp").alias("d")))
    # found on the mirrored places is the row before an lcp under d, counted from there: the prefix's first row
    links = cut_lineage(left.select((size - F.col("at")).alias("at"), (size - 1 - F.col("found")).alias("parent"), F.col("d").alias("parent_depth")))

    sums = rows.select("at", "n", F.when(F.col("next") < F.col("len"), 1).otherwise(0).alias("leaf"))
    upto = cut_lineage(running(sums, size, ["n", "leaf"]))
    nodes = own.join(right, ["at", "depth"], "left").withColumn("end", F.coalesce("end", "at"))
    nodes = nodes.join(upto.select(F.col("at").alias("end"), F.col("n").alias("n_end"), F.col("leaf").alias("leaf_end")), "end")
    nodes = nodes.join(upto.select("at", F.col("n").alias("n_at"), F.col("leaf").alias("leaf_at")), "at")
    here = F.when(F.col("next") < F.col("len"), 1).otherwise(0)
    nodes = nodes.select(
        "at", "depth", "end", "lcp", "len", "conv", (F.col("n_end") - F.col("n_at") + F.col("n")).alias("n_convs"), (F.col("leaf_end") - F.col("leaf_at") + here).alias("n_leaves"),
        F.when(F.col("depth") > 0, F.try_element_at("words", F.col("depth").cast("int"))).otherwise(0).alias("word"),
        F.when(F.col("depth") == F.col("len"), F.col("ends_sha256")).otherwise(F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
    below = Window.partitionBy("at").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    nodes = cut_lineage(nodes.withColumn("saved", F.sum((F.col("n_convs") - 1) * F.col("word")).over(below)))

    whole = nodes.groupBy("at").agg(F.max("saved").alias("saved"))  # the row's first node has the whole row's
    upto = cut_lineage(running(whole, size, ["saved"]))
    smallest = least(rows.select("at", F.col("conv").alias("v")), size, nodes.where("end > at").select(F.col("at").alias("first"), F.col("end").alias("last")).distinct())
    branches = links.groupBy(F.col("parent").alias("at"), F.col("parent_depth").alias("depth")).agg(F.count(F.lit(1)).alias("branches"))
    out = nodes.join(upto.select("at", F.col("saved").alias("saved_at")), "at").join(upto.select(F.col("at").alias("end"), F.col("saved").alias("saved_end")), "end")
    out = out.join(smallest.select(F.col("first").alias("at"), F.col("last").alias("end"), "found"), ["at", "end"], "left").join(branches, ["at", "depth"], "left")
    out = out.join(links.select("at", "parent", "parent_depth"), "at", "left")
    branch = F.col("depth") == F.col("lcp") + 1  # hangs on another row's node
    out = out.select(
        F.coalesce("found", "conv").alias("conv_id"), "depth", "n_convs", (F.coalesce("branches", F.lit(0)) + F.when(F.col("depth") < F.col("len"), 1).otherwise(0)).alias("n_children"),
        F.col("n_leaves").cast("long").alias("n_leaves"), (F.col("saved") + F.col("saved_end") - F.col("saved_at")).cast("long").alias("saved_tokens"), "ends_sha256", "at",
        F.when(branch, F.col("parent")).otherwise(F.col("at")).alias("parent_at"), (F.col("depth") - 1).alias("parent_depth"),
    )
    out = cut_lineage(out)
    parents = out.where("n_children > 0").select(F.col("at").alias("parent_at"), F.col("depth").alias("parent_depth"), F.col("conv_id").alias("parent_conv_id"))
    out = out.join(parents, ["parent_at", "parent_depth"], "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", F.col("n_children").cast("long").alias("n_children"), "n_leaves", "saved_tokens", "ends_sha256")
