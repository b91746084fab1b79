"""A manifest of a table as a tree of digests, with a proof for every row.

Leaves of a group stand in order and have places 0, 1, 2 ... A level's node lies on the row of its first leaf below it, so
the nodes of one level are ``fanout ** level`` rows apart. On every level lag and lead by that many rows, masked by the
node's slot in its run and the run's length, supply the siblings, and first-child rows hash their parents. The levels of a
block of up to ``BLOCK`` rows need one shuffle; the nodes that stand above the blocks are laid out and worked in the same
way, until a group has one node. The groups' last nodes, in order of the groups, make the last tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartzo.operators.scan import number
from quartzo.session import cut_lineage

#: Rows of a block at most; a block's window is the largest unit that a task holds.
BLOCK = 1024


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts laid end to end."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value's text form in a leaf: ``-`` if null, else its UTF-8 byte count, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*(field(v) for v in values))


def _depth(fanout: int) -> int:
    """Levels that a block of BLOCK rows has room for."""
    depth = 1
    while fanout ** (depth + 1) <= BLOCK:
        depth += 1
    return depth


def _levels(nodes: DataFrame, fanout: int, paths: bool) -> DataFrame:
    """Climb the levels inside blocks. ``nodes``: grp, at, n (nodes of the group), node.

    Adds block and top, on the block's first row the node that stands above the block (else null), and if asked for path:
    of every row its siblings (left, right) on each level that was climbed.
    """
    depth = _depth(fanout)
    rows = nodes.withColumns({"block": F.floor(F.col("at") / fanout**depth), "top": F.col("node"), "many": F.col("n")})
    order = Window.partitionBy("grp", "block").orderBy("at")
    for level in range(depth):
        apart = fanout**level
        place = F.floor(F.col("at") / apart)
        slot = F.pmod(place, F.lit(fanout))
        run = F.least(F.lit(fanout), F.col("many") - (place - slot))
        held, climbs = F.col("top").isNotNull(), F.col("many") > 1
        lefts = [F.when(slot >= j, F.lag("top", j * apart).over(order)) for j in range(fanout - 1, 0, -1)]
        rights = [F.when(slot + j < run, F.lead("top", j * apart).over(order)) for j in range(1, fanout)]
        side = lambda columns: F.concat(*(F.coalesce(c, F.lit("")) for c in columns))
        if paths:
            step = F.struct(side(lefts).alias("left"), side(rights).alias("right"))
            rows = rows.withColumn(f"step{level}", F.when(held & climbs, step))
        parent = F.when(slot == 0, digest(F.col("top"), side(rights)))
        rows = rows.withColumns({"top": F.when(held, F.when(climbs, parent).otherwise(F.col("top"))), "many": F.ceil(F.col("many") / fanout)})
        # a group that is down to one node has climbed all it can: the node stays on the group's first row
    if paths:
        seen = order.rowsBetween(Window.unboundedPreceding, 0)
        steps = [F.last(f"step{level}", ignorenulls=True).over(seen) for level in range(depth)]
        rows = rows.withColumn("path", F.filter(F.array(*steps), lambda s: s.isNotNull())).drop(*(f"step{level}" for level in range(depth)))
    return rows


def climb(leaves: DataFrame, fanout: int = 2) -> list[DataFrame]:
    """``leaves``: grp, at (0, 1, 2 ... in the group), n (leaves of the group), node, and more.

    The stored nodes above the blocks, stage by stage; the last has one row for each group, its root.
    """
    stages, step = [leaves.select("grp", "at", "n", "node")], fanout ** _depth(fanout)
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        above = _levels(stages[-1], fanout, paths=False).where(F.col("at") % step == 0)
        stages.append(cut_lineage(above.select("grp", F.col("block").alias("at"), F.col("many").alias("n"), F.col("top").alias("node"))))
        most = -(-most // step)
    return stages


def descend(leaves: DataFrame, stages: list[DataFrame], over: DataFrame, fanout: int = 2) -> DataFrame:
    """Add path to the leaves: siblings on each level from the leaf up, and then what ``over`` (grp, path, and more, which is
    added too) has for the group's root."""
    more = [c for c in over.columns if c not in ("grp", "path")]
    over = over.select("grp", F.lit(0).alias("block"), F.col("path").alias("rest"), *more)
    for k in range(max(0, len(stages) - 2), -1, -1):
        rows = _levels(stages[k] if k else leaves, fanout, paths=True).join(over, ["grp", "block"])
        rows = rows.withColumn("path", F.concat("path", "rest"))
        over = rows.select("grp", F.col("at").alias("block"), F.col("path").alias("rest"), *more)
    return rows.drop("block", "top", "many", "rest")


def proof(path: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.flatten(F.transform(path, lambda s: F.array(s["left"], s["right"]))), "").cast("binary"), 256)


def refold(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda node, s: digest(s["left"], node, s["right"]))


def manifest(df: DataFrame, values: list[Column], group: str, order: str, fanout: int = 2, keep: list[str] | None = None) -> DataFrame:
    """All rows, with the columns to ``keep`` (all), leaf, subroot (of the row's group), root (of all groups), path and
    proof_sha256.

    ``values`` make up a leaf. Groups are told apart by the text of ``group``, null before all others, and ordered by its
    bytes; leaves ascend by ``order`` (null first), then by their digest, so rows that are equal in all values are
    interchangeable. Null and empty values differ. Texts of any length are digested whole, once; digests and kept columns
    travel. A lone leaf is its group's subroot, a lone subroot the root, both without siblings. An empty table gives an empty
    result. Columns of the same names are replaced. A group of any size is cut into blocks of ``BLOCK`` rows.
    """
    if not 2 <= fanout <= BLOCK:
        raise ValueError(f"a node has 2 to {BLOCK} children")
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in ("leaf", "subroot", "root", "path", "proof_sha256")]
    grp = F.coalesce(F.concat(F.lit("1"), F.col(f"`{group}`").cast("string")), F.lit("0"))
    given = F.struct(*(F.col(f"`{c}`") for c in kept))
    rows = df.select(grp.alias("grp"), F.col(f"`{order}`").alias("by"), leaf(*values).alias("node"), given.alias("given"))
    place = F.col("at") - 1
    leaves = cut_lineage(number(rows, ["grp"], ["by", "node"], "at", of="n").withColumn("at", place))
    stages = climb(leaves, fanout)
    tops = number(stages[-1].select("grp", F.col("node")), [], ["grp"], "at", of="n").withColumn("at", place)
    tops = cut_lineage(tops.select(F.lit("").alias("grp"), "at", "n", "node", F.col("grp").alias("of")))
    above = climb(tops, fanout)
    root = above[-1].first()
    none = tops.select("grp", F.array().cast("array<struct<left:string,right:string>>").alias("path")).limit(1)
    over = descend(tops, above, none, fanout).select(F.col("of").alias("grp"), "path", F.col("node").alias("subroot"))
    out = descend(leaves, stages, over, fanout).withColumn("root", F.lit(root.node if root else None).cast("string"))
    return out.select(*(F.col(f"given.`{c}`").alias(c) for c in kept), F.col("node").alias("leaf"), "subroot", "root", "path", proof(F.col("path")).alias("proof_sha256"))
