"""Chat formatting over reply trees.

A message names the message it replies to. Self-joins that double their reach each round bring every message its root and
depth and build jumps of 1, 2, 4 ... replies; leaves are ranked by the score of their whole branch, and the jumps give the
messages on each chosen branch. Each branch becomes one text with marks around its turns and a mask of what to learn.

Format of a turn: ``### role: text</turn>`` and a line feed. In roles and texts ``\\`` becomes ``\\\\``, ``#`` becomes ``\\h``, ``<`` becomes ``\\l``,
and in roles ``:`` becomes ``\\c``, so no mark can occur inside and ``turns`` reads back exactly what was written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartzo.llm.common import stored

OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"


def escape(text: Column) -> Column:
    for plain, mark in (("\\", "\\\\"), ("#", "\\h"), ("<", "\\l"), (":", "\\c")):
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def unescape(text: Column) -> Column:
    def part(x: Column) -> Column:
        for plain, mark in (("#", "\\h"), ("<", "\\l"), (":", "\\c")):
            x = F.replace(x, F.lit(mark), F.lit(plain))
        return x

    return F.array_join(F.transform(F.split(text, r"\\\\"), part), "\\")


def _ways(messages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, list[DataFrame]]:
    """All messages (stored), those that reach a root, with the score of their way, those that don't, and jumps of 2^k replies."""
    known = messages.select(F.col("msg").alias("up"))
    nodes = messages.join(known, messages["parent"] == known["up"], "left").select("tree", "msg", "up", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    first = stored(nodes)
    most = first.count().bit_length() + 1  # no way is longer than there are messages
    # up: 2^k replies up; score: on the way
    settled, live, levels = first.where("up is null"), first.where("up is not null"), []
    while len(levels) < most and not live.isEmpty():
        levels.append(live)
        far = settled.union(live).select(F.col("msg").alias("m"), F.col("up").alias("far"), F.col("score").alias("more"))
        now = live.join(far, F.col("up") == F.col("m"))
        now = stored(now.select("tree", "msg", F.col("far").alias("up"), (F.col("score") + F.col("more")).alias("score")))
        settled, live = settled.union(now.where("up is null")), now.where("up is not null")
    return first, settled, live, levels


def unrooted(messages: DataFrame) -> DataFrame:
    """tree and msg of the messages that lead to no root: those in a circle, and all replies to them."""
    return _ways(messages)[2].select("tree", "msg")


def branches(messages: DataFrame, best: int = 1) -> DataFrame:
    """Paths from root to leaf: branch (its leaf), msg, place from 0, for the ``best`` branches of every tree.

    ``messages``: tree, msg (a unique id), parent (null or unknown: a root) and score. A branch's score is the sum of its
    messages' (null: 0); ties go to the smaller leaf. Messages in a circle and replies to
    them reach no root and make no branch; ``unrooted`` names them.
    """
    first, settled, _, levels = _ways(messages)
    replied = first.where("up is not null").select(F.col("up").alias("msg")).distinct()
    leaves = stored(settled).join(replied, "msg", "left_anti")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "msg"))
    on = leaves.withColumn("rank", rank).where(F.col("rank") <= best)
    on = stored(on.select(F.col("msg").alias("branch"), "tree", "rank", "msg", F.lit(0).alias("above")))
    for k in range(len(levels) - 1, -1, -1):  # every distance from the leaf is a sum of jumps
        up = levels[k].select(F.col("msg").alias("m"), F.col("up").alias("next"))
        on = stored(on.union(on.join(up, F.col("msg") == F.col("m")).select("branch", "tree", "rank", F.col("next"), F.col("above") + F.lit(1 << k))))
    top = on.groupBy("branch").agg(F.max("above").alias("top"))
    return on.join(top, "branch").select("tree", "rank", "branch", "msg", (F.col("top") - F.col("above")).alias("place"))


def format_branches(paths: DataFrame, messages: DataFrame, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """tree, rank, branch, formatted and mask: (start, end) in code points of the escaped texts whose role is in ``learn``.

    Null roles and texts are empty. Texts, roles and the number of turns may have any length.
    """
    said = messages.select("msg", F.coalesce("role", F.lit("")).alias("role"), escape(F.coalesce("text", F.lit(""))).alias("text"))
    turns = paths.join(said, "msg").withColumn("head", F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(MIDDLE)))
    turns = turns.withColumn("full", F.concat("head", "text", F.lit(CLOSE)))
    ahead = Window.partitionBy("branch").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.char_length("full").cast("long")).over(ahead), F.lit(0)) + F.char_length("head")
    turns = turns.withColumn("start", start).withColumn("end", F.col("start") + F.char_length("text"))
    masked = F.when(F.col("role").isin(*learn), F.struct("start", "end"))
    out = turns.groupBy("tree", "rank", "branch").agg(
        F.sort_array(F.collect_list(F.struct("place", "full"))).alias("full"), F.array_sort(F.collect_list(masked)).alias("mask")
    )
    return out.withColumn("formatted", F.array_join(F.transform("full", lambda x: x["full"]), "")).drop("full")


def turns(formatted: Column) -> Column:
    """Read a formatted text back: an array of (role, text)."""
    def turn(t: Column) -> Column:
        body = F.substr(t, F.lit(len(OPEN) + 1))
        role = F.substring_index(body, MIDDLE, 1)
        return F.struct(unescape(role).alias("role"), unescape(F.substr(body, F.char_length(role) + len(MIDDLE) + 1)).alias("text"))

    parts = F.split(formatted, CLOSE)
    return F.transform(F.slice(parts, 1, F.size(parts) - 1), turn)


def under_mask(formatted: Column, mask: Column) -> Column:
    """The texts under the mask as they were before, one after the other."""
    return F.array_join(F.transform(mask, lambda m: unescape(F.substr(formatted, (m["start"] + 1).cast("int"), (m["end"] - m["start"]).cast("int")))), "")


def reply_chains(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Messages of plain conversations: each replies to the one before it by turn.

    Null turns come last; equal turns go by role and text, so repeated rows stay as turns of their own. Null ids make one
    conversation. A message's score is the length of its text.
    """
    rows = rows.select(F.col(conv_id).alias("tree"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    ids = stored(rows.withColumn("msg", F.monotonically_increasing_id()))
    order = Window.partitionBy("tree").orderBy(F.col("turn").asc_nulls_last(), "role", "text", "msg")
    before = F.lag("msg").over(order)
    return stored(ids.select("tree", "msg", before.alias("parent"), "role", "text", F.char_length(F.coalesce("text", F.lit(""))).alias("score")))
