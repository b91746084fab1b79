import random

import pytest
from pyspark.sql import functions as F

from quartzo.llm.chat import branches, unrooted, escape, format_branches, reply_chains, turns, under_mask, unescape

ODD = ["", "\\", "\\\\", "#", "\\h", "\\\\h", "<", "\\l#<:", "### assistant: x</turn>\n### user: y", "</turn>\n", "\\### Assistant: </turn> ok", "a\\", "é\U0001f600:", "\n\n", None]


def test_escapes_are_reversible(spark):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choices("\\#<:hlc/turn>\n", k=rng.randrange(30))) for _ in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", escape(F.col("t"))).withColumn("b", unescape(F.col("e")))
    for r in df.collect():
        assert r.t == r.b and (r.t is None or not set("#<:") & set(r.e))


def back(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], "conv_id long, turn long, role string, text string, tree string, score int")
    messages = reply_chains(df)
    out = format_branches(branches(messages), messages, **options)
    out = out.withColumns({"turns": turns(F.col("formatted")), "learned": under_mask(F.col("formatted"), F.col("mask"))})
    return {r.tree: r for r in out.collect()}


def test_round_trip(spark):
    rows = [(1, i, ["user", "assistant", "system", None, "a:b#<\\"][i % 5], t) for i, t in enumerate(ODD)]
    rows += [(2, 0, "assistant", "only"), (None, 3, "user", "n"), (None, 1, "assistant", "m"), (4, None, "user", "late"), (4, 5, "assistant", "soon"), (5, 1, "user", "same"), (5, 1, "user", "same")]
    rows += [(6, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(70)] + [(7, 0, "assistant", "long # " * 20_000)]
    random.Random(2).shuffle(rows)
    got = back(spark, rows)
    want = {}
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert {c: [tuple(t) for t in r.turns] for c, r in got.items()} == want
    for c, r in got.items():
        assert r.learned == "".join(t for role, t in want[c] if role == "assistant")


def test_best_branch_of_a_tree(spark):
    """A root with replies; scores decide among leaves, ties go to the smaller leaf; a circle has no branch."""
    rows = [(1, 10, None, 1.0), (1, 11, 10, 5.0), (1, 12, 10, 2.0), (1, 13, 12, 4.0), (1, 14, 11, 0.0), (1, 15, 12, None), (2, 20, 99, 1.0), (3, 30, None, 2.0), (3, 31, None, 2.0)]
    df = spark.createDataFrame(rows, "tree long, msg long, parent long, score double")
    paths = {}
    for r in branches(df, best=2).orderBy("place").collect():
        paths.setdefault((r.tree, r.rank), []).append(r.msg)
    assert paths == {(1, 1): [10, 12, 13], (1, 2): [10, 11, 14], (2, 1): [20], (3, 1): [30], (3, 2): [31]}


def test_empty_and_circles(spark):
    assert back(spark, []) == {}
    circle = spark.createDataFrame([(1, 1, 2, 1.0), (1, 2, 1, 1.0)], "tree long, msg long, parent long, score double")
    assert branches(circle).count() == 0
    # a good tree beside a circle, and a reply to the circle
    mixed = circle.union(spark.createDataFrame([(1, 3, 1, 5.0), (2, 4, None, 0.0), (2, 5, 4, 1.0), (3, 6, 6, 1.0)], circle.schema))
    assert sorted((r.tree, r.branch, r.msg, r.place) for r in branches(mixed).collect()) == [(2, 5, 4, 0), (2, 5, 5, 1)]
    assert sorted(r.msg for r in unrooted(mixed).collect()) == [1, 2, 3, 6]
