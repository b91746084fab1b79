import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quartzo.llm import merkle
from quartzo.llm.merkle import manifest, refold


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes, fanout):
    """Root, and of every node its siblings level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(paths):
            a = at[i] // fanout * fanout
            run = nodes[a : a + fanout]
            p.append(("".join(run[: at[i] - a]), "".join(run[at[i] - a + 1 :])))
        nodes, at = [sha(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)], [x // fanout for x in at]
    return (nodes or [None])[0], paths


def plain(rows, fanout):
    """(leaf, subroot, root, path) of every row (id, lang, n, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(sha(*map(field, r)))
    ids = {k: sorted((r[0] is not None, r[0] or 0, sha(*map(field, r))) for r in rows if r[1] == k) for k in groups}
    order = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    subs = {k: tree([h for *_, h in ids[k]], fanout) for k in order}
    root, over = tree([subs[k][0] for k in order], fanout)
    out = []
    for k, more in zip(order, over):
        out += [(h, subs[k][0], root, tuple(p + more)) for (*_, h), p in zip(ids[k], subs[k][1])]
    return sorted(out)


def case(n, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([None, *range(n)]), rng.choice(["en", "en", "en", "é", "Z", "", None, "one"]), rng.choice([None, 3, 44]), rng.choice([None, "", "a", "ü x", "a" * 20_000])) for _ in range(n)]
    return rows + rows[: n // 4] + [(1, "lone", None, None)] * (n > 5)


@pytest.mark.parametrize(("n", "fanout", "block"), [(150, 2, 8), (150, 3, 9), (90, 5, 5), (60, 2, 1024), (1, 2, 8), (7, 2, 2)])
def test_manifest_is_the_tree(spark, monkeypatch, n, fanout, block):
    monkeypatch.setattr(merkle, "BLOCK", block)
    rows = case(n, n + fanout)
    df = spark.createDataFrame(rows, "id long, lang string, n long, text string").withColumns({"node": F.lit(1), "at": F.lit("x"), "path": F.lit(2)})
    out = manifest(df, [F.col(c) for c in ("id", "lang", "n", "text")], "lang", "id", fanout)
    assert out.columns == ["id", "lang", "n", "text", "node", "at", "leaf", "subroot", "root", "path", "proof_sha256"]
    out = out.withColumn("again", refold(F.col("leaf"), F.col("path"))).collect()
    assert sorted((r.leaf, r.subroot, r.root, tuple((s.left, s.right) for s in r.path)) for r in out) == plain(rows, fanout)
    for r in out:
        assert r.leaf == sha(*map(field, (r.id, r.lang, r.n, r.text))) and r.again == r.root
        assert r.proof_sha256 == sha(*(x for s in r.path for x in s))


def test_tampering_shows(spark):
    df = spark.createDataFrame(case(40, 5), "id long, lang string, n long, text string")
    out = manifest(df, [F.col(c) for c in ("id", "lang", "n", "text")], "lang", "id", keep=["id"])
    assert out.columns == ["id", "leaf", "subroot", "root", "path", "proof_sha256"]
    out = out.withColumn("folded", refold(F.sha2(F.lit("other").cast("binary"), 256), F.col("path")))
    assert out.where("folded <> root").count() == out.count() > 0


def test_empty_and_wrong(spark):
    none = spark.createDataFrame([], "id long, lang string")
    assert manifest(none, [F.col("id")], "lang", "id").collect() == []
    with pytest.raises(ValueError):
        manifest(none, [F.col("id")], "lang", "id", fanout=1)
