import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quartzo.llm import queries, trie
from quartzo.llm.trie import first_below, prefix_trie, range_min, search


def plain(convs):
    """Nodes of {conv: [(step, words), ...]} by counting every prefix."""
    nodes = {}
    for c, steps in convs.items():
        for d in range(len(steps) + 1):
            nodes.setdefault(tuple(s for s, _ in steps[:d]), []).append(c)
    words = {tuple(s for s, _ in steps[:d]): steps[d - 1][1] for steps in convs.values() for d in range(1, len(steps) + 1)}
    out = []
    for key, members in nodes.items():
        kids = [k for k in nodes if len(k) == len(key) + 1 and k[:-1] == key]
        under = [k for k in nodes if k[: len(key)] == key]
        leaves = [k for k in under if not any(len(x) == len(k) + 1 and x[:-1] == k for x in under)]
        saved = sum((len(nodes[k]) - 1) * words.get(k, 0) for k in under)
        ends = sorted(c for c in members if len(convs[c]) == len(key))
        out.append((min(members), len(key), min(nodes[key[:-1]]) if key else None, len(members), len(kids), len(leaves), saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def frames(spark, convs):
    rows = [(c, i, s, w, "x") for c, steps in convs.items() for i, (s, w) in enumerate(steps)]
    return spark.createDataFrame(rows, "conv long, by int, step string, words long, at string"), spark.createDataFrame([(c,) for c in convs], "conv long")


def result(df):
    return sorted((tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=str)


@pytest.mark.parametrize(("block", "chunk", "n"), [(4, 3, 120), (2, 4096, 40), (1024, 2, 60)])
def test_trie_is_that_of_every_prefix(spark, monkeypatch, block, chunk, n):
    monkeypatch.setattr(trie, "BLOCK", block)
    monkeypatch.setattr(trie, "CHUNK", chunk)
    rng = random.Random(n)
    words = {s: rng.randrange(9) for s in "abcd"}
    digest = {s: hashlib.sha256(s.encode()).hexdigest() for s in "abcd"}
    convs = {}
    for c in rng.sample(range(-50, 400), n):
        steps = rng.choice(["", "a", "ab", "ab", "abcd", "".join(rng.choices("aabcd", k=rng.randrange(7)))])
        convs[c] = [(digest[s], words[s]) for s in steps]
    convs[1000] = [(digest[s], words[s]) for s in "ab" * 60]  # long
    turns, ids = frames(spark, convs)
    extra = spark.createDataFrame([(None, 1, "zz", 5, "x")], turns.schema)
    assert result(prefix_trie(turns.union(extra), ids.union(ids))) == plain(convs)


def test_few_conversations(spark):
    d = hashlib.sha256(b"a").hexdigest()
    for convs in ({}, {5: []}, {5: [(d, 3)]}, {5: [], 6: []}, {7: [(d, 3)], -2: [(d, 3)]}):
        assert result(prefix_trie(*frames(spark, convs))) == plain(convs)


def test_searches():
    rng = np.random.default_rng(0)
    v = rng.integers(-1, 6, 57)
    at, d = rng.integers(0, 58, 200), rng.integers(0, 7, 200)
    want = [next((i for i in range(a, 57) if v[i] < x), 57) for a, x in zip(at, d)]
    assert first_below(v, at, d).tolist() == want
    first = rng.integers(0, 57, 100)
    last = np.minimum(56, first + rng.integers(0, 57, 100))
    assert range_min(v, first, last).tolist() == [v[a : b + 1].min() for a, b in zip(first, last)]


def test_search_goes_on_from_block_to_block(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 3)
    rng = random.Random(2)
    v = [rng.randrange(12) for _ in range(100)]
    asked = sorted({(rng.randrange(101), rng.randrange(13)) for _ in range(150)})
    got = search(spark.createDataFrame(list(enumerate(v)), "at long, v long"), 100, spark.createDataFrame(asked, "at long, d long")).collect()
    assert sorted((r.at, r.d, r.found) for r in got) == [(a, d, next((i for i in range(a, 100) if v[i] < d), 100)) for a, d in asked]


def test_query_takes_turns_of_the_family(spark, tmp_path):
    rng = random.Random(8)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "a b", None, "", "é x y"])) for c in range(0, 70) for t in rng.choice([[0], [None, 0, 1], range(5)]) if c % 20 or c < 40]
    rows += [(None, 0, "user", "lost"), (45, 9, "user", "w " * 30_000)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    own = {}
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            step = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append(((t is not None, t or 0), step, len(text.split())))
    own = {c: [x[1:] for x in sorted(v)] for c, v in own.items()}
    import zlib

    convs = {c: own.get(c - c % 20, [])[: zlib.crc32(str(c).encode()) % 4] + v[zlib.crc32(str(c).encode()) % 4 :] for c, v in own.items()}
    assert result(queries.op13_prefix_trie(spark, str(tmp_path))) == plain(convs)
