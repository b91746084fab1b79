import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quartzo.llm import simhash
from quartzo.llm.common import components

SCHEMA = "doc_id long, text string, fingerprint int, Text_2 string"


def plain_fingerprint(text, k=4):
    """The contract, bit by bit."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(ids, fps, bits=4):
    group = list(range(len(ids)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                group[top(i)] = top(j)
    low = {}
    for i, x in enumerate(ids):
        r = top(i)
        low[r] = x if low.get(r) is None else low[r] if x is None else min(x, low[r])
    return [low[top(i)] for i in range(len(ids))]


def check(spark, texts, **options):
    df = spark.createDataFrame([(i, t, 5, "x") for i, t in texts], SCHEMA)
    got = sorted(map(tuple, simhash.simhash_components(df, **options).select("doc_id", "fingerprint", "component_id").collect()), key=str)
    fps = [plain_fingerprint(t) for _, t in texts]
    comps = plain_components([i for i, _ in texts], fps)
    assert got == sorted(((i, f"{f:016x}", c) for (i, _), f, c in zip(texts, fps, comps)), key=str)
    return got


def test_odd_rows(spark):
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    texts = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "a b c"), (7, "a b c d É"), (7, "a b c d É"), (None, "a b c d É"),
             (None, "zz"), (8, long), (9, long + " tail"), (10, "x\x1cy\x85z"), (-3, "A B C D é")]
    check(spark, texts)


def test_near_copies_link(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for g in range(6):
        base = rng.choices(words, k=300)
        for c in range(6):
            copy = list(base)
            for _ in range(c // 2):
                copy[rng.randrange(300)] = "changed"
            texts.append((len(texts) * 7 % 41, " ".join(copy)))
    got = check(spark, texts)
    assert len({c for _, _, c in got}) < len(got)


def test_empty_table(spark):
    assert simhash.simhash_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_blocks_of_a_text_agree(monkeypatch):
    text = " ".join(f"w{i * i % 101}" for i in range(700)) + "  "
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK", 50)
    monkeypatch.setattr(simhash, "SHINGLES", 16)
    assert simhash.fingerprint(text) == whole == plain_fingerprint(text)
    assert [simhash.fingerprint(t) for t in (None, "", "a", "a b c")] == [plain_fingerprint(t) for t in (None, "", "a", "a b c")]


@pytest.mark.parametrize("per_range", [500_000, 40])
def test_crowded_ranges_lose_no_link(spark, per_range, monkeypatch):
    """A crowd around one value, a chain and lone values; small limits force the second deal and the slices."""
    monkeypatch.setattr(simhash, "VALUES", 1 << 12)
    rng = random.Random(5)
    base = rng.getrandbits(64)
    fps = {base ^ sum(1 << b for b in rng.sample(range(64), rng.choice([0, 1, 2, 3, 4, 6]))) for _ in range(60)}
    fps |= {rng.getrandbits(64) for _ in range(30)} | {(1 << 4 * i) - 1 for i in range(17)} | {0, 1 << 63, (1 << 64) - 1}
    fps = sorted(fps)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    links = simhash.near_fingerprints(spark.createDataFrame([(f,) for f in signed], "fp long"), 4, per_range=per_range)
    root = dict(map(tuple, components(links).collect()))
    mine = [root.get(f, f) for f in signed]
    want = plain_components(list(range(len(fps))), fps)
    assert len(set(zip(mine, want))) == len(set(mine)) == len(set(want))


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (300, 200), (200, 300)]
    got = dict(map(tuple, components(spark.createDataFrame(chain, "a long, b long")).collect()))
    assert all(got[i] == 1 for i in range(1, 61)) and all(got[100 + i] == 100 for i in range(40)) and got[300] == got[200] == 200
    assert components(spark.createDataFrame([], "a long, b long").select(F.col("a"), "b")).count() == 0
