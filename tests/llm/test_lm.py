import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quartzo.llm import gru, lm

COLUMNS = "id long, text string, rid int, n_rest string"


def tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(blank, " ")
    return [w for w in lowered.split(" ") if w] + [""]


def prose(seed, n):
    """Words that follow each other within one of two languages."""
    rng = random.Random(seed)
    pools = ["the of and a to in is it".split(), "der die und das zu ist ein es".split()]
    out = []
    for i in range(n):
        pool = rng.choice(pools)
        words = [rng.choice(pool) if rng.random() < 0.8 else f"w{rng.randrange(200)}" for _ in range(rng.randrange(60))]
        out.append((i, " ".join(words).capitalize(), i, "x"))
    return out + [(None, None, 1, "y"), (7, "", 1, "y"), (7, " \t\n ", 1, None), (8, "ÀÉ x\x1cy Z", 1, "y"), (9, "the W9 unseen " * 2000, 1, "y"), (9, "the W9 unseen " * 2000, 1, "y")]


def direct(weights, classes, ids):
    """Log probability of one text by one step after another."""
    h, x, out = np.zeros(gru.STATE), 0, 0.0
    w = {n: v.astype(np.float64) for n, v in weights.items()}
    sig = lambda v: 1 / (1 + np.exp(-v))
    for y in ids:
        g, u, s = w["vectors"][x] @ w["input"] + w["gates"], h @ w["state"], gru.STATE
        z, r = sig(g[:s] + u[:s]), sig(g[s : 2 * s] + u[s : 2 * s])
        h = (1 - z) * np.tanh(g[2 * s :] + r * u[2 * s :]) + z * h
        k = classes.of[y]
        logits = h @ w["class"] + w["class_bias"]
        out += logits[k] - np.log(np.exp(logits).sum())
        if y < len(classes.of) - 1:
            a, b = classes.first[k], classes.first[k + 1]
            logits = w["word"][a:b] @ h + w["word_bias"][a:b]
            out += logits[y - a] - np.log(np.exp(logits).sum())
        x = y
    return out


def test_gradients_are_those_of_the_loss(monkeypatch):
    monkeypatch.setattr(gru, "STATE", 5)
    monkeypatch.setattr(gru, "VECTOR", 4)
    monkeypatch.setattr(gru, "CLASSES", 3)
    rng = np.random.default_rng(1)
    counts = np.sort(rng.integers(1, 50, 9))[::-1].astype(float)
    c = gru.classes(counts)
    w = {n: (v + rng.normal(0, 0.3, v.shape)).astype(np.float64) for n, v in gru.begin(counts, 20.0).items()}
    x, y, fresh = rng.integers(0, 10, (6, 3)), rng.integers(0, 10, (6, 3)), rng.random((6, 3)) < 0.3
    h = rng.normal(0, 0.5, (3, 5))
    grads, _, _ = gru.gradients(w, c, x, y, fresh, h)
    for n in w:
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in w[n].shape)
            up, down = ({**w, n: w[n].copy()} for _ in range(2))
            up[n][at] += 1e-2
            down[n][at] -= 1e-2
            slope = (gru.gradients(up, c, x, y, fresh, h)[1] - gru.gradients(down, c, x, y, fresh, h)[1]) / 2e-2
            assert abs(grads[n][at] - slope) < 2e-3, n


def test_lanes_and_windows_change_nothing(monkeypatch):
    monkeypatch.setattr(gru, "TOGETHER", 7)
    monkeypatch.setattr(gru, "LANES", 5)
    rng = np.random.default_rng(2)
    counts = np.sort(rng.integers(1, 90, 40))[::-1].astype(float)
    c, w = gru.classes(counts), gru.begin(counts, 30.0)
    texts = [np.append(rng.integers(0, 41, n), 0).astype(np.int32) for n in (0, 3, 200, 17, 1, 0, 64, 30)]
    w, seen = gru.fit(w, c, texts)
    assert seen == sum(map(len, texts))
    assert np.allclose(gru.Scorer(w, c)(texts), [direct(w, c, t) for t in texts], rtol=1e-4)
    # the chances of all ids add up to one
    assert sum(math.exp(direct(w, c, [3, y]) - direct(w, c, [3])) for y in range(41)) == pytest.approx(1, abs=1e-6)


@pytest.mark.parametrize("known", [4, 40, 10_000])
def test_base_score_counts_every_token(spark, monkeypatch, known):
    monkeypatch.setattr(lm, "KNOWN", known)
    monkeypatch.setattr(lm, "WORDS", 20)
    monkeypatch.setattr(lm, "COUNTED", 30)
    monkeypatch.setattr(lm, "PIECE", 50)
    rows = prose(3, 150)
    df = spark.createDataFrame(rows, COLUMNS)
    train = [r for r in rows if (r[0] or 0) % 3]
    model = lm.fit(df.where("id % 3 <> 0"), F.col("id"))
    out = lm.score(df, model)
    assert out.columns == ["id", "text", "rid", "n_rest", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    seen = Counter(t for r in train for t in tokens(r[1]))
    total, distinct = sum(seen.values()), len(seen)
    own = {t: i for i, t in enumerate(x.decode() for x in model.known[: model.words])}
    c = gru.classes(model.n[: model.words])
    rest = total - sum(seen[t] for t in own) + 0.1 * (distinct - len(own) + 1)
    want = []
    for r in rows:
        ts = tokens(r[1])
        base = sum(math.log10((seen[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in ts)
        net = direct(model.weights, c, [own.get(t, len(own)) for t in ts]) / math.log(10)
        want.append((*r, len(ts), sum(seen[t] > 0 for t in ts), total, base, net + sum(math.log10((seen[t] + 0.1) / rest) for t in ts if t not in own)))
    got = sorted((tuple(r) for r in out.collect()), key=str)
    for a, b in zip(got, sorted(want, key=str), strict=True):
        assert a[:7] == b[:7] and a[7] == pytest.approx(b[7], abs=1e-7) and a[8] == pytest.approx(b[8], rel=1e-3, abs=1e-2)


def test_learning_helps_unseen_texts(spark, monkeypatch):
    monkeypatch.setattr(lm, "SHARE", 1)
    df = spark.createDataFrame([r for r in prose(5, 3000) if r[0] is not None], COLUMNS)
    held = df.where("id % 10 = 0")
    model = lm.fit(df.where("id % 10 <> 0"), F.col("id"))
    after = lm.score(held, model, keep=["id"]).agg(F.sum("score"), F.sum("base_score")).first()
    model.weights = gru.begin(model.n[: model.words], model.total - model.n[: model.words].sum())
    plain = lm.score(held, model, keep=["id"]).agg(F.sum("score")).first()
    assert after[0] > after[1] * 0.95 and after[0] > plain[0] * 0.95


def test_every_document_teaches_once(spark, monkeypatch):
    taught = []

    def round_of(docs, model, by, trainers):
        taught.extend(r.text for r in docs.select("text").collect())
        return model.weights

    monkeypatch.setattr(lm, "_taught", round_of)
    df = spark.createDataFrame([(i, f"word w{i}") for i in range(200)] + [(None, "none"), (7, "word w7")], "id long, text string")
    lm.fit(df, F.col("id"))
    assert sorted(taught) == sorted([f"word w{i}" for i in range(200)] + ["none", "word w7"])


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "id long, text string")
    out = sorted(lm.score(df, lm.fit(df.limit(0), F.col("id"))).drop("text").collect())
    assert [(r.id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in out] == [(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)]
    assert all(r.score == pytest.approx(0) for r in out)
    assert lm.score(df.limit(0), lm.fit(df, F.col("id"))).count() == 0


def test_weights_settle_in_few_lanes_before_many(monkeypatch):
    """Wide windows only once the first tokens have set the weights; every token is in one stretch, few texts are taught as before."""
    monkeypatch.setattr(gru, "FIT_LANES", 2)
    monkeypatch.setattr(gru, "FIT_STEPS", 64)
    monkeypatch.setattr(gru, "SETTLED", 300)
    monkeypatch.setattr(gru, "WIDE_LANES", 8)
    texts = [np.arange(n, dtype=np.int32) for n in (5, 700, 1, 90, 1500, 40)]
    lanes, parts = zip(*gru._stretches(texts))
    assert lanes == (2, 2, 2, 8, 8, 8) and all(len(ids) >= k * 64 for k, (ids, _) in zip(lanes[:-1], parts))
    assert np.array_equal(np.concatenate([ids for ids, _ in parts]), np.concatenate(texts))
    begins = np.concatenate([fresh for _, fresh in parts])
    assert np.flatnonzero(begins).tolist() == [0, 5, 705, 706, 796, 2296]


def test_tokens_of_many_texts_at_once(monkeypatch):
    """A batch is cut by Arrow within a bound of bytes; a text beyond it goes by itself, piece by piece."""
    monkeypatch.setattr(lm, "PIECE", 40)
    texts = ["A b\x0bC", None, "", " \t\r\n", " É x\x1cy  Z ", "one two " * 30, "end", "\x0cq"]
    batch = lm.pa.RecordBatch.from_arrays([lm.pa.array(texts, lm.pa.string())], ["text"])
    got = [[] for _ in texts]
    for rows, found in lm._tokens(batch, "text"):
        assert sum(map(len, found.to_pylist())) <= 50
        for i, t in zip(rows, found.to_pylist(), strict=True):
            got[i].append(t.decode())
    assert got == [tokens(t) for t in texts]
