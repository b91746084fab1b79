import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quartzo.llm import crf
from quartzo.llm.crf import Tagger, fit, forward_backward
from quartzo.llm.language import fit_languages, identify
from quartzo.llm.toxicity import fit_toxicity, score_toxicity

SOUNDS = {"xx": "ba be bo du ka".split(), "yy": "schi unge lich tz ver".split(), "zz": "ción mente ñar ado rra".split()}


def word(rng, lang):
    return "".join(rng.choices(SOUNDS[lang], k=rng.randrange(1, 4)))


def text(rng, lang, n):
    return " ".join(word(rng, lang) for _ in range(n)).capitalize() + "."


def test_forward_backward_is_exact():
    """Marginals and expected moves equal sums over all labellings."""
    rng = np.random.default_rng(0)
    e, moves = rng.random((7, 3)) + 0.1, rng.random((3, 3)) + 0.1
    ids, starts, lens = rng.integers(0, 7, 12), np.array([0, 5, 6]), np.array([5, 1, 4])
    out, expected = forward_backward(e, moves, ids, starts, lens)
    want, pairs = [], np.zeros((3, 3))
    for s, n in zip(starts, lens):
        total, each, pair = 0.0, np.zeros((n, 3)), np.zeros((3, 3))
        for y in np.ndindex(*[3] * n):
            p = np.prod([e[ids[s + i], y[i]] for i in range(n)]) * np.prod([moves[a, b] for a, b in zip(y, y[1:])])
            total += p
            for i in range(n):
                each[i, y[i]] += p
            for a, b in zip(y, y[1:]):
                pair[a, b] += p
        want.append(each / total)
        pairs += pair / total
    assert np.allclose(out, np.concatenate(want)) and np.allclose(expected, pairs)


def test_stretches_change_little(monkeypatch):
    rng = random.Random(1)
    runs = [([word(rng, "xy"[i % 2] * 2) for _ in range(8)], i % 2) for i in range(80)]
    model = fit([(a + b, [x] * 8 + [y] * 8) for (a, x), (b, y) in zip(runs[::2], runs[1::2])], ["xx", "yy"])
    long = " ".join(word(rng, "xx" if i // 40 % 2 else "yy") for i in range(900))

    def tag():
        parts = []
        Tagger(model).texts([None, "", long, "12 34"], lambda i, m: parts.append((i, m)))
        return np.concatenate([m for i, m in parts if i == 2])

    whole = tag()
    for name, value in (("STRETCH", 50), ("MARGIN", 16), ("TOGETHER", 100), ("REMEMBERED", 20), ("BLOCK", 64)):
        monkeypatch.setattr(crf, name, value)
    cut = tag()
    assert len(whole) == len(cut) == 900 and np.abs(whole - cut).max() < 0.05


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(7)
    rows = [(lang, text(rng, lang, rng.randrange(3, 60))) for lang in SOUNDS for _ in range(40)] + [(None, "nothing"), ("xx", None), ("xx", "")]
    return fit_languages(spark.createDataFrame(rows, "lang string, text string"))


def test_language_of_odd_texts(spark, model):
    rng = random.Random(8)
    rows = [(1, None), (2, ""), (3, "12 ... 4²"), (4, text(rng, "zz", 3)), (5, text(rng, "yy", 20_000)), (5, text(rng, "xx", 50)), (None, text(rng, "xx", 50))]
    df = spark.createDataFrame([(i, t, 4, "f") for i, t in rows], "id long, text string, score int, found string")
    got = identify(df, model).collect()
    assert [(r.id, r.lang_pred) for r in got] == [(1, "und"), (2, "und"), (3, "und"), (4, "zz"), (5, "yy"), (5, "xx"), (None, "xx")]
    assert all(r.score == 0 if r.lang_pred == "und" else 0.5 < r.score <= 1 for r in got)


def test_code_switching_is_labelled_word_by_word(spark, model):
    rng = random.Random(9)
    a, b = text(rng, "xx", 30), text(rng, "zz", 12)
    (r,) = identify(spark.createDataFrame([(f"{a} {b}",)], "text string"), model, segments=True).collect()
    assert r.lang_pred == "xx" and len(r.segments) == 2
    assert [s.lang for s in r.segments] == ["xx", "zz"] and abs(r.segments[1].start - len(a)) < 12


def test_no_labels(spark):
    none = spark.createDataFrame([], "lang string, text string")
    df = spark.createDataFrame([("abc",)], "text string")
    assert identify(df, fit_languages(none)).collect()[0].lang_pred == "und"
    assert identify(none, fit_languages(none)).count() == 0


def test_any_number_of_languages_and_long_texts(spark, monkeypatch):
    """230 languages with a word each, one only in texts that are too long to be sampled whole."""
    from quartzo.llm import language

    monkeypatch.setattr(language, "CHARS", 400)
    names = [f"l{i:03}" for i in range(230)]
    rows = [(n, f"{n.replace('l', 'w')}x " * (400 if n == "l007" else 12)) for n in names for _ in range(3)]
    sample = language._sample(spark.createDataFrame(rows, "lang string, text string"), "text", "lang")
    assert sorted(set(sample["lang"])) == names and len(sample) == 690 and sample["text"].str.len().max() <= 400
    monkeypatch.setattr(language, "TEXTS", 2)
    copies = spark.createDataFrame([("a", "same")] * 9 + [("b", "x"), ("b", "y")], "lang string, text string")
    assert language._sample(copies, "text", "lang").groupby("lang").size().to_dict() == {"a": 2, "b": 2}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang is not null")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    got = identify(docs.where(fold == 0), fit_languages(docs.where(fold != 0)))
    assert got.where("lang = lang_pred").count() >= 0.97 * got.count()


def toxic_rows(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [word(rng, "xx") for _ in range(rng.randrange(20, 80))]
        toxic = int(rng.random() < 0.3)
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(["moronic", "Grobung" + rng.choice("abcd")]))
        rows.append((i, " ".join(words), toxic))
    return rows


def test_toxic_spans_and_scores(spark):
    rows = toxic_rows(500, 3)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None), (9999, 1), (4, 7)], "doc_id long, toxic int")
    model = fit_toxicity(docs, labels)
    fresh = toxic_rows(200, 4)
    odd = [(1000, None, 0), (1001, "", 0), (1001, "123", 0), (None, "x " * 30_000 + "moronic", 1)]
    new = spark.createDataFrame([(i, t, 1) for i, t, _ in fresh + odd], "doc_id long, text string, toxic_score int")
    got = score_toxicity(new, model).collect()
    assert all(0 <= r.toxic_score <= 1 and r.toxic_pred == (r.toxic_score >= 0.5) for r in got)
    assert np.mean([r.toxic_pred == y for r, (_, _, y) in zip(got, fresh + odd)]) >= 0.97
    spans = [r.text[s.start : s.end] for r in got for s in r.toxic_spans]
    assert np.mean([("moronic" in s) or ("Grobung" in s) for s in spans]) > 0.9


@pytest.mark.parametrize("kind", [[], [(1, 0)], [(1, 1)]])
def test_labels_of_one_kind(spark, kind):
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    model = fit_toxicity(docs, spark.createDataFrame(kind, "doc_id long, toxic int"))
    (r,) = score_toxicity(docs, model, spans=False).collect()
    assert r.toxic_pred == int(kind == [(1, 1)])
    assert score_toxicity(docs.limit(0), model).count() == 0
