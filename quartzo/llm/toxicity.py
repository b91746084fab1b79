"""Toxic spans by a linear-chain conditional random field over words, and a score for each text.

Labels are given for whole texts. Words become labelled tokens like this: within texts labelled toxic, a word is toxic if it
or one of its affixes occurs almost only in toxic texts. The field learns from these tokens, so it also knows the affixes
and neighbours of toxic words. Forward-backward marginals give the spans; their sum and maximum give the score, by a
logistic curve fitted on texts that the field has not seen.
"""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quartzo.llm.common import unused
from quartzo.llm.crf import Model, Tagger, _blocks, fit, words_of

#: The bounded sample: texts of each label, characters of such a text, words the field sees around a toxic word or of a clean text.
TEXTS, CHARS, NEAR, CLEAN = 2500, 20_000, 8, 60
#: A cue must be so many times as often in toxic as in clean texts, by a log-likelihood ratio of so much.
TIMES, RATIO = 8.0, 24.0


@dataclass
class ToxicModel:
    field: Model
    curve: np.ndarray


def _cues(word: str) -> Iterator[str]:
    yield "=" + word
    for n in range(4, min(7, len(word)) + 1):
        yield "^" + word[:n]
        yield word[-n:] + "$"


def _sample(docs: DataFrame, labels: DataFrame, text: str, doc_id: str) -> tuple[pd.DataFrame, dict[int, int]]:
    """About TEXTS labelled texts of either kind, drawn by a hash of the id, and how many of each kind there are."""
    known = labels.select(F.col("doc_id").alias("labelled"), F.col("toxic").cast("int").alias("toxic")).where("labelled is not null and toxic in (0, 1)")
    known = known.groupBy("labelled").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    kinds = [known.where(F.col("toxic") == kind).orderBy(F.xxhash64("labelled"), "labelled").limit(TEXTS) for kind in (0, 1)]
    drawn = F.broadcast(kinds[0].union(kinds[1]))  # 2 * TEXTS rows at most
    rows = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("labelled"), F.col(text).alias("text"))
    rows = rows.where((F.char_length("text") <= CHARS) & (F.char_length("text") > 0)).join(drawn, "labelled")
    return rows.limit(4 * TEXTS).toPandas().sort_values(["labelled", "text"]), counts


def _tagged(words: list[list[str]], toxic: np.ndarray) -> list[list[int]]:
    """1 for the words of toxic texts that a cue gives away."""
    tally = (Counter(), Counter())
    for ws, y in zip(words, toxic):
        tally[y].update({c for w in set(ws) for c in _cues(w)})
    n = np.bincount(toxic, minlength=2)

    def telling(c: str, seen: int) -> bool:
        clean = tally[0][c]
        if seen / n[1] < TIMES * clean / n[0]:
            return False
        due = (seen + clean) * n[1] / n.sum()
        return 2 * (seen * np.log(seen / due) + (clean * np.log(clean / (seen + clean - due)) if clean else 0)) >= RATIO

    cues = {c for c, seen in tally[1].items() if telling(c, seen)}
    bad = {w: any(c in cues for c in _cues(w)) for ws, y in zip(words, toxic) if y for w in ws}
    return [[int(y and bad[w]) for w in ws] for ws, y in zip(words, toxic)]


def _stretches(words: list[str], tags: list[int], rng: random.Random) -> Iterator[tuple[list[str], list[int]]]:
    """What the field sees of a text: the surroundings of toxic words, or a stretch anywhere in the text."""
    hits = [i for i, t in enumerate(tags) if t]
    if not hits:
        a = rng.randrange(max(1, len(words) - CLEAN))
        yield words[a : a + CLEAN], tags[a : a + CLEAN]
    end = -1
    for i in hits:
        if i >= end:
            a, end = max(0, i - NEAR, end), i + NEAR
            yield words[a:end], tags[a:end]


def _summary(marginals: list[np.ndarray]) -> tuple[float, float]:
    p = np.concatenate(marginals)[:, 1] if marginals else np.zeros(1)
    return float(p.max()), float(np.log1p(p.sum()))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 1e-2) -> np.ndarray:
    """Newton steps; the slopes are kept at zero or above, so more toxic words never lower a score."""
    x = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + l2 * np.eye(len(b))
        b = b + np.clip(np.linalg.solve(h, x.T @ (weight * (y - p)) - l2 * b), -2, 2)
        b[1:] = np.maximum(b[1:], 0)
    return b


def fit_toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> ToxicModel:
    """``labels``: doc_id and toxic (0 or 1; others and nulls are no label; an id with both counts as toxic)."""
    sample, counts = _sample(docs, labels, text, doc_id)
    toxic = sample["toxic"].to_numpy(np.int64)
    if len(set(toxic)) < 2:  # nothing to tell apart: what there is decides
        return ToxicModel(fit([], ["clean", "toxic"]), np.array([3.0 if len(toxic) and toxic[0] else -3.0, 0, 0]))
    words = [[w.lower() for block in _blocks(t) for w in block] for t in sample["text"]]
    tags = _tagged(words, toxic)
    rng = random.Random(23)
    unseen = np.array([rng.random() < 0.35 for _ in words])
    field = fit([s for ws, ts, out in zip(words, tags, unseen) if not out for s in _stretches(ws, ts, rng)], ["clean", "toxic"])
    shown: dict[int, list[np.ndarray]] = {}
    chosen = np.flatnonzero(unseen)
    Tagger(field).texts(sample["text"].to_numpy()[chosen], lambda i, m: shown.setdefault(i, []).append(m))
    x = np.array([_summary(shown.get(i, [])) for i in range(len(chosen))])
    y = toxic[chosen]
    each = np.array([counts[k] / max(1, (y == k).sum()) for k in (0, 1)])[y]  # as often as they occur
    return ToxicModel(field, _logistic(x, y, each / each.mean()))


def _spans(tagger: Tagger, text: str) -> list[dict]:
    """Runs of words that are toxic rather than not, as character offsets."""
    p: list[np.ndarray] = []
    tagger.texts([text], lambda _, m: p.append(m[:, 1]))
    out: list[dict] = []
    last = -2
    for i, (match, x) in enumerate(zip(words_of(text), np.concatenate(p))):
        if x >= 0.5:
            if last == i - 1:
                out[-1]["end"] = match.end()
                out[-1]["score"] = max(out[-1]["score"], float(x))
            else:
                out.append({"start": match.start(), "end": match.end(), "score": float(x)})
            last = i
    return out


def score_toxicity(docs: DataFrame, model: ToxicModel, text: str = "text", spans: bool = True) -> DataFrame:
    """All rows and columns, with toxic_score (0 to 1), toxic_pred (1 from 0.5 on) and toxic_spans (start, end in characters, score).

    Whole texts are read. Null, empty and wordless texts have no toxic word and get the curve's lowest score. Repeated
    rows get equal scores. Columns of the same names are replaced.
    """
    kind = "toxic_score double, toxic_pred int" + ", toxic_spans array<struct<start:int,end:int,score:double>>" * spans

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tagger, curve = Tagger(model.field), model.curve
        for texts in batches:
            x = np.zeros((len(texts), 2))

            def add(i: int, marginals: np.ndarray) -> None:
                p = marginals[:, 1]
                x[i] = max(x[i, 0], p.max()), x[i, 1] + p.sum(dtype=np.float64)

            if tagger.model.known:
                tagger.texts(texts, add)
            hit = x[:, 0] >= 0.5
            x[:, 1] = np.log1p(x[:, 1])
            score = 1 / (1 + np.exp(-(curve[0] + x @ curve[1:])))
            out = {"toxic_score": score, "toxic_pred": (score >= 0.5).astype(np.int32)}
            if spans:
                out["toxic_spans"] = [_spans(tagger, t) if h else [] for t, h in zip(texts, hit)]
            yield pd.DataFrame(out)

    (found,) = unused(docs, "found")
    names = ["toxic_score", "toxic_pred", *["toxic_spans"] * spans]
    rows = docs.drop(*names).withColumn(found, run(F.col(text)))
    return rows.select("*", *(F.col(f"{found}.{n}") for n in names)).drop(found)
