"""Language identification by a linear-chain conditional random field over words.

The field is fitted on a bounded sample of labelled texts. Stretches of different texts are laid one after the other, so the
moves between languages are learned as well, and code-switched text is labelled word by word.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quartzo.llm.common import identified, unused
from quartzo.llm.crf import Model, Tagger, _blocks, fit, words_of

UNKNOWN = "und"
#: The bounded sample: texts of each language, characters of such a text (a stretch of it, if it is longer), words of it that
#: the field sees.
TEXTS, CHARS, WORDS = 500, 20_000, 160
RUN = 20


def _sample(labelled: DataFrame, text: str, lang: str) -> pd.DataFrame:
    """TEXTS texts of each language, or all it has: those whose rows have the smallest hashes. Copies are drawn one by one."""
    (rid,) = unused(labelled, "row")
    rows = identified(labelled.where(F.col(lang).isNotNull() & (F.char_length(text) > 0)), rid)
    rows = rows.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), F.xxhash64(rid).alias("draw"))
    # about four times as many as are wanted are ranked, so that this doesn't grow with the input; a count for each language,
    # as one value, lets texts stay where they are until then
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.agg(F.map_from_entries(F.collect_list(F.struct("lang", "n")))).scalar()
    place = F.pmod("draw", F.lit(1 << 40))
    near = rows.withColumn("place", place).where(F.col("place") / (1 << 40) * F.element_at(sizes, F.col("lang")) < 4 * TEXTS)
    spare = F.char_length("text") - CHARS
    start = F.when(spare > 0, F.pmod(F.col("draw"), spare + 1)).otherwise(0)
    near = near.withColumn("text", F.substr("text", (start + 1).cast("int"), F.lit(CHARS)))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "draw", "text"))
    drawn = near.withColumn("rank", rank).where(F.col("rank") <= TEXTS).select("lang", "text")
    return drawn.toPandas().sort_values(["lang", "text"])


def fit_languages(labelled: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """A model of the languages that the non-null labels name; without any it has none."""
    sample = _sample(labelled, text, lang)
    labels = sorted(set(sample["lang"]))
    rng = random.Random(17)
    runs: list[tuple[list[str], int]] = []
    for t, name in zip(sample["text"], sample["lang"]):
        words = [w.lower() for block in _blocks(t) for w in block]
        take = min(len(words), WORDS)
        picks = range(0, take, RUN) if len(words) <= WORDS else sorted(rng.randrange(len(words) - RUN) for _ in range(take // RUN))
        runs += [(words[a : a + RUN], labels.index(name)) for a in picks]
    rng.shuffle(runs)
    sequences = []
    for i in range(0, len(runs), 3):
        part = [(w, y) for words, y in runs[i : i + 3] for w in words]
        sequences.append(([w for w, _ in part], [y for _, y in part]))
    return fit(sequences, labels)


def _segments(tagger: Tagger, text: str) -> list[dict]:
    """Runs of words of one language, as character offsets."""
    best: list[np.ndarray] = []
    tagger.texts([text], lambda _, m: best.append(m.argmax(1)))
    out: list[dict] = []
    for match, label in zip(words_of(text), np.concatenate(best) if best else ()):
        name = tagger.model.labels[label]
        if out and out[-1]["lang"] == name:
            out[-1]["end"] = match.end()
        else:
            out.append({"lang": name, "start": match.start(), "end": match.end()})
    return out


def identify(docs: DataFrame, model: Model, text: str = "text", segments: bool = False) -> DataFrame:
    """All rows and columns, with lang_pred, score and, if asked for, segments (lang, start, end in characters).

    score: mean marginal of the predicted language over all words of the text. Null texts, texts without a letter, and all
    texts if the model has no language are ``und`` with score 0. Equal scores: the language that sorts first. Texts of any
    length are tagged whole. Columns of the same names are replaced.
    """
    kind = "lang_pred string, score double" + ", segments array<struct<lang:string,start:int,end:int>>" * segments

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tagger = Tagger(model)
        labels = np.array([*tagger.model.labels, UNKNOWN], object)
        k = len(labels) - 1
        for texts in batches:
            sums, count = np.zeros((len(texts), k)), np.zeros(len(texts))

            def add(i: int, marginals: np.ndarray) -> None:
                sums[i] += marginals.sum(0)
                count[i] += len(marginals)

            if k:
                tagger.texts(texts, add)
            heard = np.array([n > 0 and any(c.isalpha() for c in t) for n, t in zip(count, texts)], bool)
            best = np.where(heard, sums.argmax(1) if k else k, k)
            score = np.where(heard, sums.max(1) if k else 0, 0) / np.maximum(count, 1)
            out = {"lang_pred": labels[best], "score": np.clip(score, 0, 1)}
            if segments:
                out["segments"] = [_segments(tagger, t) if h else [] for t, h in zip(texts, heard)]
            yield pd.DataFrame(out)

    (found,) = unused(docs, "found")
    names = ["lang_pred", "score", *["segments"] * segments]
    rows = docs.drop(*names).withColumn(found, run(F.col(text)))
    return rows.select("*", *(F.col(f"{found}.{n}") for n in names)).drop(found)
