"""License scans by diagonal voting.

Every pair of neighbouring words of every document is hashed and joined to the pairs of the templates. A hit votes for the
diagonal (place in the document less place in the template). Hits on neighbouring diagonals make a span, so a few added or
missing words don't break it. Every span is verified: its hits stand in the wording's order and near its first diagonal,
enough of the wording is seen, the words that tell it from similar wordings are there, and no better wording overlaps it.
Base phrases must stand word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quartzo.llm.common import alnum_words, identified, stored, unused

#: Phrases of the contract and their labels.
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]
#: Wordings that the method looks for besides, and their labels.
WORDINGS = [
    ("licensed under the apache license version 2 0", "apache"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("licensed under the gnu general public license version", "gnu"),
    ("licensed under cc by nc", "cc-by-nc"),
    ("licensed under cc by sa", "cc-by-sa"),
    ("licensed under a creative commons attribution", "creative-commons"),
    ("spdx license identifier", "spdx"),
]
#: Diagonals that a hit may lie from its span's first one; share of a wording's pairs that must be seen.
APART, SEEN = 3, 0.75


def needed(phrase: str, label: str) -> list[int]:
    """Places of the words that tell a wording from those of other labels that have enough of its pairs to pass for it."""
    words = phrase.split()
    pairs = list(zip(words, words[1:]))
    needs = set()
    for other in (p.split() for p, s in WORDINGS if s != label):
        if sum(pair in zip(other, other[1:]) for pair in pairs) >= SEEN * len(pairs):
            needs |= {i for i, w in enumerate(words) if w not in other}
    return sorted(needs)


def templates(spark: SparkSession) -> DataFrame:
    """One row per pair of neighbouring words of a template: a fixed list, whatever the input."""
    rows = []
    for t, (phrase, label, base) in enumerate([(p, s, True) for p, s in BASE] + [(p, s, False) for p, s in WORDINGS]):
        words, needs = phrase.split(), [] if base else needed(phrase, label)
        rows += [(t, i, a, b, len(words) - 1, label, base, needs) for i, (a, b) in enumerate(zip(words, words[1:]))]
    pairs = spark.createDataFrame(rows, "t int, t_at int, t_left string, t_right string, pairs int, label string, base boolean, needs array<int>")
    return pairs.withColumn("gram", F.xxhash64("t_left", "t_right"))


def telling(spark: SparkSession) -> DataFrame:
    """One row per word that tells a wording apart."""
    rows = [(w, len(BASE) + t, i) for t, (p, s) in enumerate(WORDINGS) for i, w in enumerate(p.split()) if i in needed(p, s)]
    return spark.createDataFrame(rows, "telling string, t int, t_at int")


def _hits(rows: DataFrame, text: Column) -> DataFrame:
    """row, n_words and the hits (t, t_at, at, pairs, label, base, needs); each row comes at least once, without a hit t is null.

    telling: the word at ``at`` if it tells wordings apart, whether or not a hit is there.
    """
    words = rows.select("row", alnum_words(text).alias("words"))
    neighbours = F.arrays_zip(F.col("words").alias("left"), F.slice("words", 2, F.greatest(F.size("words"), F.lit(1))).alias("right"))
    each = words.select("row", F.size("words").alias("n_words"), F.posexplode_outer(neighbours).alias("at", "pair"))
    each = each.select("row", "n_words", "at", F.col("pair.left").alias("left"), F.col("pair.right").alias("right"))
    each = each.withColumn("gram", F.xxhash64("left", "right"))
    same = (each["gram"] == F.col("t_gram")) & (F.col("left") == F.col("t_left")) & (F.col("right") == F.col("t_right"))
    found = each.join(F.broadcast(templates(rows.sparkSession).withColumnRenamed("gram", "t_gram")), same, "left")
    marks = {p.split()[i] for p, s in WORDINGS for i in needed(p, s)}
    found = found.withColumn("telling", F.when(F.col("left").isin(*sorted(marks)), F.col("left")))
    found = found.where(F.col("t").isNotNull() | F.col("telling").isNotNull() | F.col("at").isNull() | (F.col("at") == 0))
    return found.select("row", "n_words", "at", "t", "t_at", "pairs", "label", "base", "needs", "telling")


def _verified(hits: DataFrame) -> DataFrame:
    """row, label, share, start and end of the wordings that stand in the documents.

    From each hit the longest chain of hits that rise in the document and in the wording and lie within ``APART`` of the
    first one's diagonal, so a span has ``APART`` words more than its wording at most, and a step sees no more than that.
    """
    marks = hits.join(F.broadcast(telling(hits.sparkSession).withColumnsRenamed({"t": "w", "t_at": "w_at"})), "telling").select("row", F.col("w").alias("t"), "at", F.col("w_at").alias("t_at"))
    marks = marks.distinct()  # several hits may stand at a word
    points = hits.where("not base").drop("n_words", "base", "telling").unionByName(marks, allowMissingColumns=True)
    longest = max(len(p.split()) for p, _ in WORDINGS)
    ahead = Window.partitionBy("row", "t").orderBy("at").rangeBetween(0, longest + APART)
    near = F.collect_list(F.struct("at", "t_at", F.col("pairs").isNull().alias("mark"))).over(ahead)
    spans = points.withColumn("near", near).where("pairs is not null")
    close = lambda x: F.abs((x["at"] - x["t_at"]) - (F.col("at") - F.col("t_at"))) <= APART
    later = F.filter("near", lambda x: ~x["mark"] & (x["at"] > F.col("at")) & (x["t_at"] > F.col("t_at")) & close(x))
    later = F.transform(F.array_sort(later), lambda x: F.struct(x["at"].alias("at"), x["t_at"].alias("t_at")))
    spans = spans.withColumn("later", later).where((F.size(F.array_distinct(F.col("later.t_at"))) + 1) / F.col("pairs") >= SEEN)

    def chain(hits_: Column) -> Column:  # compared by length, then by an early end
        return F.struct(F.size(hits_).alias("n"), (-F.element_at(hits_, -1)["at"]).alias("early"), hits_.alias("hits"))

    def longer(chains: Column, x: Column) -> Column:
        before = F.filter(chains, lambda c: (F.element_at(c["hits"], -1)["t_at"] < x["t_at"]) & (F.element_at(c["hits"], -1)["at"] < x["at"]))
        return F.concat(chains, F.array(chain(F.concat(F.array_max(before)["hits"], F.array(x)))))

    first = F.array(F.struct("at", "t_at"))
    spans = spans.withColumn("best", F.array_max(F.aggregate("later", F.array(chain(first)), longer)))
    spans = spans.withColumn("share", F.col("best.n") / F.col("pairs")).where(F.col("share") >= SEEN)
    fits = lambda x: close(x) & F.forall("best.hits", lambda h: (h["t_at"] < x["t_at"]) == (h["at"] < x["at"]))
    places = F.transform("needs", lambda p: F.array_min(F.transform(F.filter("near", lambda x: x["mark"] & (x["t_at"] == p) & fits(x)), lambda x: x["at"])))
    spans = spans.withColumn("places", places).where(F.forall("places", lambda x: x.isNotNull()))
    end = F.greatest(2 - F.col("best.early"), F.coalesce(F.array_max("places") + 1, F.lit(0)))
    return _best(spans.select("row", "t", "label", "pairs", "share", F.col("at").cast("long").alias("start"), end.cast("long").alias("end")))


def _best(spans: DataFrame) -> DataFrame:
    """Of spans that overlap only the best stay: by share, then length of the wording, then place. Rows as before."""
    before = Window.partitionBy("row").orderBy("start", "end", "t")
    reach = F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("new", F.when(F.col("start") < reach, 0).otherwise(1))
    spans = spans.withColumn("island", F.sum("new").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("share")).alias("worse"), (-F.col("pairs")).alias("short"), "start", "t", "end", "label", "share")))
    islands = spans.groupBy("row", "island").agg(ranked.alias("ranked"))
    clear = lambda kept, x: ~F.exists(kept, lambda k: (k["start"] < x["end"]) & (x["start"] < k["end"]))
    kept = F.aggregate("ranked", F.slice("ranked", 1, 1), lambda kept, x: F.when(clear(kept, x), F.concat(kept, F.array(x))).otherwise(kept))
    return islands.select("row", F.explode(kept).alias("s")).select("row", "s.label", "s.share", "s.start", "s.end")


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows and columns, with n_words, n_base, first_word, last_word, base_labels, labels, score and spans.

    Words are runs of letters, digits and characters above ASCII, lower-cased A-Z. n_base: places where a base phrase stands;
    first_word, last_word: smallest and largest start of these, null if there is none. labels: those of all verified spans.
    spans: (label, start, end, score) in words. score: the best share of a template that was seen, 0 without a span. Null and
    empty texts have no words. Repeated rows get equal results. Columns of the same names are replaced.
    """
    added = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    docs = docs.drop(*added)
    (rid,) = unused(docs, "row")
    whole = identified(docs, rid)
    hits = stored(_hits(whole.select(F.col(rid).alias("row"), F.col(text).alias("words")), F.col("words")))
    sizes = hits.groupBy("row").agg(F.max("n_words").cast("long").alias("n_words"))
    diagonal = (F.col("at") - F.col("t_at")).alias("diagonal")
    phrases = hits.where("base").groupBy("row", "t", "label", "pairs", diagonal).agg(F.count_distinct("t_at").alias("seen"), F.min("at").cast("long").alias("start"), (F.max("at") + 2).cast("long").alias("end"))
    phrases = phrases.where("seen = pairs").select("row", "label", F.lit(1.0).alias("share"), "start", "end", F.lit(True).alias("base"))
    spans = phrases.unionByName(_verified(hits).withColumn("base", F.lit(False)))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    found = spans.groupBy("row").agg(
        F.count(F.when(F.col("base"), 1)).alias("n_base"), F.min(F.when(F.col("base"), F.col("start"))).alias("first_word"), F.max(F.when(F.col("base"), F.col("start"))).alias("last_word"),
        joined(F.when(F.col("base"), F.col("label"))).alias("base_labels"), joined(F.col("label")).alias("labels"), F.max("share").alias("score"),
        F.array_sort(F.collect_list(F.struct("start", "end", "label", F.col("share").alias("score")))).alias("spans"),
    )
    out = sizes.join(found, "row", "left").fillna({"n_base": 0, "base_labels": "", "labels": "", "score": 0.0})
    out = out.withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint,label:string,score:double>>")))
    out = out.withColumnRenamed("row", "found_row")
    return whole.join(out, F.col(rid) == F.col("found_row")).select(*(F.col(f"`{c}`") for c in docs.columns), *added)
