"""Quality rules by robust multivariate outliers.

Fixed rules reject a text first. Of the texts that pass them every language and source gets its own
minimum-covariance-determinant estimate of where their statistics lie. Several starts (medians and spreads, spatial signs,
squashed scores, a drawn subset) take concentration steps, each of which keeps the ``CORE`` share of texts that lie closest and
estimates centre and covariance anew from these. The start whose covariance has the smallest determinant goes on until its
determinant falls no more. A text whose Mahalanobis distance is too large is an outlier. Texts of groups too small for an
estimate are judged by that of their language, or of all texts where that is small too.

All of it is grouped sums over one narrow row per text. Medians and the reach of the core come from counts in fine bins, so
no group, however large, has to be sorted or held in one task, and reruns agree.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quartzo.llm.common import blank_words, identified, stored, unused

#: The symbols that count.
SYMBOLS = "#*$%&|<>"
#: Share of texts that the estimate rests on; texts a group must have for an estimate of its own.
CORE, LEAST = 0.75, 40
#: Concentration steps of every start; steps at most of the best one, and the fall of a log determinant that counts as one.
TRIALS, STEPS, FALL = 2, 20, 1e-4
#: One text in so many is drawn for the start from a subset.
DRAWN = 8
#: Squared distance of an outlier: far beyond the chi-square tail with 5 degrees, as the tails of texts are heavier.
CUTOFF = 90.0
#: Standard deviation of each statistic at least, so a statistic that hardly varies doesn't condemn small changes.
FLOORS = {"length": 0.5, "word": 0.1, "symbols": 0.3, "lines": 0.05, "repeats": 0.08}
#: Bins for each unit of a statistic and for each doubling of a squared distance.
FINE, PER_DOUBLING = 100, 16
POS_BITS = 24
#: Parts into which the rows of every group are dealt wherever they meet their group's estimate.
PARTS = 32


def _repeat_places(words: str) -> tuple[Column, Column]:
    """Places of 3-word windows that are found again, in two steps: packed hashes in order, then places.

    A packed value is 40 bits of a window's hash and its place, so one quick sort of longs brings equal windows together.
    """
    w = F.col(words)
    zipped = F.arrays_zip(w.alias("a"), F.slice(w, 2, F.greatest(F.size(w), F.lit(1))).alias("b"), F.slice(w, 3, F.greatest(F.size(w), F.lit(1))).alias("c"))
    place = F.lit((1 << POS_BITS) - 1)
    packed = F.transform(F.slice(zipped, 1, F.greatest(F.size(w) - 2, F.lit(0))), lambda z, i: F.xxhash64(z["a"], z["b"], z["c"]).bitwiseAND(~((1 << POS_BITS) - 1)).bitwiseOR(i.cast("long")))
    head = lambda x: F.shiftright(x, POS_BITS)
    again = F.filter("packed", lambda x, j: (head(F.get("packed", j - 1)) == head(x)) | (head(F.get("packed", j + 1)) == head(x)))
    return F.sort_array(packed), F.transform(F.coalesce(again, F.array().cast("array<bigint>")), lambda x: x.bitwiseAND(place).cast("int"))


def _statistics(rows: DataFrame, text: Column) -> DataFrame:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of the column; other columns stay."""
    text = F.coalesce(text, F.lit(""))
    bare = reduce(lambda t, s: F.replace(t, F.lit(s), F.lit("")), SYMBOLS, text)
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\v\f\r")) != "")
    kept = rows.columns
    df = rows.select("*", blank_words(text).alias("words"), (F.char_length(text) - F.char_length(bare)).cast("long").alias("n_symbols"), lines.alias("lines"))
    df = df.select(*kept, "words", "n_symbols", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))
    packed, places = _repeat_places("words")
    df = df.withColumn("packed", packed).withColumn("places", places)
    # exact whatever the hashes do: equal heads must be equal windows, else (or beyond 24 bits of places) windows are sorted themselves
    window = lambda p: F.struct(F.get("words", p).alias("a"), F.get("words", p + 1).alias("b"), F.get("words", p + 2).alias("c"))
    head = lambda p: F.xxhash64(F.get("words", p), F.get("words", p + 1), F.get("words", p + 2)).bitwiseAND(~((1 << POS_BITS) - 1))
    mixed = F.exists(F.transform("places", lambda p, j: F.when((j > 0) & (head(p) == head(F.get("places", j - 1))), window(p) != window(F.get("places", j - 1)))), lambda x: F.coalesce(x, F.lit(False)))
    starts = F.sequence(F.lit(0), F.size("words") - 3)
    slow = F.array_sort(F.transform(starts, lambda p: F.struct(window(p).alias("w"), p.alias("p"))))
    df = df.withColumn("slow", F.when((F.size("words") > 3) & (mixed | (F.size("words") > 1 << POS_BITS)), slow))
    sure = F.transform(F.filter("slow", lambda x, j: (F.get("slow", j - 1)["w"] == x["w"]) | (F.get("slow", j + 1)["w"] == x["w"])), lambda x: x["p"])
    df = df.withColumn("places", F.sort_array(F.when(F.col("slow").isNotNull(), sure).otherwise(F.col("places"))))
    steps = F.transform("places", lambda p, j: F.least(F.lit(3), F.coalesce(F.get("places", j + 1) - p, F.lit(3))))
    return df.select(
        *kept, F.size("words").cast("long").alias("n_words"), F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"), "n_symbols", "n_dup_lines",
        F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + x).alias("n_repeat_words"),
    )


def _vector() -> dict[str, Column]:
    """Transformed statistics, on scales where ordinary texts are roughly bell-shaped."""
    share = lambda c: F.col(c) / F.greatest(F.col("n_words"), F.lit(1))
    return {
        "length": F.log1p(F.col("n_words").cast("double")), "word": F.log(F.greatest(share("word_chars"), F.lit(0.1))), "symbols": F.log1p(100 * share("n_symbols")),
        "lines": F.sqrt(share("n_dup_lines")), "repeats": F.sqrt(share("n_repeat_words")),
    }


def _reach(counts: DataFrame, by: list[str], share: float) -> DataFrame:
    """The first bin up to which a group has at least ``share`` of its rows; ``counts``: by, bin, n."""
    run = Window.partitionBy(*by).orderBy("bin")
    whole = Window.partitionBy(*by)
    seen = counts.withColumns({"seen": F.sum("n").over(run), "all": F.sum("n").over(whole)})
    return seen.where(F.col("seen") >= F.ceil(F.col("all") * share)).groupBy(*by).agg(F.min("bin").alias("bin"))


def _medians(long: DataFrame) -> DataFrame:
    """Of the column x, by g and dim."""
    counts = long.groupBy("g", "dim", F.floor(F.col("x") * FINE).alias("bin")).agg(F.count("*").alias("n"))
    return _reach(counts, ["g", "dim"], 0.5).select("g", "dim", ((F.col("bin") + 0.5) / FINE).alias("median"))


def _start(rows: DataFrame, dims: list[str]) -> DataFrame:
    """g, centre and factor (its covariance's lower triangle) from medians and median deviations."""
    each = F.explode(F.array(*(F.struct(F.lit(d).alias("dim"), F.col(d).alias("x")) for d in dims))).alias("e")
    long = rows.select("g", "part", each).select("g", "part", "e.dim", "e.x")
    centre = _medians(long)
    spread = _medians(_beside(long, centre, ("g", "dim")).select("g", "dim", F.abs(F.col("x") - F.col("median")).alias("x"))).withColumnRenamed("median", "mad")
    floors = F.create_map(*(F.lit(x) for pair in FLOORS.items() for x in pair))
    both = centre.join(spread, ["g", "dim"]).withColumn("sd", F.greatest(1.4826 * F.col("mad"), floors[F.col("dim")]))
    picked = lambda c, d: F.max(F.when(F.col("dim") == d, F.col(c)))
    out = both.groupBy("g").agg(*(picked("median", d).alias(f"m_{d}") for d in dims), *(picked("sd", d).alias(f"s_{d}") for d in dims))
    zero = F.lit(0.0)
    return out.select("g", *(f"m_{d}" for d in dims), *((F.col(f"s_{a}") if a == b else zero).alias(f"l_{a}_{b}") for i, a in enumerate(dims) for b in dims[: i + 1]))


def _squared(dims: list[str]) -> Column:
    """Squared Mahalanobis distance: forward substitution with the Cholesky factor l."""
    solved: list[Column] = []
    for i, a in enumerate(dims):
        rest = reduce(lambda s, j: s - F.col(f"l_{a}_{dims[j]}") * solved[j], range(i), F.col(a) - F.col(f"m_{a}"))
        solved.append(rest / F.col(f"l_{a}_{a}"))
    return reduce(lambda s, y: s + y * y, solved, F.lit(0.0))


def _estimate(core: DataFrame, dims: list[str]) -> DataFrame:
    """Mean, Cholesky factor of the covariance, whose variances get their floors, and half its log determinant, by g."""
    pairs = [(a, b) for i, a in enumerate(dims) for b in dims[: i + 1]]
    sums = core.groupBy("g").agg(*(F.avg(d).alias(f"m_{d}") for d in dims), *(F.covar_pop(a, b).alias(f"c_{a}_{b}") for a, b in pairs))
    for i, a in enumerate(dims):
        for j, b in enumerate(dims[: i + 1]):
            rest = reduce(lambda s, c: s - F.col(f"l_{a}_{c}") * F.col(f"l_{b}_{c}"), dims[:j], F.col(f"c_{a}_{b}"))
            sums = sums.withColumn(f"l_{a}_{b}", F.sqrt(F.greatest(rest, F.lit(FLOORS[a] ** 2))) if i == j else rest / F.col(f"l_{b}_{b}"))
    # the determinant is the product of the squared diagonal; rounded, so the order of sums doesn't choose between equal ones
    spread = F.round(reduce(lambda s, d: s + F.log(F.col(f"l_{d}_{d}")), dims, F.lit(0.0)), 6)
    return sums.select("g", *(f"m_{d}" for d in dims), *(f"l_{a}_{b}" for a, b in pairs), spread.alias("spread"))


def _begun(start: str) -> Column:
    return F.struct("g.level", "g.lang", "g.source", F.lit(start).alias("start")).alias("g")


def _starts(rows: DataFrame, dims: list[str]) -> DataFrame:
    """First estimates of every group, g being (level, lang, source, start).

    middle: medians and median deviations. signs: covariance of directions from the medians. squashed: of the hyperbolic
    tangents of scores. drawn: of one text in ``DRAWN``, by a hash. All are moved back to medians and deviations' scale.
    """
    middle = stored(_start(rows, dims))
    placed = _beside(rows, middle)
    scores = {d: (F.col(d) - F.col(f"m_{d}")) / F.col(f"l_{d}_{d}") for d in dims}
    length = F.greatest(F.sqrt(reduce(lambda s, z: s + z * z, scores.values(), F.lit(0.0))), F.lit(1e-9))
    back = lambda d, u: (F.col(f"m_{d}") + F.col(f"l_{d}_{d}") * u).alias(d)
    moved = {
        "signs": placed.select(_begun("signs"), *(back(d, z * len(dims) ** 0.5 / length) for d, z in scores.items())),
        "squashed": placed.select(_begun("squashed"), *(back(d, F.tanh(z) * 1.6) for d, z in scores.items())),
        "drawn": rows.where(F.pmod(F.xxhash64("row", F.lit(1)), F.lit(DRAWN)) == 0).select(_begun("drawn"), *dims),
    }
    fits = _estimate(reduce(DataFrame.unionByName, moved.values()), dims).drop("spread")
    return middle.withColumn("g", _begun("middle")).unionByName(fits)


def _step(rows: DataFrame, fit: DataFrame, dims: list[str]) -> DataFrame:
    """A concentration step: the estimate of the ``CORE`` share of each group that ``fit`` has closest, in bins of distance."""
    distances = _bins(_beside(rows, fit).withColumn("d2", _squared(dims)).select("g", "part", *dims, "d2"))
    reach = _reach(distances.groupBy("g", "bin").agg(F.count("*").alias("n")), ["g"], CORE).withColumnRenamed("bin", "last")
    return _estimate(_beside(distances, reach).where("bin <= last"), dims)


def _least(fits: DataFrame) -> DataFrame:
    """The estimate of the smallest determinant of every group."""
    rest = [c for c in fits.columns if c not in ("g", "spread")]
    return fits.groupBy("g").agg(F.min(F.struct("spread", *rest)).alias("f")).select("g", "f.*")


def _concentrated(rows: DataFrame, dims: list[str]) -> DataFrame:
    """The estimate of every group, with the start it came from; ``rows``: row, g, part and the statistics."""
    fit = stored(_starts(rows, dims))
    kinds = F.explode(F.array(*(F.lit(s) for s in ("middle", "signs", "squashed", "drawn")))).alias("start")
    trials = rows.select("*", kinds).withColumn("g", F.struct("g.level", "g.lang", "g.source", "start"))
    for _ in range(TRIALS):
        fit = stored(_step(trials, fit, dims))
    best = stored(_least(fit.withColumn("start", F.col("g.start")).withColumn("g", F.struct("g.level", "g.lang", "g.source"))))
    moving = best
    for _ in range(STEPS):
        after = _step(rows, moving.drop("start", "spread"), dims).join(moving.select("g", "start", F.col("spread").alias("was")), "g")
        moving = stored(after.where(F.col("spread") < F.col("was") - FALL).drop("was"))
        if moving.isEmpty():
            break
        best = stored(_least(best.unionByName(moving)))
    return best


def _beside(rows: DataFrame, estimates: DataFrame, by: tuple[str, ...] = ("g",)) -> DataFrame:
    """Join one row per group to all its rows, dealt by group and part, so no large group meets in one task."""
    parts = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part")
    return rows.join(estimates.select("*", parts), [*by, "part"])


def _bins(distances: DataFrame) -> DataFrame:
    place = F.floor(PER_DOUBLING * F.log2(F.col("d2") + 1e-3)).cast("int")
    return distances.withColumn("bin", place)


def _populations(rows: DataFrame) -> DataFrame:
    """``rows`` (row, g, ...) for every group whose estimate is needed: g is (level, lang, source), asks tells which judges a row.

    Level 0 is a language and source of ``LEAST`` texts or more. Level 1 is a language with a smaller source, if it has as
    many texts; its estimate rests on all of them. Level 2 is all texts, if a language has fewer.
    """
    rows = rows.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(PARTS)).cast("int")).withColumn("l", F.struct("g.lang"))
    counts = stored(rows.groupBy("g", "l").agg(F.count_if("sound").alias("count")))
    langs = stored(counts.groupBy("l").agg(F.sum("count").alias("texts"), F.min("count").alias("least")).where(F.col("least") < LEAST))
    all_too = not langs.where(F.col("texts") < LEAST).isEmpty()
    parts = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part")
    rows = rows.join(counts.where(F.col("count") >= LEAST).select("g", F.lit(True).alias("own"), parts), ["g", "part"], "left")
    rows = rows.join(langs.select("l", (F.col("texts") >= LEAST).alias("wide"), parts), ["l", "part"], "left")
    own, wide = F.coalesce("own", F.lit(False)), F.coalesce("wide", F.lit(False))
    group = lambda level, lang, source, asks: F.struct(F.struct(F.lit(level).alias("level"), lang.alias("lang"), source.alias("source")).alias("g"), asks.alias("asks"))
    none = F.lit(None).cast("string")
    levels = F.array(
        F.when(own, group(0, F.col("g.lang"), F.col("g.source"), own)), F.when(wide, group(1, F.col("g.lang"), none, ~own)),
        F.when(F.lit(all_too), group(2, none, none, ~own & ~wide)),
    )
    rows = rows.withColumn("p", F.explode(F.array_compact(levels)))
    return rows.withColumn("g", F.col("p.g")).withColumn("asks", F.col("p.asks")).drop("l", "own", "wide", "p")


def _judged(rows: DataFrame, dims: list[str]) -> DataFrame:
    """row, level of the group that judges it, and distance (squared). ``rows``: row, g, sound (estimates rest on it) and the statistics."""
    judged = stored(_populations(rows))
    fit = _concentrated(judged.where("sound"), dims).drop("start", "spread")
    distances = _beside(judged, fit).select("row", "g", "part", "asks", "sound", _squared(dims).alias("d2"))
    # the core's covariance is too small by a factor; the median distance, 4.35 for five statistics, shows it
    middle = _reach(_bins(distances.where("sound")).groupBy("g", "bin").agg(F.count("*").alias("n")), ["g"], 0.5)
    scale = middle.select("g", F.greatest(F.lit(1.0), F.pow(F.lit(2.0), (F.col("bin") + 0.5) / PER_DOUBLING) / 4.35).alias("scale"))
    return _beside(distances.where("asks"), scale).select("row", F.col("g.level").alias("level"), (F.col("d2") / F.col("scale")).alias("distance"))


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """All rows and columns, with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, distance, wider_distance and kept.

    base_failed: under 50 words, or over half of them in 3-word windows that the text has twice. distance: squared
    Mahalanobis distance within the text's language and source, null in groups of under ``LEAST`` texts that aren't
    base_failed. wider_distance: theirs within the texts of the language, or within all texts where the language has under
    ``LEAST`` too. Every text with a word has one of the two, unless all texts are base_failed: no estimate rests on these. kept: not base_failed, and no distance above ``CUTOFF``. Null texts have no words; null
    languages and sources are groups like any other. Repeated rows get equal results. Columns of the same names are replaced.
    """
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", "wider_distance", "kept"]
    docs = docs.drop(*added)
    (rid,) = unused(docs, "row")
    whole = identified(docs, rid)
    group = F.struct(F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source")).alias("g")
    found = stored(_statistics(whole.select(F.col(rid).alias("row"), group, F.col(text).alias("said")), F.col("said")).drop("said"))
    vector = _vector()
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    distances = _judged(found.where("n_words > 0").select("row", "g", (~failed).alias("sound"), *(v.alias(d) for d, v in vector.items())), list(vector))
    out = found.join(distances, "row", "left").withColumn("base_failed", failed)
    out = out.withColumn("kept", ~failed & (F.coalesce("distance", F.lit(0.0)) <= CUTOFF)).withColumnRenamed("row", "found_row")
    out = out.withColumn("wider_distance", F.when(F.col("level") > 0, F.col("distance"))).withColumn("distance", F.when(F.col("level") == 0, F.col("distance")))
    return whole.join(out, F.col(rid) == F.col("found_row")).select(*(F.col(f"`{c}`") for c in docs.columns), *added)
