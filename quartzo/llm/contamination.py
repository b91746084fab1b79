"""Benchmark decontamination over a positional inverted index.

Terms are counted first. Of every window of an item the two rarest terms are its anchors, and the index holds a posting
(term, row, position) for every word of the documents that is the anchor of some window: no other posting is ever read.
Postings moved back by their offsets in the item meet on (row, item, diagonal). Where two meet, the words of the document are
compared with the item's along that diagonal, and every window that agrees word by word is an exact match. Where many meet on
neighbouring diagonals, words were added or left out: a proximity match. Documents lie in blocks of ``BLOCK`` words for the
comparison, so a diagonal meets the blocks that its item reaches over, never a whole long text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartzo.llm.common import Work, alnum_words, identified, stored, unused, work

#: Words of a window; diagonals that count as neighbours, and the share of an item's looked-up words that must meet on them.
WINDOW, SLOP, NEAR = 13, 8, 0.5
#: Words of a document's block.
BLOCK = 256


def _items(benchmark: DataFrame, text: str, item_id: str) -> DataFrame:
    """item (a number of the row), item_id, item_words, width (words of its windows); items without a word are left out."""
    items = benchmark.select(F.col(item_id).alias("item_id"), alnum_words(F.col(text)).alias("item_words")).where(F.size("item_words") > 0)
    return items.withColumns({"item": F.monotonically_increasing_id(), "width": F.least(F.lit(WINDOW), F.size("item_words"))})


def _anchors(items: DataFrame, counts: DataFrame) -> DataFrame:
    """(term, item, at, width, anchors): the two rarest words of every window, ties by their place."""
    words = items.select("item", "width", F.posexplode("item_words").alias("at", "word")).withColumn("term", F.xxhash64("word"))
    words = words.join(counts, "term", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    lists = words.groupBy("item", "width").agg(F.sort_array(F.collect_list(F.struct("at", "count", "term"))).alias("words"))
    starts = F.sequence(F.lit(0), F.size("words") - F.col("width"))

    def rarest(start: Column) -> Column:
        window = F.slice("words", start + 1, F.col("width"))
        return F.slice(F.sort_array(F.transform(window, lambda w: F.struct(w["count"].alias("count"), w["at"].alias("at"), w["term"].alias("term")))), 1, 2)

    chosen = lists.withColumn("chosen", F.array_distinct(F.flatten(F.transform(starts, rarest))))
    each = chosen.select("item", "width", F.size("chosen").alias("anchors"), F.explode("chosen").alias("c"))
    return each.select("c.term", "item", "c.at", "width", "anchors")


def _aligned(diagonals: DataFrame, tokens: DataFrame) -> DataFrame:
    """Compare items with documents: row, item_id, width, same (does each word agree) and diagonal, the document's place of the first of ``same``.

    ``diagonals``: row, item, item_id, item_words, width, diagonal. A text's blocks are sent once, an item's words to each
    block they reach; a group is one item on one diagonal, as long as the item.
    """
    words = F.split("said", " ")
    texts = tokens.join(diagonals.select("row").distinct(), "row", "left_semi").select("row", words.alias("words"))
    cuts = F.transform(F.sequence(F.lit(0), F.size("words") - 1, F.lit(BLOCK)), lambda at: F.slice("words", at + 1, BLOCK))
    blocks = texts.select("row", F.posexplode(cuts).alias("block", "words"))
    reach = F.sequence(F.floor(F.greatest("diagonal", F.lit(0)) / BLOCK).cast("int"), F.floor((F.col("diagonal") + F.size("item_words") - 1) / BLOCK).cast("int"))
    met = diagonals.select("*", F.explode(reach).alias("block")).join(blocks, ["row", "block"])
    shift = F.col("diagonal") - F.col("block") * BLOCK
    met = met.select("*", F.greatest(F.lit(0), -shift).alias("low"), F.least(F.size("item_words"), F.size("words") - shift).alias("high")).where("low < high")
    same = F.transform(F.sequence(F.col("low"), F.col("high") - 1), lambda i: F.get("words", shift + i) == F.get("item_words", i))
    pieces = met.select("row", "item", "item_id", "width", "diagonal", F.struct("low", same.alias("same")).alias("piece"))
    lined = pieces.groupBy("row", "item", "item_id", "width", "diagonal").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    return lined.select("row", "item_id", "width", (F.col("diagonal") + F.get("pieces", F.lit(0))["low"]).alias("diagonal"), F.flatten("pieces.same").alias("same"))


def _covered(same: Column, width: Column, diagonal: Column) -> Column:
    """Places in the document that exact windows cover."""
    starts = F.sequence(F.lit(0), F.size(same) - width)
    full = F.filter(starts, lambda s: F.forall(F.slice(same, s + 1, width), lambda x: x))
    return F.array_distinct(F.flatten(F.transform(full, lambda s: F.sequence(diagonal + s, diagonal + s + width - 1))))


def _matches(w: Work, rows: DataFrame, benchmark: DataFrame, text: str, bench_text: str, item_id: str) -> DataFrame:
    """One row per document row: row, n_words, n_hit, items (sorted as strings), near_items."""
    # words are stored and sent joined by blanks, which no word has: half the bytes of an array
    split = rows.select("row", alnum_words(F.col(text)).alias("words"))
    tokens = w.write(split.select("row", F.size("words").cast("long").alias("n_words"), F.array_join("words", " ").alias("said")), "tokens")
    words = F.split("said", " ")
    items = w.write(_items(benchmark, bench_text, item_id), "items")
    used = items.select(F.explode("item_words").alias("word")).select(F.xxhash64("word").alias("term")).distinct()
    # counted before it is joined, so what a shuffle may carry is a row per term and task, not per word
    terms = tokens.where("n_words > 0").select(F.explode(words).alias("word")).groupBy(F.xxhash64("word").alias("term")).agg(F.count("*").alias("count"))
    anchors = w.write(_anchors(items, terms.join(used, "term", "left_semi")), "anchors")
    postings = tokens.where("n_words > 0").select("row", F.posexplode(words).alias("at", "word")).select(F.xxhash64("word").alias("term"), "row", "at")
    postings = w.write(postings.join(anchors.select("term").distinct(), "term", "left_semi"), "postings")
    moved = postings.withColumnRenamed("at", "doc_at").join(anchors, "term")
    votes = moved.groupBy("row", "item", "width", "anchors", (F.col("doc_at") - F.col("at")).alias("diagonal")).agg(F.count("*").alias("votes"))
    votes = w.write(votes, "votes")
    diagonals = votes.where(F.col("votes") >= F.least(F.lit(2), F.col("width"))).join(items.drop("width"), "item")
    lined = w.write(_aligned(diagonals.select("row", "item", "item_id", "item_words", "width", "diagonal"), tokens), "lined").where(F.size("same") >= F.col("width"))
    hits = w.write(lined.select("row", "item_id", _covered(F.col("same"), F.col("width"), F.col("diagonal")).alias("places")), "hits")
    hits = hits.where(F.size("places") > 0)
    n_hit = hits.select("row", F.explode("places").alias("place")).distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    found = hits.groupBy("row").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    band = F.explode(F.array(F.floor(F.col("diagonal") / SLOP) * 2, F.floor(F.col("diagonal") / SLOP + 0.5) * 2 - 1)).alias("band")
    near = votes.select("row", "item", "anchors", "votes", band).groupBy("row", "item", "anchors", "band").agg(F.sum("votes").alias("votes"))
    near = near.where((F.col("votes") >= 2) & (F.col("votes") >= NEAR * F.col("anchors"))).join(items.select("item", "item_id"), "item")
    near = near.groupBy("row").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("near_items"))
    empty = F.array().cast("array<string>")
    out = tokens.select("row", "n_words").join(n_hit, "row", "left").join(found, "row", "left").join(near, "row", "left")
    return out.select("row", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", empty).alias("items"), F.coalesce("near_items", empty).alias("near_items"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", bench_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """All rows and columns of ``docs``, with n_words, n_hit, items, near_items and contaminated.

    Texts are lower-cased A-Z; words are runs of letters, digits and characters above ASCII. A window is 13 consecutive words
    of an item, or the whole item if it has fewer. n_hit: words inside any exact window; items: ids of the items with an
    exact window, near_items: of those with a proximity match (exact ones are among them as a rule), sorted as strings.
    contaminated: n_hit > 0 and 20 * n_hit >= n_words. Null and empty documents have no words; items without words and
    null item ids match nothing that is reported by id, though a null id's windows count as hits. Repeated rows get equal
    results; repeated items count once by id. Columns of the same names are replaced.
    """
    added = ["n_words", "n_hit", "items", "near_items", "contaminated"]
    docs = docs.drop(*added)
    (rid,) = unused(docs, "row")
    whole = identified(docs, rid)
    with work(docs.sparkSession) as w:
        found = stored(_matches(w, whole.select(F.col(rid).alias("row"), F.col(text).alias("words")), benchmark, "words", bench_text, item_id))
    bad = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    found = found.withColumn("contaminated", bad).withColumnRenamed("row", "found_row")
    return whole.join(found, F.col(rid) == F.col("found_row")).select(*(F.col(f"`{c}`") for c in docs.columns), *added)
