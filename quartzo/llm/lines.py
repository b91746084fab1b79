"""Boilerplate lines by their frequency within a site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartzo.llm.common import unused

#: A line is boilerplate if more than this share of its host's pages contain it, and no fewer pages than this.
RATIO, PAGES = 0.2, 3
#: Parts into which the pages of every host are dealt where they meet their host's boilerplate.
PARTS = 32


def host_of(url: Column) -> Column:
    """Lower-cased host without user and port; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    return F.when(host != "", host)


def lines_of(html: Column) -> Column:
    """Visible lines of a page: scripts, styles and comments go, every other tag ends a line; trimmed, never empty."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->", "\n")
    text = F.regexp_replace(text, r"<[^>]*>|[\t\r]+", "\n")
    return F.array_remove(F.transform(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" "))), "")


def boilerplate(pages: DataFrame, ratio: float = RATIO, least: int = PAGES) -> DataFrame:
    """host and boilerplate: its lines on over ``ratio`` of its pages.

    ``pages``: host, lines. A line counts once a page. If a host's pages have m different lines on average, under m / ratio
    lines can be on so many of them; so the list of a host is bounded by its pages' length, not by their number.
    """
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    each = pages.select("host", F.explode(F.array_distinct("lines")).alias("line"))
    counts = each.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    frequent = counts.join(totals.withColumnRenamed("host", "of"), F.col("host").eqNullSafe(F.col("of")))
    return frequent.where(F.col("n") > ratio * F.col("pages")).groupBy("host").agg(F.collect_list("line").alias("boilerplate"))


def drop_boilerplate(pages: DataFrame, url: str = "url", html: str = "html", ratio: float = RATIO, least: int = PAGES) -> DataFrame:
    """All rows and columns, with host, n_lines, n_dropped and kept_text (the other lines, joined by line feeds).

    Pages without a host (null or odd urls) are a site of their own. Null and empty pages have no lines but count as pages;
    so do repeated rows. An empty table gives an empty result. Columns of the same names are replaced.
    """
    added = ["host", "n_lines", "n_dropped", "kept_text"]
    pages = pages.drop(*added)
    lines, drop, of, part, parts = unused(pages, "lines", "boilerplate", "of", "part", "parts")
    rows = pages.withColumns({"host": host_of(F.col(url)), lines: lines_of(F.col(html))})
    bad = boilerplate(rows.select("host", F.col(lines).alias("lines")), ratio, least).select(F.col("host").alias(of), F.col("boilerplate").alias(drop))
    # a host's short list goes to every part, so the pages of a large host don't meet in one task
    bad = bad.withColumn(parts, F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    rows = rows.withColumn(part, F.pmod(F.monotonically_increasing_id(), F.lit(PARTS)).cast("int"))
    rows = rows.join(bad, F.col("host").eqNullSafe(F.col(of)) & (F.col(part) == F.col(parts)), "left")
    (free,) = unused(rows, "free")
    rows = rows.withColumn(free, F.size(F.array_except(lines, drop)))  # hashed, so pages that are all or no boilerplate are quick
    some = F.filter(lines, lambda x: ~F.array_contains(drop, x))
    kept = F.when(F.col(free).isNull() | (F.col(free) == F.size(F.array_distinct(lines))), F.col(lines)).when(F.col(free) == 0, F.array().cast("array<string>")).otherwise(some)
    rows = rows.withColumn(of, kept)
    return rows.select(
        *(F.col(f"`{c}`") for c in pages.columns), "host", F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(of)).cast("long").alias("n_dropped"), F.array_join(of, "\n").alias("kept_text"),
    )
