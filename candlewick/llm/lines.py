"""Line deduplication by site-relative frequency, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.text import scratch, store

#: A line is boilerplate on more than this share of a host's pages; what one page only has is no repeat.
RATIO, LEAST_PAGES = 0.1, 2

HOST = "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
MARKUP = "(?is)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->|<[^>]*>"


def url_host(url: Column) -> Column:
    """The host in lower case; null where there is none."""
    return F.nullif(F.lower(F.regexp_extract(url.cast("string"), HOST, 1)), F.lit(""))


def html_lines(html: Column) -> Column:
    """Text between tags as trimmed lines that aren't blank; scripts, styles and comments are left out."""
    text = F.regexp_replace(F.coalesce(html.cast("string"), F.lit("")), MARKUP, "\n")
    lines = F.transform(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(" \t\r\x0b\f")))
    return F.filter(lines, lambda line: line != "")


def boilerplate(rows: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """host, line, pages (of the host that have the line) and share, of lines above ``ratio``; from (host, lines)."""
    rows = rows.filter("host IS NOT NULL")
    totals = rows.groupBy("host").agg(F.count("*").alias("total"))
    frequent = (F.col("pages") >= least_pages) & (F.col("pages") > ratio * F.col("total"))
    # Counted by a hash of the line first: eight bytes to shuffle, and never less than the line's own count.
    hashes = F.array_distinct(F.transform("lines", lambda line: F.xxhash64(line)))
    candidates = (
        rows.select("host", F.explode(hashes).alias("hash"))
        .groupBy("host", "hash")
        .agg(F.count("*").alias("pages"))
        .filter(F.col("pages") >= least_pages)
        .join(totals, "host")
        .filter(frequent)
        .select("host", "hash", "total")
    )
    # Written first, so that its size is known when the join is planned: if it is small, no line is shuffled.
    candidates = store(candidates, f"{scratch(rows.sparkSession)}/candidates")
    return (
        rows.select("host", F.explode(F.array_distinct("lines")).alias("line"))
        .withColumn("hash", F.xxhash64("line"))
        .join(candidates, ["host", "hash"])
        .groupBy("host", "line")
        .agg(F.count("*").alias("pages"), F.max("total").alias("total"))
        .filter(frequent)
        .select("host", "line", "pages", (F.col("pages") / F.col("total")).alias("share"))
    )


def drop_boilerplate(pages: DataFrame, ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """page_id, host, n_lines, n_dropped and text (what remains, a line each) for each row of ``pages``.

    A host's boilerplate has at most (mean lines of a page) / ``ratio`` lines, so it fits a row.
    Pages whose url is null or has no host belong to no site and stay whole; null html has no
    lines; a text of which nothing remains is empty. A line counts once a page; repeated rows are
    pages of their own. Other columns are not looked at. No rows give no rows.
    """
    folder = scratch(pages.sparkSession)
    rows = store(
        pages.select(
            F.col("page_id"), url_host(F.col("url")).alias("host"), html_lines(F.col("html")).alias("lines")
        ),
        f"{folder}/lines",
    )
    sites = boilerplate(rows, ratio, least_pages).groupBy("host").agg(F.collect_set("line").alias("boilerplate"))
    sites = store(sites, f"{folder}/sites")
    none = F.array().cast("array<string>")
    kept = F.expr("filter(lines, line -> NOT array_contains(boilerplate, line))")
    return (
        # A host may have a third of all pages: adaptive execution splits its side of this join.
        rows.join(sites, "host", "left")
        .withColumn("boilerplate", F.coalesce("boilerplate", none))
        .withColumn("kept", kept)
        .select(
            "page_id",
            "host",
            F.size("lines").cast("long").alias("n_lines"),
            (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"),
            F.array_join("kept", "\n").alias("text"),
        )
    )
