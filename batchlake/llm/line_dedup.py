"""Site-relative line frequency: drop the lines that most pages of a host carry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchlake.llm.base import landed, row_and

#: A line goes when more than this share of its host's pages carry it ...
BOILERPLATE_RATIO = 0.10
#: ... and at least so many of them: on a tiny host a share says nothing.
LEAST_PAGES = 5
#: Boilerplate lines that may be broadcast (16 bytes each, with the host's name on top).
BROADCAST_LINES = 100_000


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def boilerplate_lines(pages: DataFrame, ratio: float = BOILERPLATE_RATIO, least: int = LEAST_PAGES) -> DataFrame:
    """(host, line) of the lines above the ratio, from rows (host, page, text).

    A page is a distinct text of the host: copies of a page are one page, else a group
    of copies would make its own text boilerplate. Lines are compared without blanks at
    their ends; blank lines are never boilerplate. Counts are combined ahead of each
    shuffle, so a hot host or line is spread over all tasks.
    """
    distinct = (
        pages.select("host", "page", F.explode(F.array_distinct(F.transform(lines_of(F.col("text")), line_key))).alias("line"))
        .filter(F.col("line") != F.xxhash64(F.lit("")))
        .distinct()
    )
    carried = distinct.groupBy("host", "line").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= least)
    totals = pages.select("host", "page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("all_pages"))
    return (
        carried.join(totals, "host")
        .filter(F.col("pages") > F.lit(ratio) * F.col("all_pages"))
        .select("host", "line")
    )


def drop_boilerplate(docs: DataFrame, host: Column, ratio: float = BOILERPLATE_RATIO, least: int = LEAST_PAGES) -> DataFrame:
    """``row`` (the document as it was), ``text`` (without boilerplate), ``n_lines``, ``n_dropped``.

    Every document stays, also one left without lines. A null text stays null with no
    lines; a null host is a host of its own. A host's list of lines is short: more than
    ``ratio`` of its pages carry each, so it holds at most 1 / ratio lines for each line of
    a mean page. All lists together are broadcast only if they were counted to be few;
    else documents meet their host's list in a shuffled join, whose hot hosts Spark splits.
    """
    own = row_and(docs, text=F.col("text"), host=F.coalesce(F.concat(F.lit("="), host.cast("string")), F.lit("")))
    pages = own.select("host", F.xxhash64("text").alias("page"), "text").filter(F.col("text").isNotNull())
    found = landed(boilerplate_lines(pages, ratio, least), "boilerplate")
    lists = found.groupBy("host").agg(F.collect_set("line").alias("drop"))
    if found.count() <= BROADCAST_LINES:
        lists = F.broadcast(lists)
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda x: ~F.array_contains("drop", line_key(x)))
    listed = F.col("drop").isNotNull() & F.col("text").isNotNull()
    return (
        own.join(lists, "host", "left")
        .withColumn("kept", F.when(listed, kept))
        .select(
            "row",
            F.when(listed, F.array_join("kept", "\n")).otherwise(F.col("text")).alias("text"),
            F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
            F.when(listed, F.size(lines) - F.size("kept")).otherwise(0).cast("long").alias("n_dropped"),
        )
    )
