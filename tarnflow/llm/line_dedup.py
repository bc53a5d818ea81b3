"""Site-relative boilerplate lines.

For each host, the share of its pages that hold a line; lines whose share
exceeds a ratio are boilerplate of that host and are dropped from its pages.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialise

#: White space cut from a line's ends before lines are compared.
BLANKS = " \t\r"
#: Boilerplate rows up to this many are sent to all tasks (40 bytes each);
#: beyond it, they are dealt out by key and salt.
BROADCAST_ROWS = 500_000
SALTS = 16


@dataclass(frozen=True)
class LineRule:
    #: Share of a host's pages above which a line is boilerplate.
    ratio: float = 0.05
    #: Least pages of a host and of a line; what one page has isn't repeated.
    min_pages: int = 2
    min_line_pages: int = 2
    #: Whether pages that would lose all their lines are kept as they are.
    keep_copies: bool = False


#: For pipelines whose next stage judges copied pages.
EVERY_SITE = LineRule(keep_copies=True)


def url_host(url: Column) -> Column:
    """Lower-cased host of a URL, without user, port and a leading www."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.nullif(F.regexp_replace(host, r"^www\.", ""), F.lit(""))


def _key(line: Column) -> list[Column]:
    """128 bits that stand for a line."""
    return [F.xxhash64(line).alias("k1"), F.xxhash64(F.lit(7), line, F.length(line)).alias("k2")]


def _trimmed(line: Column) -> Column:
    return F.trim(line, F.lit(BLANKS))


def boilerplate(pages: DataFrame, rule: LineRule) -> DataFrame:
    """(host, k1, k2, line_pages, host_pages) of boilerplate lines; pages has
    host and text.  At most lines-per-page / ratio rows for each host."""
    totals = pages.filter(F.col("host").isNotNull()).groupBy("host").agg(F.count(F.lit(1)).alias("host_pages")).filter(F.col("host_pages") >= rule.min_pages)
    lines = F.array_distinct(F.filter(F.transform(F.split("text", "\n", -1), _trimmed), lambda s: s != ""))
    each = pages.filter(F.col("host").isNotNull() & F.col("text").isNotNull()).select("host", F.explode(lines).alias("line")).select("host", *_key(F.col("line")))
    # Counted in each task first: a line on a third of all pages is shuffled
    # as one row from each task.
    counted = each.groupBy("host", "k1", "k2").agg(F.count(F.lit(1)).alias("line_pages")).filter(F.col("line_pages") >= rule.min_line_pages)
    return counted.join(totals, "host").filter(F.col("line_pages") > F.lit(rule.ratio) * F.col("host_pages"))


def drop_boilerplate(docs: DataFrame, host: Column, rule: LineRule = LineRule(), text_col: str = "text", count_col: str = "n_dropped", mark_col: str = "all_boilerplate") -> DataFrame:
    """``docs`` with its text changed, and ``count_col`` (lines dropped).

    A page's boilerplate lines go, on sites of any size.  A page that loses all
    its lines that aren't blank is marked in ``mark_col``.  With keep_copies it
    is kept as it is instead, and there is no mark: its lines are common because
    the page was copied, which is for document-level stages to judge.  Lines
    count once for a page and are compared without blanks at their ends; blank
    lines stay.  A null text stays null; a null host has no site, so the page
    keeps all lines; rows that repeat are pages of their own; an empty table
    gives an empty result.  Columns of any other name pass through; one that
    is named as an added column gives way to it, so pass another name for that.
    """
    h, left, bad, salt, met = fresh(docs.columns, "host", "lines", "bad", "salt", "met")
    pages = docs.select(host.cast("string").alias("host"), F.col(f"`{text_col}`").cast("string").alias("text"))
    found = materialise(boilerplate(pages, rule).select("host", "k1", "k2"), "lines")

    # The bad lines of a host as one list: what a host may have is bounded by
    # its lines per page over the ratio, not by its pages.
    listed = found.groupBy("host").agg(F.collect_list(F.concat_ws(":", "k1", "k2")).alias(bad)).withColumnRenamed("host", h)
    base = docs.withColumn(h, host.cast("string"))
    if found.count() <= BROADCAST_ROWS:
        joined = base.join(F.broadcast(listed), h, "left")
    else:
        salted = listed.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        base = base.withColumn(salt, F.pmod(F.xxhash64(F.col(f"`{text_col}`")), F.lit(SALTS)).cast("int"))
        joined = base.join(salted, [h, salt], "left").drop(salt)
    text = F.col(f"`{text_col}`").cast("string")
    key = lambda s: F.concat_ws(":", *_key(_trimmed(s)))
    lines = F.split(text, "\n", -1)
    # A site's list is hashed once a page; lines are then looked up in what the
    # page has of it.
    joined = joined.withColumn(met, F.array_intersect(F.transform(lines, key), bad))
    kept = F.filter(lines, lambda s: (_trimmed(s) == "") | ~F.array_contains(F.col(met), key(s)))
    marked = joined.withColumn(left, F.when(F.size(met) > 0, kept))
    some = F.exists(F.col(left), lambda s: _trimmed(s) != "")
    fewer = F.coalesce(F.size(left) < F.size(lines), F.lit(False))
    changed = F.coalesce(some, F.lit(False)) & fewer if rule.keep_copies else fewer
    mark = {} if rule.keep_copies else {mark_col: fewer & ~F.coalesce(some, F.lit(False))}
    return marked.withColumns(
        mark
        | {
            count_col: F.when(changed, F.size(lines) - F.size(left)).otherwise(0).cast("long"),
            text_col: F.when(changed, F.array_join(left, "\n")).otherwise(text),
        }
    ).drop(h, left, bad, met)
