"""Interval joins, unions and orders; intervals are closed, start <= end."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_bins(df: DataFrame, start: Column, end: Column, width: int, name: str = "bin") -> DataFrame:
    """One row for each bin that an interval touches."""
    return df.withColumn(name, F.explode(F.sequence(F.floor(start / width), F.floor(end / width))))


def overlap_join(a: DataFrame, b: DataFrame, group: list[str], width: int, residual: Column, reach: int = 0) -> DataFrame:
    """Pairs of intervals (a: a_start, a_end; b: b_start, b_end) that overlap
    within equal ``group`` columns, each pair once, where ``residual`` holds.

    Both sides are spread over bins so that the join is an equi-join; a pair is
    kept in the first bin they share.  ``reach`` widens a for proximity joins.
    An interval lies on the finest of LEVELS widths (each SPAN times the one
    before) on which it touches SPAN bins or few more, and meets those of other
    levels on the coarser one's bins, so a long one costs no more rows than a
    short one.
    """
    lo, hi = F.col("a_start") - reach, F.col("a_end") + reach
    left = _levelled(a, lo, hi, width, "")
    right = _levelled(b, F.col("b_start"), F.col("b_end"), width, "_b")
    for g in group:
        right = right.withColumnRenamed(g, f"{g}__b")
    same = (F.col("bin") == F.col("bin_b")) & (F.col("level") == F.col("level_b"))
    for g in group:
        same = same & (F.col(g) == F.col(f"{g}__b"))
    meets = (F.col("b_start") <= hi) & (F.col("b_end") >= lo)
    on = F.col("level") == F.greatest("own", "own_b")
    first = F.col("bin") == F.floor(F.greatest(lo, F.col("b_start")) / (width * F.pow(F.lit(SPAN), F.col("level"))))
    return left.join(right, same & meets & on & first & residual).drop("bin", "bin_b", "level", "level_b", "own", "own_b", *[f"{g}__b" for g in group])


#: Widths of bins, each SPAN times the one before; what is longer than all of
#: them goes to the last.
LEVELS, SPAN = 4, 64


def _levelled(df: DataFrame, start: Column, end: Column, width: int, mark: str) -> DataFrame:
    """One row for each bin on an interval's own level and on all coarser ones,
    where intervals of those levels look for it."""
    wide = lambda level: width * F.pow(F.lit(SPAN), level)
    own = F.least(F.lit(LEVELS - 1), F.greatest(F.lit(0), F.ceil(F.log(F.greatest((end - start + 1) / (width * SPAN), F.lit(1.0))) / F.log(F.lit(float(SPAN)))))).cast("int")
    levels = F.transform(F.sequence(own, F.lit(LEVELS - 1)), lambda v: F.transform(F.sequence(F.floor(start / wide(v)), F.floor(end / wide(v))), lambda b: F.struct(v.alias("level"), b.alias("bin"))))
    spread = df.withColumn(f"own{mark}", own).withColumn("__at", F.explode(F.flatten(levels)))
    return spread.withColumns({f"level{mark}": F.col("__at.level"), f"bin{mark}": F.col("__at.bin")}).drop("__at")


def contained() -> Column:
    """b lies in a."""
    return (F.col("b_start") >= F.col("a_start")) & (F.col("b_end") <= F.col("a_end"))


def near_ends(reach: int) -> Column:
    """Starts or ends at most ``reach`` apart."""
    return (F.abs(F.col("a_start") - F.col("b_start")) <= reach) | (F.abs(F.col("a_end") - F.col("b_end")) <= reach)


def island_ids(df: DataFrame, group: list[str], start: str, end: str, order: list[str], name: str = "island") -> DataFrame:
    """Numbers runs of overlapping intervals within a group."""
    w = Window.partitionBy(*group).orderBy(start, *order)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = (before.isNull() | (F.col(start) > before)).cast("int")
    return df.withColumn("__opens", opens).withColumn(name, F.sum("__opens").over(w)).drop("__opens")


def merge(df: DataFrame, group: list[str], start: str, end: str, order: list[str], source_bits: str | None = None) -> DataFrame:
    """Union of overlapping intervals: bounds, members and, if asked for, the
    OR of their sources' bits."""
    extra = [F.bit_or(source_bits).alias(source_bits)] if source_bits else []
    numbered = island_ids(df, group, start, end, order)
    return numbered.groupBy(*group, "island").agg(F.min(start).alias(start), F.max(end).alias(end), F.count(F.lit(1)).alias("members"), *extra)


def windows_around(start: Column, end: Column, flank: int, length: Column) -> tuple[Column, Column]:
    """A hit and its flanks, within [1, length]."""
    return F.greatest(F.lit(1), start - flank), F.least(length, end + flank)


#: Runs of overlapping intervals that are scanned together.
RUNS = 1000


def suppress(df: DataFrame, group: list[str], row: str, start: str, end: str, score: str) -> DataFrame:
    """Best of overlapping neighbours: rows in order of start are taken one by
    one; one that overlaps the last kept row replaces it if it scores more,
    else goes (ties keep the earlier).  The order matters only within a run of
    overlapping rows, so RUNS such runs, and not a group, are one task's work."""

    def chain(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values([start, end, row], kind="stable")
        kept: list = []
        for r in p.itertuples(index=False):
            x = r._asdict()
            if kept and x[start] <= kept[-1][end]:
                if x[score] > kept[-1][score]:
                    kept[-1] = x
                continue
            kept.append(x)
        return pd.DataFrame(kept, columns=p.columns)

    cols = [*group, row, start, end, score]
    few = df.select(*cols)
    runs_of = island_ids(few, group, start, end, [end, row], "__island")
    return runs_of.withColumn("__island", F.floor(F.col("__island") / RUNS)).groupBy(*group, "__island").applyInPandas(lambda p: chain(p[cols]), few.schema)


def merge_files(files: list[DataFrame], group: list[str], row: str, start: str, end: str, score: str) -> DataFrame:
    """The best of overlapping hits over several files' hits: all are put
    together and suppressed once, so files may come in any order."""
    return suppress(reduce(lambda a, b: a.unionByName(b), files), group, row, start, end, score)


def suppressed(df: DataFrame, kept: DataFrame, row: str) -> DataFrame:
    """The hits that suppress left out, for a file of their own."""
    return df.join(kept.select(row), row, "left_anti")


def pair_one_to_one(a: DataFrame, b: DataFrame, group: list[str]) -> DataFrame:
    """Greedy merge scan over two lists sorted by start: each a takes the first
    unused b that overlaps it; (group, a_id, b_id).  Runs of overlapping
    intervals of both lists are scanned apart, as nothing pairs across them."""

    def scan(key: tuple, x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(y):
            return pd.DataFrame([], columns=[*group, "a_id", "b_id"])
        x, y = x.sort_values(["a_start", "a_id"]), y.sort_values(["b_start", "b_id"])
        used, out = set(), []
        rows = list(y.itertuples(index=False))
        low = 0
        for r in x.itertuples(index=False):
            while low < len(rows) and (rows[low].b_id in used or rows[low].b_end < r.a_start):
                low += 1
            for s in rows[low:]:
                if s.b_start > r.a_end:
                    break
                if s.b_id not in used and s.b_end >= r.a_start:
                    used.add(s.b_id)
                    out.append((*key, r.a_id, s.b_id))
                    break
        return pd.DataFrame(out, columns=[*group, "a_id", "b_id"])

    both = a.select(*group, F.lit(0).alias("__side"), F.col("a_id").alias("__id"), F.col("a_start").alias("__s"), F.col("a_end").alias("__e")).unionByName(
        b.select(*group, F.lit(1).alias("__side"), F.col("b_id").alias("__id"), F.col("b_start").alias("__s"), F.col("b_end").alias("__e"))
    )
    cut = island_ids(both, group, "__s", "__e", ["__side", "__id"], "__island").withColumn("__island", F.floor(F.col("__island") / RUNS))
    side = lambda k, n: cut.filter(F.col("__side") == k).select(*group, "__island", F.col("__id").alias(f"{n}_id"), F.col("__s").alias(f"{n}_start"), F.col("__e").alias(f"{n}_end"))
    fields = ", ".join([f"{g} {a.schema[g].dataType.simpleString()}" for g in group] + ["a_id long", "b_id long"])
    keys = [*group, "__island"]
    return side(0, "a").groupBy(*keys).cogroup(side(1, "b").groupBy(*keys)).applyInPandas(lambda key, x, y: scan(key[:-1], x, y), fields)


def runs(df: DataFrame, group: list[str], order: list[str], flag: Column, least: int) -> DataFrame:
    """Gaps and islands: maximal runs of rows where ``flag`` holds, of at least
    ``least`` rows: (group, first, last, length), places counted from 1."""
    w = Window.partitionBy(*group).orderBy(*order)
    placed = df.withColumn("__p", F.row_number().over(w)).withColumn("__f", flag)
    only = placed.filter("__f").withColumn("__run", F.col("__p") - F.row_number().over(w))
    return only.groupBy(*group, "__run").agg(F.min("__p").alias("first"), F.max("__p").alias("last"), F.count(F.lit(1)).alias("length")).filter(F.col("length") >= least).drop("__run")
