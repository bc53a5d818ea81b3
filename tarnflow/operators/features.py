"""Genomic features: stores, aggregation into parents, numbering, windows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnflow.functions.arrays import running_before
from tarnflow.functions.sequences import reverse_complement

from .windows import running_totals


def aggregate(parts: DataFrame, group: list[str], start: str = "start", end: str = "end", main: str | None = None, whole: bool = False) -> DataFrame:
    """Parts of one group as a parent with the parts' bounds and their list in
    order.  ``main`` names the parent's own method: its bounds count alone
    where it is there, and with ``whole`` groups without it are left out."""
    is_main = (F.col("method") == main) if main else F.lit(False)
    lo = F.coalesce(F.min(F.when(is_main, F.col(start))), F.min(start))
    hi = F.coalesce(F.max(F.when(is_main, F.col(end))), F.max(end))
    members = F.array_sort(F.collect_list(F.when(~is_main, F.struct(F.col(start), F.col(end), F.col("method")))))
    out = parts.groupBy(*group).agg(lo.alias(start), hi.alias(end), members.alias("parts"), F.max(is_main.cast("int")).alias("__main"))
    return (out.filter("__main = 1") if whole else out).drop("__main")


def with_tags(tags: Column, add: dict[str, str] | None = None, remove: tuple[str, ...] = ()) -> Column:
    """A tag map with tags removed and added; an added tag replaces its value."""
    names = [*remove, *(add or {})]
    kept = F.map_filter(tags, lambda k, v: ~k.isin(names)) if names else tags
    if not add:
        return kept
    extra = F.create_map(*[x for k, v in add.items() for x in (F.lit(k), F.array(F.lit(v)))])
    return F.map_concat(kept, extra)


def ambiguous_runs(df: DataFrame, key: str, seq: str, least: int = 5, plain: str = "ACGT") -> DataFrame:
    """(key, start, end) of runs of at least ``least`` other letters than the
    plain ones, 1-based."""
    pattern = f"[^{plain}]+"
    matches, between = F.regexp_extract_all(F.upper(seq), F.lit(pattern), F.lit(0)), F.split(F.upper(seq), pattern, -1)
    long = lambda c: F.transform(c, lambda x: F.length(x).cast("long"))
    runs, gaps = long(matches), long(F.slice(between, 1, F.size(matches)))
    starts = F.zip_with(running_before(F.zip_with(runs, gaps, lambda r, g: r + g)), gaps, lambda b, g: b + g)
    placed = F.zip_with(starts, runs, lambda a, r: F.struct((a + 1).cast("int").alias("start"), (a + r).cast("int").alias("end")))
    return df.select(key, F.explode(placed).alias("r")).select(key, "r.start", "r.end").filter(F.col("end") - F.col("start") + 1 >= least)


def amplicons_both(seq: Column, forward: str, reverse: str, longest: int = 5000) -> Column:
    """Amplicons of either strand: array of struct(strand, amplicon), those of
    the reverse strand as they read on it.  ``reverse`` is given as it stands
    on the strand that is searched."""
    found = lambda s, strand: F.transform(amplicons(s, forward, reverse, longest), lambda a: F.struct(F.lit(strand).alias("strand"), a.alias("amplicon")))
    return F.concat(found(seq, 1), found(reverse_complement(F.upper(seq)), -1))


# The kinds of features that reports keep.
REPORTED = ["CDS", "ncRNA", "rRNA", "tmRNA", "tRNA"]


def reported(tag: Column) -> Column:
    return tag.isin(REPORTED)


def best_per_job(entries: DataFrame, job: list[str], score: str, order: list[Column], spotted: bool = True) -> DataFrame:
    """Each job's best entry (ties: the first in ``order``); all entries if no
    spotter model was used."""
    if not spotted:
        return entries
    w = Window.partitionBy(*job).orderBy(F.desc(score), *order)
    return entries.withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r")


def amplicons(seq: Column, forward: str, reverse: str, longest: int = 5000) -> Column:
    """Shortest stretches from a forward primer to a reverse one (given as it
    stands on this strand), as patterns with ambiguous bases."""
    return F.regexp_extract_all(F.upper(seq), F.lit(f"({forward}(?:(?!{forward}).){{0,{longest}}}?{reverse})"), F.lit(1))


def split_database(sequences: DataFrame, order: str, longest: int = 64_000) -> DataFrame:
    """Truncated upper-case sequences with their offset in the concatenation in
    ``order`` (one separator each)."""
    s = sequences.withColumn("seq", F.substring(F.upper("seq"), 1, longest))
    s = s.withColumn("__size", (F.length("seq") + 1).cast("long"))
    return running_totals(s, [F.asc(order)], ["__size"]).withColumn("offset", F.col("total___size") - F.col("__size")).drop("__size", "total___size")


def chunks(database: DataFrame, order: str, size: int) -> DataFrame:
    """Adds the number of the chunk of ``size`` characters that a sequence of
    split_database starts in, for files of bounded size."""
    return database.withColumn("chunk", F.floor(F.col("offset") / size))


def stems(structure: str) -> list[tuple[int, int]]:
    """Matched brackets of a secondary structure ('>' opens, '<' closes), as
    1-based pairs by opening place; unmatched ones are left out."""
    stack, out = [], []
    for i, c in enumerate(structure or "", 1):
        if c == ">":
            stack.append(i)
        elif c == "<" and stack:
            out.append((stack.pop(), i))
    return sorted(out)


def find_stems(df: DataFrame, key: str, structure: str) -> DataFrame:
    """(key, open, close) of every matched pair; a structure is one row."""

    def run(frames):
        for p in frames:
            rows = [(k, a, z) for k, s in zip(p[key], p[structure]) for a, z in stems(s)]
            yield pd.DataFrame(rows, columns=[key, "open", "close"])

    return df.select(key, structure).mapInPandas(run, f"{key} {df.schema[key].dataType.simpleString()}, open int, close int")


def gc_model(gc: Column, low: int = 30, high: int = 70) -> Column:
    """The model of a GC percentage: rounded half up, within bounds."""
    return F.least(F.lit(high), F.greatest(F.lit(low), F.floor(gc + 0.5))).cast("int")


def assign(costs: np.ndarray) -> np.ndarray:
    """Least-cost assignment of rows to columns (rows <= columns): the column
    of each row, by shortest augmenting paths."""
    n, m = costs.shape
    u, v, match = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        match[0] = i
        j, least, used, way = 0, np.full(m + 1, np.inf), np.zeros(m + 1, bool), np.zeros(m + 1, int)
        while True:
            used[j] = True
            row = match[j]
            free = np.flatnonzero(~used[1:]) + 1
            slack = costs[row - 1, free - 1] - u[row] - v[free]
            better = slack < least[free]
            least[free[better]], way[free[better]] = slack[better], j
            k = free[np.argmin(least[free])]
            step = least[k]
            u[match[used]] += step
            v[used] -= step
            least[free] -= step
            j = k
            if not match[j]:
                break
        while j:
            match[j], j = match[way[j]], way[j]
    out = np.empty(n, int)
    for j in range(1, m + 1):
        if match[j]:
            out[match[j] - 1] = j - 1
    return out


def assignments(df: DataFrame, block: str, row: str, column: str, cost: str) -> DataFrame:
    """(block, row, column) of a least-cost one-to-one assignment in each
    block; missing pairs cost more than all given ones."""

    def run(p: pd.DataFrame) -> pd.DataFrame:
        t = p.pivot_table(index=row, columns=column, values=cost, aggfunc="min")
        filled = t.fillna(1 + np.nansum(np.abs(t.to_numpy()))).to_numpy()
        flipped = filled.shape[0] > filled.shape[1]
        picked = assign(filled.T if flipped else filled)
        pairs = [(t.index[c], t.columns[r]) if flipped else (t.index[r], t.columns[c]) for r, c in enumerate(picked)]
        known = [(p[block].iloc[0], a, b) for a, b in pairs if pd.notna(t.loc[a, b])]
        return pd.DataFrame(known, columns=[block, row, column])

    few = df.select(block, row, column, cost)
    return few.groupBy(block).applyInPandas(run, few.select(block, row, column).schema)
