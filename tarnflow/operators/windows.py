"""Numbering, smoothing, derivatives and splines over ordered rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def renumber(df: DataFrame, group: list[str], order: list[Column], name: str = "number") -> DataFrame:
    """1, 2, ... within each group."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


def running_numbers(df: DataFrame, coarse: str, order: list[str], step: int = 1, start: int = 0, name: str = "number") -> DataFrame:
    """Continuous numbers over the whole table in order of (coarse, order).

    Not one window over all rows: rows are numbered within each value of
    ``coarse`` and shifted by the counts before it, which are few rows.
    """
    inner = df.withColumn("__r", F.row_number().over(Window.partitionBy(coarse).orderBy(*order)))
    counts = df.groupBy(coarse).agg(F.count(F.lit(1)).alias("__n"))
    before = counts.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy(coarse).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    out = inner.join(before, coarse)
    return out.withColumn(name, F.lit(start) + step * (F.col("__before") + F.col("__r"))).drop("__r", "__before")


def running_totals(df: DataFrame, order: list[Column], columns: list[str]) -> DataFrame:
    """Adds total_<c> of each column: its sum over all rows up to a row, in a
    total order of the whole table.

    Not one window over all rows: the table is cut into ranges of the order,
    each is summed up by itself, and the ranges' totals, one row each, are
    added.  Ranges depend on a sample, so they are stored before use.
    """
    from .graph import stored

    # Partitions are made by number: joining small ones would mix up the ranges.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()))
    sums = ranged.groupBy("__part").agg(*[F.sum(c).alias(f"__{c}") for c in columns])
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("__part", *[F.sum(f"__{c}").over(earlier).alias(f"__{c}") for c in columns])
    inner = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = ranged.withColumns({f"total_{c}": F.sum(c).over(inner) for c in columns})
    out = within.join(F.broadcast(before), "__part")
    return out.withColumns({f"total_{c}": F.col(f"total_{c}") + F.coalesce(F.col(f"__{c}"), F.lit(0)) for c in columns}).drop("__part", *[f"__{c}" for c in columns])


def number_around(df: DataFrame, group: str, order: list[str], given: str, step: int, forbidden: list[int] | None = None) -> DataFrame:
    """Numbers rows without one in ``given``, going on from the greatest number
    so far and leaving out numbers that are given or forbidden.  The next
    number depends on all before it, so a group is one task's work."""
    taken = set(forbidden or [])

    def run(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(order, kind="stable")
        used = taken | {int(v) for v in p[given].dropna()}
        last, out = 0, []
        for v in p[given]:
            if pd.notna(v):
                last = max(last, int(v))
                out.append(int(v))
                continue
            last += step
            while last in used:
                last += step
            out.append(last)
        return p.assign(number=np.array(out, "int64"))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.groupBy(group).applyInPandas(run, fields + ", number long")


def smooth(df: DataFrame, group: str, order: list[str], value: str, keep: float, samples: str | None = None) -> DataFrame:
    """Exponential smoothing s = keep * s' + (1 - keep) * x, from the first
    value on, in order within each group.  With ``samples`` (how many samples a
    row's value stands for) rows weigh as much as they have of all samples so
    far: s = (keep * s' * n' + (1 - keep) * x * n) / (keep * n' + (1 - keep) * n),
    n' being the last row's number.

    Rows are sorted by group and order, and one pass carries the last value,
    so a task holds one batch of rows however long a series is.
    """
    rows = df.select(group, *order, F.col(value).cast("double").alias(value), *([samples] if samples else []))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def run(frames):
        key, s, before, place = None, 0.0, 0.0, 0
        for p in frames:
            out, places = np.empty(len(p)), np.empty(len(p), np.int32)
            weights = p[samples].to_numpy(float) if samples else None
            for i, (k, x) in enumerate(zip(p[group].tolist(), p[value].tolist())):
                n = weights[i] if samples else 1.0
                if place == 0 or k != key:
                    key, s, place = k, x, 0
                elif samples:
                    whole = keep * before + (1 - keep) * n
                    s = (keep * s * before + (1 - keep) * x * n) / whole if whole else s
                else:
                    s = keep * s + (1 - keep) * x
                out[i], places[i], before = s, place, n
                place += 1
            yield p.assign(place=places, smoothed=out)

    return rows.repartition(group).sortWithinPartitions(group, *order).mapInPandas(run, fields + ", place int, smoothed double").select(group, "place", *order, value, "smoothed")


def derivative(df: DataFrame, group: list[str], x: str, y: str, tie: list[str]) -> DataFrame:
    """Slope at each row: over both neighbours, at an end over one; null for a
    group of one."""
    w = Window.partitionBy(*group).orderBy(x, *tie)
    x0, x1 = F.coalesce(F.lag(x).over(w), F.col(x)), F.coalesce(F.lead(x).over(w), F.col(x))
    y0, y1 = F.coalesce(F.lag(y).over(w), F.col(y)), F.coalesce(F.lead(y).over(w), F.col(y))
    return df.withColumn("slope", F.try_divide(y1 - y0, x1 - x0))


def second_derivatives(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of the natural cubic spline through the points (x ascending)."""
    n = len(x)
    out = np.zeros(n)
    if n < 3:
        return out
    h = np.diff(x)
    matrix = np.diag(2 * (h[:-1] + h[1:])) + np.diag(h[1:-1], 1) + np.diag(h[1:-1], -1)
    out[1:-1] = np.linalg.solve(matrix, 6 * np.diff(np.diff(y) / h))
    return out


def spline(x: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
    m = second_derivatives(x, y)
    i = np.clip(np.searchsorted(x, at) - 1, 0, len(x) - 2)
    h = x[i + 1] - x[i]
    a, b = (x[i + 1] - at) / h, (at - x[i]) / h
    return a * y[i] + b * y[i + 1] + ((a**3 - a) * m[i] + (b**3 - b) * m[i + 1]) * h * h / 6
