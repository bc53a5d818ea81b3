"""Curves over descending score thresholds, against known truth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import running_totals


def curve(pairs: DataFrame, truth_count: DataFrame, score: str, hit: str, weight: str) -> DataFrame:
    """(tau, tp, p, wtp, wp, t, wt): of predictions with score tau or more, the
    number that are true and all, plain and weighted.  Scores are grouped
    first, so the running sums go over distinct thresholds, not rows; these are
    summed in ranges, so that no task has them all.

    truth_count: one row (t, wt), the size and weight of the truth.
    """
    at = pairs.groupBy(F.col(score).alias("tau")).agg(
        F.sum(F.col(hit).cast("long")).alias("tp"), F.count(F.lit(1)).alias("p"),
        F.sum(F.when(F.col(hit), F.col(weight)).otherwise(0.0)).alias("wtp"), F.sum(weight).alias("wp"),
    )
    names = ("tp", "p", "wtp", "wp")
    summed = running_totals(at, [F.desc("tau")], list(names))
    return summed.select("tau", *[F.col(f"total_{c}").alias(c) for c in names]).crossJoin(F.broadcast(truth_count))


def measures(points: DataFrame, targets: int | F.Column = 1) -> DataFrame:
    """F and Jaccard, plain and weighted, and S at each threshold."""
    f = F.try_divide(2.0 * F.col("tp"), F.col("t") + F.col("p"))
    wf = F.try_divide(2.0 * F.col("wtp"), F.col("wt") + F.col("wp"))
    j = F.try_divide(1.0 * F.col("tp"), F.col("t") + F.col("p") - F.col("tp"))
    wj = F.try_divide(1.0 * F.col("wtp"), F.col("wt") + F.col("wp") - F.col("wtp"))
    ru, mi = F.col("wt") - F.col("wtp"), F.col("wp") - F.col("wtp")
    s = F.sqrt(ru * ru + mi * mi) / targets
    return points.select("tau", "tp", "p", f.alias("f"), wf.alias("wf"), j.alias("jacc"), wj.alias("wjacc"), s.alias("s"))


def best(measured: DataFrame) -> DataFrame:
    """One row: the greatest F, weighted F, Jaccards and the least S."""
    return measured.agg(*[F.max(c).alias(f"{c}max") for c in ("f", "wf", "jacc", "wjacc")], F.min("s").alias("smin"))
