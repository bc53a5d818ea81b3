"""Matrices and graphs in long form: (i, j, value), one row an entry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def entries(matrix: DataFrame, i: str, j: str, wanted: DataFrame) -> DataFrame:
    """The entries of the pairs in ``wanted`` (i, j), with null where the
    matrix has none."""
    return wanted.select(i, j).join(matrix, [i, j], "left")


def row(matrix: DataFrame, i: str, name) -> DataFrame:
    return matrix.filter(F.col(i) == F.lit(name))


def diagonal(matrix: DataFrame, i: str, j: str) -> DataFrame:
    return matrix.filter(F.col(i) == F.col(j))


def symmetric(matrix: DataFrame, i: str, j: str) -> DataFrame:
    """A triangle with its mirror image."""
    mirrored = matrix.filter(F.col(i) != F.col(j)).withColumnsRenamed({i: "__j", j: "__i"}).withColumnsRenamed({"__i": i, "__j": j})
    return matrix.unionByName(mirrored)


def adjacency(edges: DataFrame, a: str, b: str, weight: str | None = None) -> DataFrame:
    """(a, b, adjacent, distance): the least distance of any edge, 1 where
    edges have none."""
    length = F.min(weight) if weight else F.lit(1)
    return edges.groupBy(a, b).agg(length.alias("distance")).select(a, b, F.lit(True).alias("adjacent"), "distance")


def neighbour_rows(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(a, members, degree): the set bits of each vertex's row, sorted."""
    sets = edges.groupBy(a).agg(F.array_sort(F.collect_set(b)).alias("members"))
    return sets.withColumn("degree", F.size("members"))


def multi_edges(edges: DataFrame, a: str, b: str, name: str, directed: bool = True) -> DataFrame:
    """(a, b, count, ids): edges between the same vertices, counted, with the
    names of all of them; undirected ones have the lesser vertex first."""
    low, high = (F.col(a), F.col(b)) if directed else (F.least(a, b), F.greatest(a, b))
    return edges.select(low.alias(a), high.alias(b), name).groupBy(a, b).agg(F.count(F.lit(1)).alias("count"), F.array_sort(F.collect_set(name)).alias("ids"))


def log_scores(df: DataFrame, value: str, tiny: float = 1e-9, reference: float | None = None) -> DataFrame:
    """Adds log_score (-ln of the value, kept from 0 by ``tiny``) and
    reference_score (that and ln of the greatest value, or of ``reference``)."""
    scored = df.withColumn("log_score", -F.log(F.col(value) + tiny))
    if reference is not None:
        return scored.withColumn("reference_score", F.log(F.lit(float(reference))) + F.col("log_score"))
    greatest = df.agg(F.log(F.max(value).cast("double")).alias("__top"))  # one row
    return scored.crossJoin(F.broadcast(greatest)).withColumn("reference_score", F.col("__top") + F.col("log_score")).drop("__top")
