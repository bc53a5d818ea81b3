"""Lineage paths such as ``A; B; C`` as columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def ranks(lineage: Column) -> Column:
    return F.split(lineage, "; ")


def prefix(lineage: Column, depth: int) -> Column:
    return F.array_join(F.slice(ranks(lineage), 1, depth), "; ")


def genus(lineage: Column) -> Column:
    """The rank that stands for a genus, by kingdom: plants, mammals, birds and
    other eukaryotes have theirs at fixed depths, others at the end."""
    r = ranks(lineage)
    at = lambda i: F.try_element_at(r, F.lit(i))
    depth = (
        F.when(at(1) != "Eukaryota", F.size(r) - 1)
        .when(at(2) == "Viridiplantae", 6)
        .when(at(7) == "Mammalia", 9)
        .when(at(13) == "Aves", 14)
        .otherwise(3)
    )
    return F.when(F.size(r) > depth, F.replace(F.try_element_at(r, depth + 1), F.lit("Candidatus "), F.lit(""))).otherwise(F.try_element_at(r, F.lit(-1)))


def kingdom(lineage: Column) -> Column:
    return F.try_element_at(ranks(lineage), F.lit(1))


def common_depth(a: Column, b: Column) -> Column:
    """Length of the longest common prefix of two rank arrays."""
    start = F.struct(F.lit(True).alias("on"), F.lit(0).alias("n"))

    def step(s, same):
        on = s["on"] & same
        return F.struct(on.alias("on"), (s["n"] + on.cast("int")).alias("n"))

    # Where one is longer, the other's missing ranks aren't equal to any.
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    return F.aggregate(same, start, step)["n"]


def path_length(a: Column, b: Column, compat: bool = False) -> Column:
    """Steps between two lineages over their last common rank; with ``compat``
    no rank counts as common."""
    x, y = ranks(a), ranks(b)
    if compat:
        return F.size(x) + F.size(y)
    return F.size(x) + F.size(y) - 2 * common_depth(x, y)


def distance_table(size: int = 70) -> list[float]:
    """Corrected distances by path length: a regression curve, shifted to be
    at least 0 and 0 from its minimum on."""
    # The curve's weights for i, i**2 and ln(i + 1).
    w1, w2, w3 = -0.0704054300, 0.0006559828, 0.4615545000
    raw = [w1 * i + w2 * i * i + w3 * math.log(i + 1) for i in range(size)]
    low = min(raw)
    at = raw.index(low)
    return [v - low if i < at else 0.0 for i, v in enumerate(raw)]


def corrected_distance(path: Column) -> Column:
    table = F.array(*[F.lit(v) for v in distance_table()])
    return F.coalesce(F.try_element_at(table, path + 1), F.lit(0.0))
