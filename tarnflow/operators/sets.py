"""Set algebra on tables of (set, member) and on arrays."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_exactly_one(tables: list[DataFrame]) -> DataFrame:
    """Rows that exactly one of the tables has."""
    tagged = [t.distinct().withColumn("__t", F.lit(i)) for i, t in enumerate(tables)]
    cols = tables[0].columns
    return reduce(lambda a, b: a.unionByName(b), tagged).groupBy(*cols).agg(F.count(F.lit(1)).alias("__n")).filter("__n = 1").drop("__n")


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return in_exactly_one([a, b])


def complement(a: DataFrame, universe: DataFrame) -> DataFrame:
    return universe.distinct().exceptAll(a.distinct().intersect(universe.distinct()))


def compare(a: Column, b: Column) -> Column:
    """equal, subset, superset, disjoint or overlap of two arrays as sets."""
    only_a, only_b = F.size(F.array_except(a, b)), F.size(F.array_except(b, a))
    return (
        F.when((only_a == 0) & (only_b == 0), "equal").when(only_a == 0, "subset").when(only_b == 0, "superset")
        .when(~F.arrays_overlap(a, b), "disjoint").otherwise("overlap")
    )


def power_set(a: Column, size: int) -> Column:
    """All subsets of an array of ``size`` elements, by bit masks."""
    if size > 16:
        raise ValueError("more than 2**16 subsets")
    masks = F.sequence(F.lit(0), F.lit((1 << size) - 1))
    places = F.array(*[F.lit(i) for i in range(size)])
    return F.transform(masks, lambda m: F.transform(F.filter(places, lambda i: F.pmod(F.floor(m / F.pow(F.lit(2.0), i)), F.lit(2)) == 1), lambda i: F.element_at(a, i + 1)))


def union_streams(*tables: DataFrame) -> DataFrame:
    """All rows of tables whose columns may differ; what a table lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def sorted_map(entries: Column, by: str = "key", descending: bool = False) -> Column:
    """A map's entries as an array of (key, value) in order of keys or of
    values; equal values go by key."""
    other = "value" if by == "key" else "key"

    def order(x: Column, y: Column) -> Column:
        one = F.when(x[by] < y[by], -1).when(x[by] > y[by], 1)
        first = -one if descending else one
        return F.coalesce(first, F.when(x[other] < y[other], -1).when(x[other] > y[other], 1), F.lit(0))

    return F.array_sort(F.map_entries(entries), order)


def reordered(entries: Column, keys: Column) -> Column:
    """A map's values in the order of ``keys``; keys that it lacks are left out."""
    return F.filter(F.transform(keys, lambda k: F.struct(k.alias("key"), F.try_element_at(entries, k).alias("value"))), lambda e: e["value"].isNotNull())


def array_match(a: Column, b: Column) -> Column:
    """struct(length, simple, permutation, different): whether two arrays are
    equally long, equal, equal in some order; and how many places differ."""
    places = F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y))
    return F.struct(
        (F.size(a) == F.size(b)).alias("length"), (a == b).alias("simple"), (F.array_sort(a) == F.array_sort(b)).alias("permutation"), F.size(F.filter(places, lambda d: d)).alias("different")
    )
