"""Locations (start, end, strand) as columns; 1-based and closed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def length(start: Column, end: Column) -> Column:
    return F.abs(end - start) + 1


def flip(strand: Column) -> Column:
    """The other strand; one that isn't known counts as the forward one."""
    return -F.coalesce(strand, F.lit(1))


def feature_text(start: Column, end: Column, strand: Column, between: Column | None = None) -> Column:
    """``a..b``, one place as its number, ``a^b`` for the point between two
    neighbours, in complement() on the reverse strand."""
    mark = F.when(between, "^").otherwise("..") if between is not None else F.lit("..")
    plain = F.when((start == end), start.cast("string")).otherwise(F.concat(start.cast("string"), mark, end.cast("string")))
    return F.when(strand == -1, F.concat(F.lit("complement("), plain, F.lit(")"))).otherwise(plain)


def between_neighbours(start: Column, end: Column) -> Column:
    """Whether the two places are neighbours, as a point between them needs."""
    return end == start + 1


def truncate(start: Column, end: Column, low: Column, high: Column) -> tuple[Column, Column]:
    """The part within [low, high]; nulls where nothing is."""
    a, z = F.greatest(start, low), F.least(end, high)
    return F.when(a <= z, a), F.when(a <= z, z)


def relative(start: Column, end: Column, strand: Column, ref_start: Column, ref_end: Column, ref_strand: Column) -> tuple[Column, Column, Column]:
    """A location's coordinates counted from a reference location, along its
    strand; the inverse is windows' lift."""
    forward = ref_strand != -1
    a = F.when(forward, start - ref_start + 1).otherwise(ref_end - end + 1)
    z = F.when(forward, end - ref_start + 1).otherwise(ref_end - start + 1)
    return a, z, strand * F.when(forward, 1).otherwise(-1)


def order(a: Column, b: Column) -> Column:
    """before, after or equal, of two positions on one map."""
    return F.when(a < b, "before").when(a > b, "after").when(a == b, "equal")
