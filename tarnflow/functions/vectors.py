"""Vectors as arrays of one size.  Vectors of different sizes give null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _same(a: Column, b: Column, value: Column) -> Column:
    return F.when(F.size(a) == F.size(b), value)


def add(a: Column, b: Column) -> Column:
    return _same(a, b, F.zip_with(a, b, lambda x, y: x + y))


def subtract(a: Column, b: Column) -> Column:
    return _same(a, b, F.zip_with(a, b, lambda x, y: x - y))


def scale(a: Column, by: Column) -> Column:
    return F.transform(a, lambda x: x * by)


def lexicographic(a: Column, b: Column) -> Column:
    """-1, 0 or 1 by the first place where they differ."""
    signs = F.zip_with(a, b, lambda x, y: F.when(x < y, -1).when(x > y, 1).otherwise(0))
    return _same(a, b, F.coalesce(F.try_element_at(F.filter(signs, lambda s: s != 0), F.lit(1)), F.lit(0)))


def dominates(a: Column, b: Column) -> Column:
    """Whether no place of a is less than b's."""
    return _same(a, b, F.forall(F.zip_with(a, b, lambda x, y: x >= y), lambda ok: ok))


def non_negative(a: Column) -> Column:
    return F.forall(a, lambda x: x >= 0)


def hamming(a: Column, b: Column) -> Column:
    return _same(a, b, F.size(F.filter(F.zip_with(a, b, lambda x, y: x != y), lambda d: d)))


def manhattan(a: Column, b: Column) -> Column:
    differences = F.zip_with(a, b, lambda x, y: F.abs(x - y).cast("double"))
    return _same(a, b, F.aggregate(differences, F.lit(0.0), lambda s, d: s + d))
