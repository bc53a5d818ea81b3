"""Array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements of one stretch of running_before.
STRETCH = 256


def running_before(numbers: Column) -> Column:
    """For each element of an array of longs, the sum of those before it.

    The array is cut into stretches; sums are taken within them and over their
    totals.  So no array is copied for each element, as a fold that appends
    would do.  Empty arrays stay empty.
    """
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)
    count = F.ceil(F.size(numbers) / STRETCH)
    cut = F.when(count > 0, F.transform(F.sequence(F.lit(1).cast("long"), count), lambda c: F.slice(numbers, ((c - 1) * STRETCH + 1).cast("int"), F.lit(STRETCH)))).otherwise(F.array().cast("array<array<bigint>>"))
    totals = F.transform(cut, total)
    bases = F.transform(totals, lambda _, i: total(F.slice(totals, F.lit(1), i)))
    parts = F.zip_with(cut, bases, lambda c, b: F.struct(c.alias("c"), b.alias("b")))
    return F.flatten(F.transform(parts, lambda p: F.transform(p["c"], lambda _, i: p["b"] + total(F.slice(p["c"], F.lit(1), i)))))
