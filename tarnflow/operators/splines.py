"""Natural and clamped cubic splines over series of any length.

A series' second derivatives solve a tridiagonal system.  Rows are ordered by
range partitions, so one long series is dealt to many tasks: each cuts its rows
into segments and expresses the inside of a segment by the values at its two
ends.  The ends' own equations are a tridiagonal system again, of a fraction of
the rows; once a series has few enough, they are solved in order.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .graph import stored

#: Rows of a segment, and rows of a series that are solved in one go.
SEGMENT, DIRECT = 64, 10_000

#: Rows of a part.  Left to itself Spark makes a part for each core, and what a task
#: sorts grows with the input.
DEALT = 100_000


def _parts(rows: int) -> int:
    return max(1, ceil(rows / DEALT))


def nearest(df: DataFrame, key: str, order: list[str], what: Column, before: str, after: str, rows: int | None = None) -> DataFrame:
    """Adds the last value of ``what`` that isn't null strictly before a row, and
    the next one after it, in the order of a key's rows.

    Rows are dealt by ranges of (key, order) and looked at within their part; what
    a part lacks at its ends comes from the other parts' ends, of which there are
    as many as parts and keys.  ``rows`` is their number, if it is known."""
    n = _parts(df.count() if rows is None else rows)
    parted = stored(df.withColumn("__w", what).repartitionByRange(n, key, *order).withColumn("__part", F.spark_partition_id()))
    # Both look back, one from the end: Spark reads a frame that ends with its
    # part anew for every row.
    before_it = lambda by, *o: Window.partitionBy(*by).orderBy(*o).rowsBetween(Window.unboundedPreceding, -1)
    back, ahead = before_it([key, "__part"], *order), before_it([key, "__part"], *[F.desc(c) for c in order])
    ends = parted.filter("__w is not null").groupBy(key, "__part").agg(F.min_by("__w", F.struct(*order)).alias("__first"), F.max_by("__w", F.struct(*order)).alias("__last"))
    parts = parted.select(key, "__part").distinct().join(ends, [key, "__part"], "left")
    parts = parts.select(
        key, "__part",
        F.last("__last", ignorenulls=True).over(before_it([key], "__part")).alias("__from"),
        F.last("__first", ignorenulls=True).over(before_it([key], F.desc("__part"))).alias("__to"),
    )
    seen = parted.repartition(n, key, "__part").withColumns({before: F.last("__w", ignorenulls=True).over(back), after: F.last("__w", ignorenulls=True).over(ahead)})
    filled = seen.join(parts, [key, "__part"]).withColumns({before: F.coalesce(before, "__from"), after: F.coalesce(after, "__to")})
    return filled.drop("__w", "__part", "__from", "__to")


def _segments(l: np.ndarray, d: np.ndarray, u: np.ndarray, f: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
    """p, q, r of every row: its unknown is p + q * (segment's first) + r * (its
    last).  All segments of a batch take each step together."""
    p, q, r = np.zeros(len(d)), np.zeros(len(d)), np.zeros(len(d))
    ends = starts + sizes - 1
    q[starts], r[ends] = 1.0, 1.0
    r[starts[sizes == 1]] = 0.0
    # Forward: an inner row by the segment's first and the next row, v = c v' + e + g first.
    c, e, g = np.zeros(len(d)), np.zeros(len(d)), np.zeros(len(d))
    g[starts] = 1.0
    inner = sizes - 2
    for k in range(1, int(inner.max(initial=0)) + 1):
        i = starts[inner >= k] + k
        pivot = d[i] + l[i] * c[i - 1]
        c[i], e[i], g[i] = -u[i] / pivot, (f[i] - l[i] * e[i - 1]) / pivot, -l[i] * g[i - 1] / pivot
    for k in range(1, int(inner.max(initial=0)) + 1):
        i = ends[inner >= k] - k
        p[i], q[i], r[i] = e[i] + c[i] * p[i + 1], g[i] + c[i] * q[i + 1], c[i] * r[i + 1]
    return p, q, r


def _in_order(l, d, u, f) -> np.ndarray:
    n = len(d)
    c, e, out = np.zeros(n), np.zeros(n), np.zeros(n)
    before_c = before_e = 0.0
    for i in range(n):
        pivot = d[i] + l[i] * before_c
        before_c, before_e = -u[i] / pivot, (f[i] - l[i] * before_e) / pivot
        c[i], e[i] = before_c, before_e
    value = 0.0
    for i in range(n - 1, -1, -1):
        out[i] = value = e[i] + c[i] * value
    return out


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, int)


def solve_tridiagonal(system: DataFrame, key: str, at: str, segment: int = SEGMENT, direct: int = DIRECT) -> DataFrame:
    """(key, at, solution) of l * v[before] + d * v + u * v[after] = f, one system
    for each key, rows in the order of ``at`` (columns l, d, u, f; l of the first and
    u of the last row are not looked at).  Systems must be diagonally dominant, as
    no rows are exchanged.  Keys and places must not be null or repeat."""
    kinds = f"`{key}` {system.schema[key].dataType.simpleString()}, `{at}` {system.schema[at].dataType.simpleString()}"
    rows = system.select(key, at, *[F.col(c).cast("double").alias(c) for c in "lduf"])
    most, total = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    n = _parts(total)

    if most <= direct:

        def whole(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held: list[pd.DataFrame] = []

            def done():
                p = pd.concat(held)
                keys = p[key].to_numpy()
                first = _runs(keys)
                l, u = p["l"].to_numpy().copy(), p["u"].to_numpy().copy()
                l[first] = 0.0
                u[np.append(first[1:], len(keys)) - 1] = 0.0  # series next to each other stay apart
                yield p[[key, at]].assign(solution=_in_order(l, p["d"].to_numpy(), u, p["f"].to_numpy()))

            for p in frames:
                if not len(p):
                    continue
                # A key's rows are solved together; a batch may end within them.
                last = p[key].to_numpy() == p[key].iloc[-1]
                cut = int(np.argmax(last))
                if cut or (held and held[-1][key].iloc[-1] != p[key].iloc[0]):
                    held.append(p.iloc[:cut])
                    held = [h for h in held if len(h)]
                    if held:
                        yield from done()
                    held = []
                held.append(p.iloc[cut:])
            if held:
                yield from done()

        return rows.repartition(n, key).sortWithinPartitions(key, at).mapInPandas(whole, f"{kinds}, solution double")

    place = system.schema[at].dataType.simpleString()

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in frames:
            if not len(p):
                continue
            l, d, u, f = (p[c].to_numpy() for c in "lduf")
            keys, places = p[key].to_numpy(), p[at].to_numpy()
            first = _runs(keys)
            starts = np.concatenate([np.arange(a, z, segment) for a, z in zip(first, np.append(first[1:], len(keys)))])
            sizes = np.diff(np.append(starts, len(keys)))
            ps, qs, rs = _segments(l, d, u, f, starts, sizes)
            ends = starts + sizes - 1
            lone, wide = sizes == 1, sizes > 2
            # The ends' equations, their neighbours inside put in by p, q and r.
            nxt, prv = np.minimum(starts + 1, len(keys) - 1), np.maximum(ends - 1, 0)
            d_a, u_a, f_a = d[starts] + np.where(wide, u[starts] * qs[nxt], 0), np.where(wide, u[starts] * rs[nxt], u[starts]), f[starts] - np.where(wide, u[starts] * ps[nxt], 0)
            l_b, d_b, f_b = np.where(wide, l[ends] * qs[prv], l[ends]), d[ends] + np.where(wide, l[ends] * rs[prv], 0), f[ends] - np.where(wide, l[ends] * ps[prv], 0)
            pieces = lambda x: [x[s : s + n] for s, n in zip(starts, sizes)]
            yield pd.DataFrame(
                {
                    key: keys[starts], "a": places[starts], "b": places[ends], "places": pieces(places), "p": pieces(ps), "q": pieces(qs), "r": pieces(rs),
                    "rows": [
                        [{"at": x, "l": la, "d": da, "u": ua, "f": fa}] if one else [{"at": x, "l": la, "d": da, "u": ua, "f": fa}, {"at": y, "l": lb, "d": db, "u": ub, "f": fb}]
                        for x, y, one, la, da, ua, fa, lb, db, ub, fb in zip(places[starts].tolist(), places[ends].tolist(), lone, l[starts], d_a, u_a, f_a, l_b, d_b, u[ends], f_b)
                    ],
                }
            )

    fields = f"`{key}` {system.schema[key].dataType.simpleString()}, a {place}, b {place}, places array<{place}>, p array<double>, q array<double>, r array<double>, rows array<struct<at:{place},l:double,d:double,u:double,f:double>>"
    segments = stored(rows.repartitionByRange(n, key, at).sortWithinPartitions(key, at).mapInPandas(cut, fields))
    smaller = segments.select(key, F.explode("rows").alias("x")).select(key, F.col("x.at").alias(at), *[F.col(f"x.{c}").alias(c) for c in "lduf"])
    ends = stored(solve_tridiagonal(smaller, key, at, segment, direct))
    value = lambda side: ends.select(key, F.col(at).alias(side), F.col("solution").alias(f"v{side}")).repartition(n, key, side)
    both = segments.repartition(n, key, "a").join(value("a"), [key, "a"]).repartition(n, key, "b").join(value("b"), [key, "b"])
    each = both.select(key, "va", "vb", F.explode(F.arrays_zip("places", "p", "q", "r")).alias("x"))
    return each.select(key, F.col("x.places").alias(at), (F.col("x.p") + F.col("x.q") * F.col("va") + F.col("x.r") * F.col("vb")).alias("solution"))


def second_derivatives(points: DataFrame, key: str, x: str, y: str, first_slope: float | None = None, last_slope: float | None = None, segment: int = SEGMENT, direct: int = DIRECT) -> DataFrame:
    """(key, x, y, m): second derivatives of each key's cubic spline; natural (0
    at the ends) or, where slopes are given, clamped to them.  Rows with a null
    are left out; a key of one row has m 0; two rows of one key with the same x
    have no interval between them and raise."""
    clean = points.select(F.col(key).alias("key"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
    near = stored(nearest(clean, "key", ["x"], F.struct("x", "y"), "lo", "hi"))
    if not near.filter("lo.x = x or hi.x = x").isEmpty():
        raise ValueError("two points of a series have the same place")
    h0, h1 = F.col("x") - F.col("lo.x"), F.col("hi.x") - F.col("x")
    s0, s1 = (F.col("y") - F.col("lo.y")) / h0, (F.col("hi.y") - F.col("y")) / h1
    alone = F.col("lo").isNull() & F.col("hi").isNull()
    at_first, at_last = F.col("lo").isNull() & ~alone, F.col("hi").isNull() & ~alone

    def by_place(inner, first, last):
        return F.when(alone, 1.0 if inner == "d" else 0.0).when(at_first, first).when(at_last, last)

    one, zero = F.lit(1.0), F.lit(0.0)
    free, tied = first_slope is None, last_slope is not None
    system = near.select(
        "key", "x",
        by_place("l", zero, h0 if tied else zero).otherwise(h0).alias("l"),
        by_place("d", one if free else 2 * h1, 2 * h0 if tied else one).otherwise(2 * (h0 + h1)).alias("d"),
        by_place("u", zero if free else h1, zero).otherwise(h1).alias("u"),
        by_place("f", zero if free else 6 * (s1 - F.lit(first_slope)), 6 * (F.lit(last_slope) - s0) if tied else zero).otherwise(6 * (s1 - s0)).alias("f"),
    )
    solved = solve_tridiagonal(system, "key", "x", segment, direct)
    n = _parts(near.count())
    both = near.repartition(n, "key", "x").join(solved.repartition(n, "key", "x"), ["key", "x"])
    return both.select(F.col("key").alias(key), F.col("x").alias(x), F.col("y").alias(y), F.col("solution").alias("m"))


def evaluate(spline: DataFrame, at: DataFrame, key: str, x: str, y: str) -> DataFrame:
    """(key, x, y) of the spline (from second_derivatives) at the rows of ``at``
    (key, x), repeated ones too.  Beyond the ends the outermost pieces go on; where
    a key has fewer than two points y is null."""
    knots = stored(spline.select(F.col(key).alias("key"), F.col(x).alias("x"), F.struct(F.col(x).alias("x"), F.col(y).alias("y"), "m").alias("knot")))
    n = knots.count()
    pieces = nearest(knots, "key", ["x"], F.col("knot"), "lo", "hi", n)
    pieces = pieces.select("key", "x", F.lit(0).alias("asked"), F.when(F.col("hi").isNotNull(), F.struct(F.col("knot").alias("lo"), F.col("hi"))).alias("piece"))
    asked = at.select(F.col(key).alias("key"), F.col(x).cast("double").alias("x"), F.lit(1).alias("asked"), F.lit(None).cast(pieces.schema["piece"].dataType).alias("piece"))
    rows = nearest(pieces.unionByName(asked), "key", ["x", "asked"], F.col("piece"), "below", "above", n + at.count()).filter("asked = 1")
    piece = F.coalesce("below", "above")
    lo, hi = (lambda f: piece["lo"][f]), (lambda f: piece["hi"][f])
    h = hi("x") - lo("x")
    a, b = (hi("x") - F.col("x")) / h, (F.col("x") - lo("x")) / h
    value = a * lo("y") + b * hi("y") + ((a * a * a - a) * lo("m") + (b * b * b - b) * hi("m")) * h * h / 6
    return rows.select(F.col("key").alias(key), F.col("x").alias(x), value.alias(y))
