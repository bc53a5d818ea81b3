"""Splines over tables against dense solves."""

import numpy as np
import pytest

from tarnflow.operators import splines


def dense(x, y, first=None, last=None):
    n = len(x)
    if n == 1:
        return np.zeros(1)
    a, f, h = np.zeros((n, n)), np.zeros(n), np.diff(x)
    s = np.diff(y) / h
    for i in range(1, n - 1):
        a[i, i - 1 : i + 2], f[i] = (h[i - 1], 2 * (h[i - 1] + h[i]), h[i]), 6 * (s[i] - s[i - 1])
    a[0, 0] = a[-1, -1] = 1
    if first is not None:
        a[0, :2], f[0] = (2 * h[0], h[0]), 6 * (s[0] - first)
    if last is not None:
        a[-1, -2:], f[-1] = (h[-1], 2 * h[-1]), 6 * (last - s[-1])
    return np.linalg.solve(a, f)


def series(seed=3):
    rng = np.random.default_rng(seed)
    return {k: (np.sort(rng.choice(5000, n, replace=False)) / 7.0, rng.normal(0, 3, n)) for k, n in ((1, 1), (2, 2), (3, 3), (4, 50), (5, 400))}


@pytest.mark.parametrize("segment,direct,slopes", [(64, 10_000, (None, None)), (5, 20, (None, None)), (4, 30, (0.5, None)), (64, 10_000, (-1.0, 2.0)), (3, 60, (0.0, 1.5))])
def test_second_derivatives(spark, segment, direct, slopes):
    data = series()
    rows = [(k, float(a), float(b)) for k, (x, y) in data.items() for a, b in zip(x, y)] + [(None, 1.0, 2.0), (4, None, 1.0)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 37)
    try:
        got = splines.second_derivatives(spark.createDataFrame(rows, "k int, x double, y double"), "k", "x", "y", *slopes, segment=segment, direct=direct).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    by = {}
    for r in got:
        by.setdefault(r.k, []).append((r.x, r.y, r.m))
    assert set(by) == set(data)
    for k, (x, y) in data.items():
        mine = np.array(sorted(by[k]))
        assert np.array_equal(mine[:, 0], x) and np.allclose(mine[:, 2], dense(x, y, *(slopes if len(x) > 1 else (None, None))), atol=1e-9)


def test_evaluate(spark):
    data = series(8)
    rows = [(k, float(a), float(b)) for k, (x, y) in data.items() for a, b in zip(x, y)]
    rng = np.random.default_rng(1)
    asked = [(k, float(v)) for k, (x, _) in data.items() for v in [*rng.uniform(x[0] - 5, x[-1] + 5, 25), x[0], x[-1], x[len(x) // 2]]] * 2 + [(9, 1.0)]
    spline = splines.second_derivatives(spark.createDataFrame(rows, "k int, x double, y double"), "k", "x", "y")
    got = splines.evaluate(spline, spark.createDataFrame(asked, "k int, x double"), "k", "x", "y").collect()
    assert sorted((r.k, r.x) for r in got) == sorted(asked)
    for r in got:
        if r.k == 9 or len(data[r.k][0]) < 2:
            assert r.y is None
            continue
        x, y = data[r.k]
        m = dense(x, y)
        i = min(max(int(np.searchsorted(x, r.x, side="right")) - 1, 0), len(x) - 2)
        h = x[i + 1] - x[i]
        a, b = (x[i + 1] - r.x) / h, (r.x - x[i]) / h
        assert r.y == pytest.approx(a * y[i] + b * y[i + 1] + ((a**3 - a) * m[i] + (b**3 - b) * m[i + 1]) * h * h / 6, abs=1e-7)


def test_odd(spark):
    with pytest.raises(ValueError):
        splines.second_derivatives(spark.createDataFrame([(1, 1.0, 2.0), (1, 1.0, 3.0)], "k int, x double, y double"), "k", "x", "y")
    assert splines.second_derivatives(spark.createDataFrame([], "k int, x double, y double"), "k", "x", "y").count() == 0


def test_neighbours_are_found_by_frames_that_only_grow(spark):
    """A frame that ends with its part is read anew for every row."""
    rows = spark.range(40).selectExpr("id % 2 as k", "cast(id as double) as x", "if(id % 3 = 0, id, null) as v")
    near = splines.nearest(rows, "k", ["x"], splines.F.col("v"), "lo", "hi")
    assert "unboundedfollowing" not in near._jdf.queryExecution().toString().lower()
    seen = {(r.k, r.x): (r.lo, r.hi) for r in near.collect()}
    for i in range(40):
        same = [j for j in range(40) if j % 2 == i % 2 and j % 3 == 0]
        assert seen[i % 2, float(i)] == (max((j for j in same if j < i), default=None), min((j for j in same if j > i), default=None))


def test_evaluation_has_no_frames_to_the_end(spark):
    knots = spark.createDataFrame([(1, 0.0, 0.0, 0.0), (1, 2.0, 4.0, 0.0)], "k int, x double, y double, m double")
    got = splines.evaluate(knots, spark.createDataFrame([(1, 0.5), (1, 3.0)], "k int, x double"), "k", "x", "y")
    assert "unboundedfollowing" not in got._jdf.queryExecution().toString().lower()
    assert {r.x: r.y for r in got.collect()} == {0.5: 1.0, 3.0: 6.0}


def test_parts_follow_the_rows(spark, monkeypatch):
    """However few the cores, a part has so many rows and no more."""
    monkeypatch.setattr(splines, "DEALT", 40)
    data = series(5)
    rows = [(k, float(a), float(b)) for k, (x, y) in data.items() for a, b in zip(x, y)]
    points, parts = spark.createDataFrame(rows, "k int, x double, y double"), -(-len(rows) // 40)
    assert parts > 8
    spline = splines.second_derivatives(points, "k", "x", "y", segment=5, direct=20)
    near = splines.nearest(points, "k", ["x"], splines.F.col("y"), "lo", "hi")
    # What is dealt by rows isn't put together again.
    assert all(f", {parts}), REPARTITION_BY_NUM" in d._jdf.queryExecution().executedPlan().toString() for d in (spline, near))
    by = {}
    for r in spline.collect():
        by.setdefault(r.k, []).append((r.x, r.m))
    for k, (x, y) in data.items():
        mine = np.array(sorted(by[k]))
        assert np.array_equal(mine[:, 0], x) and np.allclose(mine[:, 1], dense(x, y), atol=1e-9)
    got = {(r.k, r.x): r.y for r in splines.evaluate(spline, points.select("k", "x"), "k", "x", "y").collect() if r.k > 1}
    assert len(got) == sum(k > 1 for k, _, _ in rows) and all(got[k, a] == pytest.approx(b, abs=1e-7) for k, a, b in rows if k > 1)
