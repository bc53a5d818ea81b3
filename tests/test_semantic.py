"""Scores against lists, from every pair in plain Python."""

import math
import random

import pytest

from tarnflow.operators import semantic


def world(seed, n=30):
    rng = random.Random(seed)
    parents = {i: set(rng.sample(range(i), min(i, rng.choice([1, 1, 2])))) for i in range(n)}
    parents[n - 1] = set()  # a second root
    up = {}
    for i in range(n):
        up[i] = {i}.union(*(up[p] for p in parents[i]))
    below = {a: sum(a in up[i] for i in range(n)) for a in range(n)}
    return rng, up, {a: math.log(n) - math.log(below[a]) for a in range(n)}


def scores(t, m, up, ic, size, unknown):
    a, b = up[t], up[m]
    if not a & b:
        return (0.0,) * 4
    v = lambda x: ic.get(x, unknown)
    shared = max(v(x) for x in a & b)
    alone = sum(map(v, (a - b) | {t})) + sum(map(v, (b - a) | {m}))
    w = 1 - math.exp(-shared) / size
    lin, path = (2 * shared / d if d else 0.0 for d in (v(t) + v(m), alone))
    return lin, path, w * lin, w * path


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_list_scores(spark, seed):
    rng, up, ic = world(seed)
    n = len(up)
    terms = sorted({(rng.randrange(5), rng.randrange(n)) for _ in range(60)}) + [(9, 3)]
    lists = sorted({(rng.randrange(5), rng.randrange(n)) for _ in range(25)})
    known = {k: v for k, v in ic.items() if k not in (n - 2, n - 3)}  # leaves without a value
    closure = spark.createDataFrame([(i, a) for i in up for a in up[i]], "node long, ancestor long")
    values = spark.createDataFrame(list(known.items()), "term long, ic double")
    frame = lambda rows, b: spark.createDataFrame(rows + rows[:4], f"k long, {b} long")
    got = {(r.key, r.term): r for r in semantic.list_scores(frame(terms, "t"), frame(lists, "m"), closure, values, n).collect()}
    assert set(got) == set(terms)
    for k, t in terms:
        every = [scores(t, m, up, known, n, max(known.values())) for key, m in lists if key == k]
        want = [max(s) for s in zip(*every)] if every else [-1.0] * 4
        assert [got[k, t][c] for c in semantic.SCORES] == pytest.approx(want, abs=1e-12)
    got = {(r.key, r.term): r.jaccard for r in semantic.list_jaccard(frame(terms, "t"), frame(lists, "m"), closure, 1.5).collect()}
    for k, t in terms:
        every = [len(up[t] & up[m]) / max(len(up[t] | up[m]) + 1.5, 1) for key, m in lists if key == k]
        assert got[k, t] == pytest.approx(max(every, default=-1.0))


def test_values_that_fall_are_an_error(spark):
    closure = spark.createDataFrame([(1, 1), (2, 2), (2, 1)], "node long, ancestor long")
    values = spark.createDataFrame([(1, 3.0), (2, 1.0)], "term long, ic double")
    rows = spark.createDataFrame([(1, 2)], "k long, t long")
    with pytest.raises(ValueError):
        semantic.list_scores(rows, rows, closure, values, 2)


@pytest.mark.parametrize("name", ["list_scores", "list_jaccard"])
def test_lists_in_a_tree_meet_few_members(spark, monkeypatch, name):
    """Leaves of one branch against those of another: rows that are stored grow with
    nodes and depth, not with pairs."""
    n, sizes, kept = 1024, [], semantic.stored

    def counted(df):
        done = kept(df)
        sizes.append(done.count())
        return done

    monkeypatch.setattr(semantic, "stored", counted)
    up = {i: {i} for i in range(1, n)}
    for i in range(2, n):
        up[i] |= up[i // 2]
    ic = {a: math.log(n) - math.log(sum(a in s for s in up.values())) for a in up}
    closure = spark.createDataFrame([(i, a) for i in up for a in up[i]], "node long, ancestor long")
    terms = spark.createDataFrame([(0, i) for i in range(512, 640)], "k long, t long")
    lists = spark.createDataFrame([(0, i) for i in range(640, 768)], "k long, m long")
    if name == "list_scores":
        got = {r.term: r for r in semantic.list_scores(terms, lists, closure, spark.createDataFrame(list(ic.items()), "term long, ic double"), n).collect()}
        want = {t: [max(s) for s in zip(*(scores(t, m, up, ic, n, 0) for m in range(640, 768)))] for t in got}
        assert all([got[t][c] for c in semantic.SCORES] == pytest.approx(want[t], abs=1e-12) for t in got)
    else:
        got = {r.term: r.jaccard for r in semantic.list_jaccard(terms, lists, closure, 2.0).collect()}
        assert all(v == pytest.approx(max(len(up[t] & up[m]) / (len(up[t] | up[m]) + 2) for m in range(640, 768))) for t, v in got.items())
    assert len(got) == 128 and max(sizes) <= sum(map(len, up.values()))
