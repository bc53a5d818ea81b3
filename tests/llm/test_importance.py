"""Importance resampling against plain Python."""

import hashlib
import math
import random
import re
import zlib

import pytest

from tarnflow.llm import importance
from tarnflow.llm.importance import DrawRule

from .conftest import ODD


def brute(rows, target, rule):
    """(id, n_features, weight, score, rank) by joining every run as a string."""

    def features(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        runs = [" ".join(words[i : i + k]) for k in range(1, rule.runs + 1) for i in range(len(words) - k + 1)]
        return len(words), [zlib.crc32(r.encode()) % rule.buckets for r in runs]

    of, at = [features(t) for _, t, _ in rows], [features(t)[1] for _, t in target]
    s, t = [0] * rule.buckets, [0] * rule.buckets
    for _, f in of:
        for x in f:
            s[x] += 1
    for f in at:
        for x in f:
            t[x] += 1
    b = rule.buckets
    gain = [math.floor(1000 * math.log(((t[i] + 1) * (sum(s) + b)) / ((s[i] + 1) * (sum(t) + b)))) for i in range(b)]
    out = []
    for (i, _, _), (n, f) in zip(rows, of):
        weight = math.floor(sum(gain[x] for x in f) / len(f)) if f else 0
        h = int(hashlib.sha256(f"{rule.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    able = sorted((r for r in out if r[4] >= rule.least_words), key=lambda r: (-r[3], r[0] is None, r[0]))
    ranks = {}
    for place, r in enumerate(able[: rule.percent * len(able) // 100], 1):
        ranks.setdefault(r, []).append(place)
    return sorted(((*r[:4], (ranks.get(r) or [None]).pop(0) if ranks.get(r) else None) for r in out), key=str)


TARGET = [(1, "alpha beta gamma delta alpha beta"), (2, None), (3, "Gamma delta! epsilon")]


@pytest.mark.parametrize("rule", [DrawRule(), DrawRule(runs=3, buckets=97, percent=40, least_words=1), DrawRule(runs=2, buckets=5, percent=100, least_words=3)])
def test_equals_brute_force(spark, frame, rule):
    rng = random.Random(3)
    vocabulary = ["alpha", "Beta", "gamma", "delta", "epsilon", "zeta", "éta", "42"]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60))), "a") for i in range(120)]
    rows += ODD + [(None, "gamma " * 30, "a"), (7, "alpha " * 30, "b"), (7, "alpha " * 30, "b")]
    got = importance.importance_draw(frame(rows), spark.createDataFrame(TARGET, "item_id long, text string"), rule).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, TARGET, rule)


def test_ring_equals_joined_runs():
    words = [b"a", b"bb", b"a", b"", b"ccc"]
    for n in (1, 2, 3, 7):
        want = [zlib.crc32(b" ".join(words[i : j + 1])) for j in range(len(words)) for i in range(max(0, j - n + 1), j + 1)]
        assert importance.run_states(words, n) == want


def test_empty_tables(spark, frame):
    target = spark.createDataFrame([], "item_id long, text string")
    assert importance.importance_draw(frame([]), target).count() == 0
    rows = importance.importance_draw(frame([(1, "some words " * 20, "a")] * 10), target).collect()
    assert len(rows) == 10 and sorted(r["rank"] for r in rows if r["rank"]) == [1]


def test_equals_sql(spark, sf):
    import duckdb

    import __spark_entry__

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    got = __spark_entry__.queries()["op12_importance"](spark, sf).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(con.execute(__spark_entry__.oracle_sql()["op12_importance"]).fetchall(), key=str)
