"""Every query with SQL equals DuckDB's result; the others equal plain Python."""

import importlib
import math

import duckdb
import numpy as np
import pandas as pd
import pytest

from tarnflow.functions import scores
from tarnflow.operators import clustering
from tarnflow.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_equals_sql(spark, sf, duck, name):
    got, want = catalogue.queries()[name](spark, sf).toPandas(), duck.execute(catalogue.oracle_sql()[name]).fetchdf()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    assert len(got) == len(want)
    a, b = (x[cols].sort_values(cols).reset_index(drop=True).astype(str) for x in (got, want))
    pd.testing.assert_frame_equal(a, b)


def test_oracles_belong_to_queries():
    assert set(catalogue.oracle_sql()) <= set(catalogue.queries())


def test_entry(spark):
    entry = importlib.import_module("__spark_entry__")
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_hypergeometric_scores(spark, sf):
    rows = catalogue.queries()["q_hyge"](spark, sf).collect()
    assert rows and all(r.score >= 0 for r in rows)
    for x, m, k, n in ((5, 50, 10, 12), (3, 20, 8, 5), (9, 1000, 30, 40)):
        exact = sum(math.comb(n, i) * math.comb(m - n, k - i) for i in range(x, min(k, n) + 1)) / math.comb(m, k)
        mean = n * k / m
        var = mean * (1 - n / m) * (m - k) / (m - 1)
        assert math.isclose(scores.hyper_tail(x, m, k, n), 1.0 if x < mean + math.sqrt(var) else exact, rel_tol=1e-9)
    assert np.allclose(scores.log_gamma(np.array([0.5, 1, 7, 100.5])), [math.lgamma(v) for v in (0.5, 1, 7, 100.5)])


def test_suppression_chain(spark, sf):
    from tarnflow.plans import q_structure
    from tarnflow.plans.registry import Tables

    rows = q_structure.intervals(Tables(spark, sf)).toPandas()
    want = set()
    for _, g in rows.groupby("user_id"):
        kept = []
        for r in g.sort_values(["s", "e", "event_id"]).itertuples():
            if kept and r.s <= kept[-1][1]:
                if r.value > kept[-1][2]:
                    kept[-1] = (r.event_id, r.e, r.value)
            else:
                kept.append((r.event_id, r.e, r.value))
        want |= {k[0] for k in kept}
    assert {r.event_id for r in catalogue.queries()["q_suppress_chain"](spark, sf).collect()} == want


def test_pairs_are_one_to_one_and_overlap(spark, sf):
    from tarnflow.plans import q_structure
    from tarnflow.plans.registry import Tables

    pairs = catalogue.queries()["q_interval_pairs"](spark, sf).toPandas()
    assert not pairs.a_id.duplicated().any() and not pairs.b_id.duplicated().any()
    iv = q_structure.intervals(Tables(spark, sf)).toPandas().set_index("event_id")
    for r in pairs.itertuples():
        a, b = iv.loc[r.a_id], iv.loc[r.b_id]
        assert a.s <= b.e and b.s <= a.e and a.user_id == b.user_id


def test_greedy_choice_has_no_relatives(spark, sf):
    rows = catalogue.queries()["q_greedy_nonredundant"](spark, sf).toPandas()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "n_chars").toPandas()
    want = []
    for block in range(7):
        taken, above = set(), set()
        mine = docs[docs.doc_id % 7 == block].sort_values(["n_chars", "doc_id"], ascending=[False, True])
        for d in mine.doc_id.tolist():
            ups, x = set(), d
            while x:
                x //= 2
                ups.add(x)
            if d in above or ups & taken:
                continue
            taken.add(d)
            above |= ups
        want += [(block, d) for d in taken]
    assert sorted(zip(rows.block, rows.doc_id)) == sorted(want)


def test_average_linkage(spark, sf):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal([5, 0, 0], 0.1, (6, 3)), rng.normal([0, 5, 0], 0.1, (5, 3)), rng.normal([0, 0, 5], 0.1, (4, 3))])
    assert clustering.average_linkage(x, 0.7).tolist() == [0] * 6 + [1] * 5 + [2] * 4
    assert clustering.average_linkage(np.array([[1.0, 0], [0, 0]]), 0.7).tolist() == [0, 0]
    # Merging by exact mean distances of all pairs.
    y = rng.normal(0, 1, (14, 3))
    unit = y / np.linalg.norm(y, axis=1, keepdims=True)
    d = 1 - unit @ unit.T
    groups = [[i] for i in range(14)]
    while len(groups) > 1:
        mean, i, j = min((d[np.ix_(a, b)].mean(), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j)
        if mean > 0.7:
            break
        groups[i] += groups.pop(j)
    labels = clustering.average_linkage(y, 0.7)
    assert sorted(map(sorted, groups)) == sorted([np.flatnonzero(labels == k).tolist() for k in np.unique(labels)])
    assert catalogue.queries()["q_cluster_average"](spark, sf).count() > 0
