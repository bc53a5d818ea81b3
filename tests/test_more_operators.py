"""Taxonomies and features."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from tarnflow.operators import features as G
from tarnflow.operators import graph
from tarnflow.operators import taxonomy as T


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def taxa(spark):
    return spark.createDataFrame([(1, None, "root", "no rank"), (2, 1, "Bacteria", "kingdom"), (3, 2, "Alpha", "class"), (4, 2, "Beta", "class"), (5, 3, "A one", "genus")], "id int, up int, name string, rank string")


def test_lineage_and_common_ancestor(spark):
    t = taxa(spark)
    assert dict(rows(T.lineage(t, "id", "up", "name", "rank")))[5] == "Bacteria; Alpha; A one"
    up = graph.ancestors(t.filter("up is not null"), "id", "up", t.select("id"))
    pairs = spark.createDataFrame([(5, 4), (5, 5), (3, 1)], "a int, b int")
    assert rows(T.common_ancestor(pairs, up, "a", "b")) == [(3, 1, 1, 2), (5, 4, 2, 3), (5, 5, 5, 0)]
    assert dict(rows(T.depth(up)))[5] == 3
    assert dict((a, b) for a, b in rows(T.leaf_sets(up, spark.createDataFrame([(4,), (5,)], "n int"))))[2] == [4, 5]


def test_tree_and_lineage_nodes(spark):
    e = spark.createDataFrame([(2, 1, 1.5), (3, 1, 2.0), (4, 2, 0.5)], "c int, p int, l double")
    assert rows(T.tree_metrics(e, "c", "p", "l")) == [(4, 2, 4.0)]
    df = spark.createDataFrame([("A; X",), ("B; X",), ("A; Y",)], "lin string")
    assert len(rows(T.from_lineages(df, "lin"))) == 5
    sets = spark.createDataFrame([([1, 2], [2, 1, 3]), ([1], [2]), ([1, 2], [2, 3])], "a array<int>, b array<int>")
    assert [r[0] for r in sets.select(T.compatible(F.col("a"), F.col("b"))).collect()] == [True, True, False]


def test_feature_aggregation(spark):
    df = spark.createDataFrame([("g1", "gene", 1, 100), ("g1", "exon", 50, 120), ("g1", "exon", 5, 20), ("g2", "exon", 7, 9)], "grp string, method string, start int, end int")
    got = {r.grp: (r.start, r.end, [p.start for p in r.parts]) for r in G.aggregate(df, ["grp"], main="gene").collect()}
    assert got == {"g1": (1, 100, [5, 50]), "g2": (7, 9, [7])}
    assert [r.grp for r in G.aggregate(df, ["grp"], main="gene", whole=True).collect()] == ["g1"]


def test_tags(spark):
    df = spark.createDataFrame([({"product": ["x"], "note": ["n"]},)], "tags map<string,array<string>>")
    got = df.select(G.with_tags(F.col("tags"), {"product": "kinase"}, ("note",)).alias("t")).first().t
    assert got == {"product": ["kinase"]}


def test_sequence_features(spark):
    df = spark.createDataFrame([("a", "NNACGTNNNNNAXNNNN"), ("b", "ACGT"), ("c", None)], "id string, seq string")
    assert set(rows(G.ambiguous_runs(df, "id", "seq", 5))) == {("a", 7, 11), ("a", 13, 17)}
    amp = spark.createDataFrame([("ttACGaaACGccTGAtt",)], "s string").select(G.amplicons(F.col("s"), "ACG", "TGA")).first()[0]
    assert amp == ["ACGCCTGA"]
    off = {r.id: (r.offset, r.seq) for r in G.split_database(df.filter("seq is not null"), "id", 6).collect()}
    assert sorted(off.values()) in ([(0, "ACGT"), (5, "NNACGT")], [(0, "NNACGT"), (7, "ACGT")])
    assert rows(G.find_stems(spark.createDataFrame([("x", ">>..<<.<"), ("y", None)], "id string, ss string"), "id", "ss")) == [("x", 1, 6), ("x", 2, 5)]
    assert [r[0] for r in spark.createDataFrame([(29.4,), (50.5,), (90.0,)], "g double").select(G.gc_model(F.col("g"))).collect()] == [30, 51, 70]


def test_assignment_is_cheapest(spark):
    rng = np.random.default_rng(1)
    for n, m in ((3, 3), (4, 6)):
        c = rng.integers(0, 50, (n, m)).astype(float)
        best = min(sum(c[i, p[i]] for i in range(n)) for p in itertools.permutations(range(m), n))
        assert sum(c[i, j] for i, j in enumerate(G.assign(c))) == best
    df = spark.createDataFrame([(1, "a", "x", 5.0), (1, "a", "y", 1.0), (1, "b", "y", 2.0), (2, "c", "x", 1.0)], "k int, r string, c string, v double")
    assert rows(G.assignments(df, "k", "r", "c", "v")) == [(1, "a", "x"), (1, "b", "y"), (2, "c", "x")]
