"""Operators on small frames."""

import pytest
from pyspark.sql import functions as F

from tarnflow.operators import annotation, graph, intervals, joins, registry, sets
from tarnflow.operators import hits as H
from tarnflow.params import Params


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_overlap_join_over_bins(spark):
    a = spark.createDataFrame([(1, 1, 0, 100), (1, 2, 250, 260), (2, 3, 0, 5)], "g int, a_id int, a_start int, a_end int")
    b = spark.createDataFrame([(1, 7, 50, 255), (1, 8, 101, 249), (2, 9, 6, 9)], "g int, b_id int, b_start int, b_end int")
    assert rows(intervals.overlap_join(a, b, ["g"], 10, F.lit(True)).select("a_id", "b_id")) == [(1, 7), (2, 7)]
    assert rows(intervals.overlap_join(a, b, ["g"], 10, F.lit(True), reach=1).select("a_id", "b_id")) == [(1, 7), (1, 8), (2, 7), (2, 8), (3, 9)]


def test_islands_touching_and_nested(spark):
    df = spark.createDataFrame([(1, 1, 0, 10, 1), (1, 2, 2, 3, 2), (1, 3, 10, 12, 4), (1, 4, 13, 14, 1)], "g int, i int, s int, e int, src int")
    assert rows(intervals.merge(df, ["g"], "s", "e", ["i"], "src").select("s", "e", "members", "src")) == [(0, 12, 3, 7), (13, 14, 1, 1)]


def test_closure_of_a_diamond(spark):
    e = spark.createDataFrame([(4, 2), (4, 3), (2, 1), (3, 1), (5, 4)], "c int, p int")
    up = graph.ancestors(e, "c", "p")
    assert rows(up.filter("node = 5")) == [(5, 1, 3), (5, 2, 2), (5, 3, 2), (5, 4, 1), (5, 5, 0)]
    with pytest.raises(ValueError):
        graph.ancestors(spark.createDataFrame([(i, i + 1) for i in range(6)], "c int, p int"), "c", "p", depth=3)


def test_propagated_weight_is_greatest(spark):
    up = graph.ancestors(spark.createDataFrame([(3, 1), (2, 1)], "c int, p int"), "c", "p")
    a = spark.createDataFrame([("x", 3, 0.4), ("x", 2, 0.9)], "acc string, term int, w double")
    assert rows(graph.propagate_weight(a, up, "acc", "term", "w")) == [("x", 1, 0.9), ("x", 2, 0.9), ("x", 3, 0.4)]


def test_components_of_a_path_and_a_star(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(9)] + [(20, i) for i in range(21, 25)], "a int, b int")
    assert rows(graph.components(e, "a", "b")) == [(i, 0) for i in range(10)] + [(i, 20) for i in range(20, 25)]


def test_dictionary_defaults(spark):
    d = spark.createDataFrame([("abc", "L")], "k string, lineage string")
    df = spark.createDataFrame([("ABC",), ("x",), (None,)], "species string")
    assert [r.lineage for r in joins.lookup(df, F.col("species"), d, "k", {"lineage": "unclassified"}, upper=True).collect()] == ["L", "unclassified", "unclassified"]


def test_every_pair_checks_its_size(spark):
    with pytest.raises(ValueError):
        joins.every_pair(spark.range(3), spark.range(5), most_rows=4)
    assert joins.every_pair(spark.range(3), spark.range(2).withColumnRenamed("id", "x")).count() == 6


def test_set_relations(spark):
    df = spark.createDataFrame([([1, 2], [1, 2]), ([1], [1, 2]), ([1, 2], [1]), ([1], [2]), ([1, 2], [2, 3])], "a array<int>, b array<int>")
    assert [r[0] for r in df.select(sets.compare(F.col("a"), F.col("b"))).collect()] == ["equal", "subset", "superset", "disjoint", "overlap"]


def test_unknown_operator_and_missing_column(spark):
    with pytest.raises(KeyError, match="no operator"):
        registry.run(["nothing"], {})
    with pytest.raises(KeyError, match="lacks"):
        registry.run(["filter"], {"data": spark.range(1)})
    assert registry.run(["identity"], {"data": spark.range(2)})["data"].count() == 2


def test_params_from_session(spark):
    spark.conf.set("spark.tarnflow.max_hits", "7")
    spark.conf.set("spark.tarnflow.strict", "false")
    p = Params.from_session(spark)
    spark.conf.unset("spark.tarnflow.max_hits")
    spark.conf.unset("spark.tarnflow.strict")
    assert p.max_hits == 7 and p.strict is False and p.cluster_cut == 0.7


def test_annotation_plan(spark):
    hits = [
        ("q1", f"sp|A{i}|A{i}_X", 100.0 - i, 0.9, 0.9, 0.8, 200.0, "Serine kinase" if i < 4 else "Lipid transport factor", f"S{i % 3}") for i in range(6)
    ] + [("q2", "sp|B1|B1_X", 50.0, 0.9, 0.9, 0.7, 90.0, "Sugar permease", "S1"), ("q2", "sp|B2|B2_X", 40.0, 0.1, 0.9, 0.7, 90.0, "Sugar permease", "S1")]
    sheets = {
        "data": spark.createDataFrame(hits, "qpid string, spid string, bits double, qcov double, scov double, pide double, lali double, desc string, species string"),
        "lineage": spark.createDataFrame([("s0", "Bacteria; A; X"), ("s1", "Bacteria; A; Y")], "species string, lineage string"),
        "terms": spark.createDataFrame([(f"A{i}", g) for i in range(6) for g in ("1", "2")] + [("B1", "2"), ("B1", "0")], "spid string, goid string"),
        "background": spark.createDataFrame([("0", 1000, "MF", 1000), ("1", 20, "MF", 1000), ("2", 300, "MF", 1000)], "goid string, count long, ontology string, root long"),
        "words": spark.createDataFrame([("SERINE", 30), ("KINASE", 90)], "word string, cnt long"),
        "descriptions": spark.createDataFrame([("SERINE KINASE", 40), ("SUGAR PERMEASE", 60)], "plain string, cnt long"),
        "external": spark.createDataFrame([("1", "ec", "2.7.1.1")], "goid string, kind string, id string"),
    }
    out = registry.run(annotation.EVERYTHING, sheets, Params(max_hits=5))
    assert out["data"].filter("status").count() == 6
    best = {r.qpid: r.desc for r in out["cluster"].collect()}
    assert best == {"q1": "Serine kinase", "q2": "Sugar permease"}
    classes = {(r.qpid, r.goid): r for r in out["term_scores"].collect()}
    assert set(classes) == {("q1", "1"), ("q1", "2"), ("q2", "2")} and classes["q1", "1"].share_rank == 1 and classes["q1", "1"].k == 5
    findings = out["findings"].toPandas()
    assert {"MF_SHARE", "EC_SHARE", "DE"} <= set(findings.type) and (findings.score > 0).all()


def test_majority_and_vote(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (1, "b"), (2, "c"), (2, "d"), (2, None)], "g int, v string")
    assert rows(H.majority(df, ["g"], "v").select("g", "v")) == [(1, "a")]
    assert rows(H.vote(df.filter("g = 1"), ["g"], "v", 1).select("v", "count", "total", "rank")) == [("a", 3, 4, 1)]


def test_histogram_median(spark):
    df = spark.createDataFrame([(1, 0, 5), (1, 40, 2), (1, 50, 4), (2, 10, 1), (3, 0, 9)], "g int, bin int, n long")
    assert rows(H.histogram_median(df, ["g"])) == [(1, 50), (2, 10), (3, 100)]
