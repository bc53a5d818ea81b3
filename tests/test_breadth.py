"""Look-ups, orders and statistics that SQL queries don't reach, against plain
Python."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tarnflow.functions import sequences as Q
from tarnflow.functions import text as X
from tarnflow.operators import annotation, evaluation, features, graph, intervals, populations, registry, windows
from tarnflow.operators import matrices as M
from tarnflow.operators import sets as S
from tarnflow.plans import catalogue


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_common_subsequence(spark, sf):
    rng = random.Random(1)
    for _ in range(200):
        a, b = ("".join(rng.choices("abc", k=rng.randint(0, 30))) for _ in range(2))
        assert X.subsequence_length(a, b) == lcs(a, b)
    got = catalogue.queries()["q_common_subsequence"](spark, sf).collect()
    part = pd.read_parquet(f"{sf}/part.parquet").set_index("p_partkey").p_name
    assert len(got) == sum(k + 1 in part.index for k in part.index)
    for r in got:
        n = lcs(part[r.p_partkey], part[r.p_partkey + 1])
        assert (r.common, r.removed, r.added) == (n, len(r.p_name) - n, len(r.other) - n)


def test_merged_files_equal_one_chain(spark, sf):
    q = catalogue.queries()
    assert rows(q["q_merged_files"](spark, sf).select("event_id")) == rows(q["q_suppress_chain"](spark, sf).select("event_id"))


def test_isotypes(spark):
    df = spark.createDataFrame([("TGC",), ("NNN",), ("TCA",), ("GAT",), ("AG",), ("ygc",)], "a string")
    assert [r[0] for r in df.select(Q.isotype(F.col("a"))).collect()] == ["Ala", "Undet", "Sup", "Ile", "Undet", "Ala"]
    assert [r[0] for r in df.select(Q.isotype(F.col("a"), F.lit("SeC"), {"ATC": "Met"})).collect()][2:4] == ["SeC", "Met"]


def test_redundant_terms_go(spark):
    scores = spark.createDataFrame(
        [("q", "F", "leaf", 1, 2), ("q", "F", "mid", 2, 1), ("q", "F", "other", 3, 3), ("q", "F", "root", 4, 4)], "qpid string, ontology string, goid string, share_rank int, rm3_rank int"
    )
    closure = spark.createDataFrame([("leaf", "leaf", 0), ("leaf", "mid", 1), ("leaf", "root", 2), ("mid", "mid", 0), ("mid", "root", 1), ("other", "other", 0), ("other", "root", 1), ("root", "root", 0)], "node string, ancestor string, distance int")
    out = registry.run(["remove_redundant"], {"term_scores": scores, "closure": closure})["chosen"]
    assert rows(out) == [("q", "rm3", "mid"), ("q", "rm3", "other"), ("q", "share", "leaf"), ("q", "share", "other")]


def test_iterative_terms_in_a_plan(spark):
    hits = [("q1", "sp|A|A", 90.0, 0.8, True), ("q1", "sp|B|B", 80.0, 0.7, True), ("q1", "sp|C|C", 70.0, 0.9, False)]
    sheets = {
        "data": spark.createDataFrame(hits, "qpid string, spid string, bits double, pide double, status boolean"),
        "terms": spark.createDataFrame([("A", "leaf", 0.9), ("A", "mid", 0.9), ("B", "mid", 1.0), ("B", "weak", 0.7), ("B", "gone", 1.0)], "spid string, goid string, weight double"),
        "background": spark.createDataFrame([(t, 5, "F", 50) for t in ("leaf", "mid", "weak")], "goid string, count long, ontology string, root long"),
        "closure": spark.createDataFrame([("leaf", "mid", 1), ("weak", "weak", 0)], "node string, ancestor string, distance int"),
    }
    got = registry.run(["iterative_terms"], sheets)["iterative"]
    # leaf 72; mid 72 + 5, but above leaf; weak 49; gone isn't in the background
    assert rows(got.select("term", F.round("score", 6), "extra", "bits")) == [("leaf", 72.0, 0.0, 90.0)]
    assert "iterative_terms" in registry.names() and annotation.EVERYTHING[-1] == "summary"


def test_tag_markers(spark):
    haplotypes = {"h1": "AAC", "h2": "AGC", "h3": "TAC", "h4": "TGC"}
    df = spark.createDataFrame([("r", h, i, a) for h, s in haplotypes.items() for i, a in enumerate(s)] + [("s", "h1", 0, "A"), ("s", "h2", 0, "T"), ("s", "h1", 1, "A"), ("s", "h2", 1, "G")], "region string, h string, marker int, allele string")
    assert rows(populations.tag_markers(df, "region", "h", "marker", "allele")) == [("r", [0, 1]), ("s", [0]), ("s", [1])]


def test_smoothing_of_long_series(spark):
    rng = random.Random(2)
    data = [(g, i, rng.random(), float(rng.randint(1, 9))) for g in "ab" for i in range(700)]
    df = spark.createDataFrame(data, "g string, i int, x double, n double")
    plain, weighted = (windows.smooth(df, "g", ["i"], "x", 0.75, s).collect() for s in (None, "n"))
    for g in "ab":
        s = w = None
        mine = {r.i: r.smoothed for r in plain if r.g == g}, {r.i: r.smoothed for r in weighted if r.g == g}
        for _, i, x, n in (d for d in data if d[0] == g):
            s = x if s is None else 0.75 * s + 0.25 * x
            w = x if w is None else (0.75 * w * last + 0.25 * x * n) / (0.75 * last + 0.25 * n)
            last = n
            assert mine[0][i] == pytest.approx(s) and mine[1][i] == pytest.approx(w)


def test_running_totals_over_a_whole_table(spark):
    values = random.Random(3).sample(range(10_000), 500)
    df = spark.createDataFrame([(v, v % 7) for v in values], "k int, n int")
    got = {r.k: r.total_n for r in windows.running_totals(df, [F.desc("k")], ["n"]).collect()}
    total = 0
    for v in sorted(values, reverse=True):
        total += v % 7
        assert got[v] == total


def test_database_offsets_follow_the_order(spark):
    df = spark.createDataFrame([(i, "ab" * (i % 5 + 1)) for i in range(50)], "id int, seq string")
    got = sorted((r.id, r.offset) for r in features.split_database(df, "id", 6).collect())
    at = 0
    for i, offset in got:
        assert offset == at
        at += min(6, 2 * (i % 5 + 1)) + 1
    assert features.chunks(features.split_database(df, "id", 6), "id", 100).agg(F.max("chunk")).first()[0] == got[-1][1] // 100


def test_overlaps_of_very_long_intervals(spark):
    rng = random.Random(4)
    make = lambda n: [(k, a, a + rng.choice([0, 5, 300, 40_000, 5_000_000])) for k in range(n) for a in [rng.randint(0, 6_000_000)]]
    a, b = make(60), make(60)
    x, y = spark.createDataFrame(a, "a_id int, a_start long, a_end long").withColumn("g", F.lit(1)), spark.createDataFrame(b, "b_id int, b_start long, b_end long").withColumn("g", F.lit(1))
    got = rows(intervals.overlap_join(x, y, ["g"], 10, F.lit(True)).select("a_id", "b_id"))
    assert got == sorted((i, j) for i, s, e in a for j, u, v in b if u <= e and v >= s)
    most = intervals._levelled(x, F.col("a_start"), F.col("a_end"), 10, "").groupBy("a_id").count().agg(F.max("count")).first()[0]
    assert most <= 2000


def test_one_to_one_pairs_equal_a_plain_scan(spark):
    rng = random.Random(5)
    a, b = ([(k, s, s + rng.randint(0, 6)) for k, s in enumerate(sorted(rng.choices(range(300), k=60)))] for _ in range(2))
    used, want = set(), []
    for i, s, e in a:
        for j, u, v in b:
            if j not in used and u <= e and v >= s:
                used.add(j)
                want.append((1, i, j))
                break
    x, y = spark.createDataFrame([(1, *r) for r in a], "g int, a_id long, a_start long, a_end long"), spark.createDataFrame([(1, *r) for r in b], "g int, b_id long, b_start long, b_end long")
    assert rows(intervals.pair_one_to_one(x, y, ["g"])) == sorted(want)


def test_curve_over_many_thresholds(spark):
    rng = random.Random(6)
    data = [(rng.random(), rng.random() < 0.5, rng.random()) for _ in range(300)]
    df = spark.createDataFrame(data, "tau double, hit boolean, w double")
    truth = spark.createDataFrame([(160, 90.0)], "t long, wt double")
    for r in evaluation.curve(df, truth, "tau", "hit", "w").collect():
        above = [d for d in data if d[0] >= r.tau]
        assert (r.p, r.tp) == (len(above), sum(d[1] for d in above)) and r.wp == pytest.approx(sum(d[2] for d in above))


def test_relatives_by_relation_and_alias(spark):
    e = spark.createDataFrame([("c", "b", "is_a"), ("b", "a", "is_a"), ("c", "x", "part_of"), ("a", "c", "loop")], "child string, parent string, relation string")
    start = spark.createDataFrame([("c",), ("old",)], "n string")
    alias = spark.createDataFrame([("old", "b")], "alias string, id string")
    assert rows(graph.relatives(e, "child", "parent", start, "relation", ("is_a",), aliases=alias)) == [("c", "a", 2), ("c", "b", 1), ("old", "a", 1)]
    assert rows(graph.relatives(e, "child", "parent", spark.createDataFrame([("a",)], "n string"), up=False, depth=1)) == [("a", "b", 1)]
    # A cycle ends.
    assert len(rows(graph.relatives(e, "child", "parent", start))) == 3
    closure = graph.ancestors(e.filter("relation = 'is_a'"), "child", "parent")
    ic = spark.createDataFrame([("a", 0.0), ("b", 1.0), ("c", 3.0)], "term string, ic double")
    pair = spark.createDataFrame([("b", "c"), ("a", "a")], "l string, r string")
    assert rows(graph.resnik(pair, closure, ic, "l", "r")) == [("a", "a", 0.0), ("b", "c", 1.0)]
    assert rows(graph.weighted_jaccard(pair, closure, ic, "l", "r")) == [("a", "a", 0.0), ("b", "c", 0.25)]


def test_components_of_a_long_path(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(150)], "a int, b int")
    assert {c for _, c in rows(graph.components(e, "a", "b"))} == {0}


def test_amplicons_of_both_strands(spark):
    df = spark.createDataFrame([("GGAACCCCTTGG",), ("CCAAGGGGTTCC",)], "s string")
    got = [[(a.strand, a.amplicon) for a in r.a] for r in df.select(features.amplicons_both(F.col("s"), "AA", "TT").alias("a")).collect()]
    assert got == [[(1, "AACCCCTT"), (-1, "AAGGGGTT")], [(1, "AAGGGGTT"), (-1, "AACCCCTT")]]


def test_maps_and_entries(spark):
    df = spark.createDataFrame([({"b": 1, "a": 2, "c": 1},)], "m map<string,int>")
    pairs = lambda c: [tuple(e) for e in df.select(c).first()[0]]
    assert pairs(S.sorted_map(F.col("m"))) == [("a", 2), ("b", 1), ("c", 1)]
    assert pairs(S.sorted_map(F.col("m"), "value", descending=True)) == [("a", 2), ("b", 1), ("c", 1)]
    assert pairs(S.reordered(F.col("m"), F.array(F.lit("c"), F.lit("z"), F.lit("a")))) == [("c", 1), ("a", 2)]
    got = M.log_scores(spark.createDataFrame([(1.0,), (4.0,)], "v double"), "v", reference=4.0).collect()
    assert got[1].reference_score == pytest.approx(0, abs=1e-8) and got[0].reference_score == pytest.approx(1.386294, abs=1e-5)
