"""The annotation plans over the standard tables."""

import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from tarnflow.functions import scores
from tarnflow.operators import annotation, clustering, registry
from tarnflow.params import Params
from tarnflow.plans import catalogue, q_annotation


@pytest.fixture(scope="module")
def lines(sf):
    table = lambda n: pd.read_parquet(f"{sf}/{n}.parquet")
    x = table("lineitem").merge(table("part"), left_on="l_partkey", right_on="p_partkey")
    return x[(x.l_quantity / 50 >= 0.6) & (1 - x.l_tax >= 0.6) & (1 - x.l_discount >= 0.4)]


def test_every_described_block_has_word_scores(spark, sf, lines):
    got = catalogue.queries()["q_describe_all"](spark, sf).toPandas()
    assert not got.qpid.duplicated().any()
    assert set(got.qpid) <= set(lines.l_orderkey) and len(got) > 0.9 * lines.l_orderkey.nunique()
    assert (got.val > 0).all() and (got.jac > 0).all()
    names = lines.groupby("l_orderkey").p_name.agg(set)
    for r in got.itertuples():
        assert r.desc in names[r.qpid]
        z = r.val if r.val <= 1 else 1 + math.log(r.val)
        assert r.rm2 == pytest.approx(0.59 + 0.53 * z + 0.02 * r.jac + 0.0004 * r.gsz, abs=1e-5)
    findings = catalogue.queries()["q_full_annotation"](spark, sf).toPandas()
    de = findings[findings.type == "DE"].set_index("qpid")
    assert de.id.to_dict() == got.set_index("qpid").desc.to_dict()
    assert {"TYPE_SHARE", "BRAND_RM3"} <= set(findings.type)


def test_terms_of_all_accepted_hits(spark, sf, lines):
    got = catalogue.queries()["q_predict_terms"](spark, sf).toPandas()
    want = Counter((r.l_orderkey, x) for r in lines.itertuples() for x in (r.p_type, r.p_brand))
    assert {(r.qpid, r.goid): r.k for r in got.itertuples()} == dict(want)
    assert (got[got.share_rank == 1].groupby(["qpid", "ontology"]).size() == 1).all()


def test_worded_variants_are_one_cluster(spark):
    descs = ["Serine kinase alpha", "Serine kinase", "Serine kinase beta", "Sugar permease", "Sugar permease"]
    hits = [("q", f"A{i}", 100.0 - i, 0.9, 0.9, 0.8 - i / 100, 200.0, x, "S1") for i, x in enumerate(descs)]
    words = {"SERINE": 20, "KINASE": 30, "ALPHA": 400, "BETA": 400, "SUGAR": 20, "PERMEASE": 10}
    sheets = {
        "data": spark.createDataFrame(hits, "qpid string, spid string, bits double, qcov double, scov double, pide double, lali double, desc string, species string"),
        "lineage": spark.createDataFrame([("S1", "Bacteria; A; Y")], "species string, lineage string"),
        "words": spark.createDataFrame(list(words.items()), "word string, cnt long"),
        "descriptions": spark.createDataFrame([("SERINE KINASE", 40), ("SERINE KINASE ALPHA", 5), ("SUGAR PERMEASE", 60)], "plain string, cnt long"),
    }
    out = registry.run(annotation.DESCRIBE, sheets)
    ids = {r.spid: r.clusid for r in out["data"].collect()}
    assert ids["A0"] == ids["A1"] == ids["A2"] != ids["A3"] == ids["A4"]
    (best,) = out["cluster"].collect()
    # Counts of the variants; the unknown one counts once.
    assert (best.desc, best.size, best.cnt) == ("Serine kinase alpha", 3, 46)
    cut = registry.run(annotation.DESCRIBE, sheets, Params(cluster_cut=0.0001))["data"]
    assert cut.select("clusid").distinct().count() == 4


def test_sheets_are_stored_as_files_without_columns_that_are_done_with(spark, sf):
    t = q_annotation.Tables(spark, sf)
    sheets = q_annotation.sheets(t)
    own = {name: sheets[name].inputFiles() for name in ("words", "descriptions", "terms", "background", "lineage")}
    assert all(files and not any(f.startswith(f"file://{sf}") for f in files) for files in own.values())
    data = q_annotation.run(annotation.DESCRIBE[:-1], sheets)["data"]
    assert data.inputFiles() and not {"word", "termidf", "qcov", "taxdist"} & set(data.columns)
    assert {"qpid", "spid", "clusid", "value", "jaccard", "rm1", "plain"} <= set(data.columns)


def test_names_that_repeat_have_one_lineage(spark, sf, tmp_path):
    """Else each of a name's hits would be repeated."""
    for n in ("lineitem", "part", "nation", "region"):
        (tmp_path / f"{n}.parquet").symlink_to(f"{sf}/{n}.parquet")
    one = pd.read_parquet(f"{sf}/supplier.parquet")
    pd.concat([one, one.assign(s_suppkey=one.s_suppkey + 10**6, s_nationkey=(one.s_nationkey + 1) % 25)]).to_parquet(tmp_path / "supplier.parquet")
    got = q_annotation.sheets(q_annotation.Tables(spark, str(tmp_path)))["lineage"].toPandas()
    assert not got.species.duplicated().any() and set(got.species) == set(one.s_name)


def test_maps_cluster_as_vectors_do(spark):
    """Blocks that end within batches, of one row, without words, and of several sizes."""
    rng = random.Random(2)
    rows = [(q, f"s{i}", {rng.choice("äbcdEf"): rng.choice([0.5, 1.0, 2.25]) for _ in range(rng.randint(q % 11 > 0, 4))}) for q in range(60) for i in range(rng.randint(1, 9))]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.createDataFrame(rows, "q int, s string, m map<string,double>")
        got = {(r.q, r.s): r.clusid for r in clustering.cluster_maps(df, "q", "s", "m", 0.4).collect()}
        nothing = clustering.cluster_maps(df.filter("q < 0"), "q", "s", "m").count()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {}
    for q in range(60):
        mine = sorted((r for r in rows if r[0] == q), key=lambda r: r[1])
        words = sorted({w for r in mine for w in r[2]})
        found = clustering.average_linkage(np.array([[r[2].get(w, 0.0) for w in words] for r in mine]).reshape(len(mine), -1), 0.4)
        want |= {(q, r[1]): k for r, k in zip(mine, found.tolist())}
    assert got == want and nothing == 0 and max(got.values()) > 2


def test_equal_tails_are_worked_out_once(monkeypatch):
    scores._tail.cache_clear()
    asked, plain = [], scores.hyper_tail
    monkeypatch.setattr(scores, "hyper_tail", lambda *r: asked.append(r) or plain(*r))
    x = [pd.Series(c) for c in ([3, 1, 3, 2], [90, 90, 90, 90], [7, 7, 7, 5], [20, 20, 20, 9])]
    for _ in range(3):
        assert scores._tails(*x).tolist() == [plain(*(int(c[i]) for c in x)) for i in range(4)]
    assert len(asked) == 3
