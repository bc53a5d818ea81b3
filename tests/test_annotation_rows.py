"""Every row type of a whole annotation, from its sheets in plain Python."""

import math
from collections import Counter, defaultdict

import pytest

from tarnflow.operators import annotation
from tarnflow.params import Params
from tarnflow.plans import catalogue
from tarnflow.plans.q_annotation import run

HITS = "qpid string, spid string, bits double, qcov double, scov double, pide double, lali double, desc string, species string, isquery string, qseq string, genename string"
NAMES = ["Serine kinase alpha", "Serine kinase", "Serine kinase beta", "Sugar permease", "Sugar permease", "Lone thing"]
GENES = ["serA", "serA", "serA", "db_1", "", "x"]


def hits(q, species, own=True, keep=6):
    rows = [(q, f"sp|A{i}|N", 100.0 - i, 0.9, 0.9, 0.8 - i / 100, 200.0, n, species, "0", "", GENES[i]) for i, n in enumerate(NAMES[:keep])]
    return rows + ([(q, q, 0.0, 1.0, 1.0, 1.0, 200.0, f" Query {q} protein ", species, "1", "MKV", "")] if own else [])


@pytest.fixture(scope="module")
def sheets(spark):
    frame = spark.createDataFrame
    terms = [("A0", "T1"), ("A0", "P"), ("A1", "T2"), ("A1", "P"), ("A2", "T1"), ("A2", "P"), ("A3", "U"), ("A4", "U"), ("A5", "V")]
    up = [("T1", "P"), ("T2", "P"), ("P", "R"), ("T1", "R"), ("T2", "R"), ("U", "R"), ("V", "R")]
    return {
        "data": frame(hits("qa", "E1") + hits("qb", "B1") + hits("qc", "B1", own=False, keep=3) + hits("qd", "B1", keep=0), HITS),
        "lineage": frame([("E1", "Eukaryota; A; Y"), ("B1", "Bacteria; A; Y")], "species string, lineage string"),
        "words": frame([("SERINE", 20), ("KINASE", 30), ("ALPHA", 400), ("BETA", 400), ("SUGAR", 20), ("PERMEASE", 10), ("LONE", 2), ("THING", 5)], "word string, cnt long"),
        "descriptions": frame([("SERINE KINASE", 40), ("SERINE KINASE ALPHA", 5), ("SUGAR PERMEASE", 60), ("LONE THING", 1)], "plain string, cnt long"),
        "terms": frame(terms, "spid string, goid string"),
        "background": frame([(g, n, "BP", 1000) for g, n in (("T1", 10), ("T2", 12), ("P", 40), ("U", 9), ("V", 3), ("R", 1000))], "goid string, count long, ontology string, root long"),
        "closure": frame([(a, b, 1) for a, b in up] + [(x, x, 0) for x in ("T1", "T2", "P", "U", "V", "R")], "node string, ancestor string, distance int"),
        "external": frame([("T1", "ec", "2.7.1.1"), ("P", "kegg", "."), ("T2", "kegg", "K1")], "goid string, kind string, id string"),
        "term_names": frame([("T1", "term one"), ("T2", "term two")], "goid string, name string"),
    }


def curve(score, kingdom):
    if kingdom == "euk":
        return max(0.0, -1.253 + 2.295 * score) if score < 0.705 else min(1.0, -0.05199 + 0.66827 * score - 0.10945 * score**2) if score < 3.05855 else 0.9680758
    return max(0.0, -0.5057 + 1.4713 * score - 0.3757 * score**2) if score < 1.322 else min(1.0, 0.77258 - 0.01382 * score + 0.01632 * score**2)


@pytest.mark.parametrize("best_only", [True, False])
def test_every_row_type(sheets, best_only):
    out = run(annotation.ANNOTATE, sheets, Params(best_cluster_only=best_only))
    scored = out["term_scores"].collect()
    rows = defaultdict(list)
    for r in out["anno"].collect():
        rows[r.qpid, r.type].append((r.score, r.ppv, r.id, r.desc))
    data = [r for r in out["data"].collect()]
    assert {r.qpid for r in data} == {"qa", "qb", "qc"} and not any(r.spid == r.qpid for r in data)
    kingdom = {"qa": "euk", "qb": "bac", "qc": "bac"}
    assert "qd" not in {q for q, _ in rows}
    ff = {r.desc: r.ff for r in data}

    # The query's own rows.
    for q, want, seq in (("qa", "Query qa protein", "MKV"), ("qb", "Query qb protein", "MKV"), ("qc", "", "")):
        ((score, ppv, _, desc),) = rows[q, "original_DE"]
        assert (score, ppv, desc) == (kingdom[q], "n.d.", want) and rows[q, "qseq"] == [("n.d.", "n.d.", "n.d.", seq)]

    # Clusters: sizes and backgrounds from the hits; what is all of its background goes.
    known = {"SERINE KINASE": 40, "SERINE KINASE ALPHA": 5, "SUGAR PERMEASE": 60, "LONE THING": 1}
    by = defaultdict(list)
    for r in data:
        if r.de_status:
            by[r.qpid, r.clusid].append(r)
    sheet = {(r.qpid, r.clusid): r for r in out["clusters"].collect()}
    want = {}
    for key, mine in by.items():
        background = sum(known.get(x, 1) for x in {r.plain for r in mine})
        if len(mine) != background and sum(r.rm1 for r in mine):
            want[key] = (len(mine), background, max(mine, key=lambda r: (r.ff, r.bits, r.desc)).desc)
    assert {k: (r.size, r.cnt, r.desc) for k, r in sheet.items()} == want and len(want) < len(by)
    for q in kingdom:
        mine = sorted((r for k, r in sheet.items() if k[0] == q), key=lambda r: (-r.rm2, r.plain))
        for r in mine:
            members = by[q, r.clusid]
            value, jac = (sum(getattr(m, c) for m in members) / len(members) for c in ("value", "jaccard"))
            squashed = value if value <= 1 else 1 + math.log(value)
            assert r.rm2 == pytest.approx(0.59 + 0.53 * squashed + 0.02 * jac + 0.0004 * r.gsz)
        shown = mine[:1] if best_only else mine
        got = sorted((d, float(s), float(p), float(i)) for s, p, i, d in rows[q, "DE"])
        for (d, *numbers), r in zip(got, sorted(shown, key=lambda r: (r.desc, r.rm2)), strict=True):
            assert d == r.desc and numbers == pytest.approx([r.rm2, curve(r.rm2, kingdom[q]), ff[r.desc]])
        # serA has 3 of 4 names in qa and qb (database ids don't count), 3 of 3 in qc.
        votes = Counter(r.genename for r in data if r.qpid == q and r.de_status and r.genename and "_" not in r.genename)
        name, n = votes.most_common(1)[0]
        gene = [("n.d.", "n.d.", "n.d.", name)] * len(shown) if n > 0.5 * (1 + sum(votes.values())) else []
        assert rows[q, "GN"] == gene and gene

        # Terms: of the best cluster's hits only, by each predictor, no term beside its parent.
        inside = {r.spid for r in data if r.qpid == q and r.clusid == mine[0].clusid}
        assert {r.spid for r in data if r.qpid == q and r.status} == inside
        scores = [r for r in scored if r.qpid == q]
        parents = {"T1": {"P", "R"}, "T2": {"P", "R"}, "P": {"R"}, "U": {"R"}, "V": {"R"}}
        for k in ("rm3", "share", "jac", "hyge"):
            taken, rejected = [], set()
            for r in sorted(scores, key=lambda r: r[f"{k}_rank"]):
                if r.goid in rejected or r.goid not in parents or parents[r.goid] & set(taken):
                    continue
                taken.append(r.goid)
                rejected |= parents[r.goid]
            expected, extra = {}, []
            for r in scores:
                if r.goid in taken and r[f"{k}_score"] > 0:
                    expected[r.goid] = (r[f"{k}_score"], r[f"{k}_ppv"], {"T1": "term one", "T2": "term two"}.get(r.goid, ""))
                    extra += [(kind, x, f"GO:{r.goid}") for g, kind, x in (("T1", "EC", "2.7.1.1"), ("T2", "KEGG", "K1")) if g == r.goid]
            got = {i: (float(s), float(p), d) for s, p, i, d in rows[q, f"BP_{k.upper()}"]}
            assert got == {g: (pytest.approx(s), pytest.approx(p), d) for g, (s, p, d) in expected.items()}
            assert sorted((kind, i, d) for kind in ("EC", "KEGG") for _, _, i, d in rows[q, f"{kind}_{k.upper()}"]) == sorted(extra)


def test_query_over_tables(spark, sf):
    got = catalogue.queries()["q_annotation_rows"](spark, sf).toPandas()
    blocks = got.groupby("type").qpid.nunique()
    assert blocks["original_DE"] == blocks["qseq"] >= blocks["DE"] > 0 and {"TYPE_RM3", "BRAND_SHARE", "EC_JAC", "GN"} & set(got.type) >= {"TYPE_RM3", "EC_JAC"}
    assert not got[got.type == "original_DE"].qpid.duplicated().any() and not got[got.type == "DE"].qpid.duplicated().any()
    assert set(got[got.type == "original_DE"].score) == {"euk", "bac"}
