"""Queries that read all rows and whole texts, on tables that hold what the
narrower ones leave out."""

import math
import re
from collections import Counter

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tarnflow.functions import text as X
from tarnflow.plans import catalogue

TEXTS = [
    (1, "Straße des Löwen, l'été à Paris: exact example exact ohn' an o-Zug ÄÖÜ ab bald du ihm ab", "de"),
    (2, "Plain words here\nsecond line of words here", "en"),
    (3, "A café — with a dash\tand tab, words\nProtein kinase 2", "en"),
    (4, "los niños words here ıſ", "es"),
    (5, "Rows of no language words here; a long unusual bit of plain prosaic copy", None),
    (6, "", "en"),
    (7, "Kinase (beta) OS=Some species\r\nP53\n\nnaïve a/b-c", "fr"),
    (8, None, "en"),
]
NAMES = ["short", "a name of more than eight characters", "n" * 300]


@pytest.fixture(scope="module")
def few(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("few")
    pd.DataFrame([(i, n) for i, n in enumerate(NAMES)], columns=["p_partkey", "p_name"]).to_parquet(folder / "part.parquet")
    pd.DataFrame(TEXTS, columns=["doc_id", "text", "lang"]).to_parquet(folder / "documents.parquet")
    return str(folder)


def brute_counts():
    return Counter(w for _, t, _ in TEXTS if t for w in re.findall("[A-Z]+", re.sub("[a-z]", lambda m: m[0].upper(), t)))


def run(spark, name, folder):
    return catalogue.queries()[name](spark, folder).collect()


def test_words_of_all_languages_count(spark, few):
    counts = brute_counts()
    assert counts["WORDS"] == 5 and "STRA" in counts and "STRASSE" not in counts
    assert {r.word: r.cnt for r in run(spark, "q_word_counts_all", few)} == counts
    total = sum(counts.values())
    of = {i: {w: math.log(total / counts[w]) for w in re.findall("[A-Z]+", re.sub("[a-z]", lambda m: m[0].upper(), t))} for i, t, _ in TEXTS if t}
    norm = {i: math.sqrt(sum(x * x for x in v.values())) for i, v in of.items()}
    got = {(r.doc_id, r.word): r.idf for r in run(spark, "q_tfidf_words_all", few)}
    assert got == {(i, w): pytest.approx(x, abs=1e-6) for i, v in of.items() for w, x in v.items()}
    assert {r.doc_id: r.norm for r in run(spark, "q_tfidf_norm_all", few)} == {i: pytest.approx(n, abs=1e-5) for i, n in norm.items() if n}
    dot = lambda a, b: sum(x * of.get(b, {}).get(w, 0) for w, x in of.get(a, {}).items())
    want = {(a, a + 1): pytest.approx(dot(a, a + 1) / (norm[a] * norm[a + 1]) if norm.get(a) and norm.get(a + 1) else 0, abs=1e-6) for a in range(1, 8)}
    assert {(r.a, r.b): r.similarity for r in run(spark, "q_desc_similarity_all", few)} == want


@pytest.mark.parametrize("name", ["q_form_factor_all", "q_orf_split_all"])
def test_all_documents_equal_sql(spark, few, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{few}/documents.parquet'")
    got = sorted(tuple(r) for r in run(spark, name, few))
    assert got == sorted(con.execute(catalogue.oracle_sql()[name]).fetchall())
    assert {r[0] for r in got} >= {1, 5}


def test_a_text_is_upper_cased_once(spark, few):
    """Of form factors: the generated code has one call for each way to upper-case."""
    plan = catalogue.queries()["q_form_factor_all"](spark, few)._jdf.queryExecution().executedPlan()
    code = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package").codegenString(plan)
    assert code.count("StringTranslate.exec") == 1 and "ArrayFilter" not in plan.toString()


def test_word_rows_are_not_sorted(spark, few):
    plan = catalogue.queries()["q_tfidf_words_all"](spark, few)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Sort [" not in plan and "filter(split" not in plan and "translate(" not in plan


def test_words_with_codes_count_once(spark):
    words = ["A1B2", "x9", "9X 8y8z", "", "é1", "aé1", "\x0b7a\u00a0B3", "--4c4d e", "PROTEIN", "F5" * 30]
    df = spark.createDataFrame([(" ".join(words[:k]),) for k in range(len(words) + 1)], "t string")
    for upper in (X.ascii_upper, F.upper):
        for r in df.select("t", X.form_factor(F.col("t"), upper).alias("ff")).collect():
            t = re.sub("[a-z]", lambda m: m[0].upper(), r.t) if upper is X.ascii_upper else r.t.upper()
            parts = re.split(r"\s+", t, flags=re.A)
            penalty = 3 + 2 * len(re.sub("[A-Z '-]", "", t)) + 4 * sum(bool(re.search("[A-Z][0-9]", w)) + bool(re.search("[0-9][A-Z]", w)) for w in parts) + 12 * t.startswith("PROTEIN") + 12 * t.endswith("PROTEIN")
            assert r.ff == pytest.approx(1 - penalty / len(r.t) if r.t else 0)


def plain_clean(line):
    t = re.sub(r" \w\w=.*$", "", line.strip(" "), flags=re.A)
    t = re.sub(r"""["/=\\:;,|%.#!<>?_'^+-]""", " ", re.sub(r"[()\[\]{}]", "", t))
    words = [w for w in re.split(r"\s+", t, flags=re.A) if w]
    t = "Hypothetical protein" if len(words) == 1 and re.search("[0-9]", t) else t
    return re.sub("[a-z]", lambda m: m[0].upper(), t).strip(" ")


def test_every_line_is_cleaned(spark, few):
    want = {(i, k): plain_clean(x) for i, t, _ in TEXTS if t is not None for k, x in enumerate(re.split("\r?\n", t))}
    got = {(r.doc_id, r.line): r.cleaned for r in run(spark, "q_clean_text_all", few)}
    assert got == want | {(8, None): None}
    assert got[7, 0] == "KINASE BETA" and got[7, 1] == "HYPOTHETICAL PROTEIN" and got[7, 3] == "NAïVE A B C"


def test_whole_names_have_offsets(spark, few):
    (r,) = run(spark, "q_database_offsets_all", few)
    assert (r.n, r.total, r.overlaps) == (3, sum(len(n) + 1 for n in NAMES), 0)


def test_words_are_dealt_once(spark, few, monkeypatch):
    """Of similarities: the words of a text are taken apart once, for norms and products."""
    from tarnflow.operators import hits

    plans = []
    written = hits.written
    monkeypatch.setattr(hits, "written", lambda df: plans.append(df) or written(df))
    plans.append(catalogue.queries()["q_desc_similarity_all"](spark, few))
    text = [p._jdf.queryExecution().optimizedPlan().toString() for p in plans]
    assert [p.count("Generate explode(k") for p in text] == [1, 0] and "Generate" not in text[1]


def test_varied_sites_gather_no_alleles(spark, monkeypatch):
    """No sort of alleles to find which sites vary, none to give them out."""
    from tarnflow.operators import populations

    plans = []
    written = populations.written
    monkeypatch.setattr(populations, "written", lambda df: plans.append(df) or written(df))
    plans.append(catalogue.queries()["q_alignment_sites"](spark, "/root/testdata/sf0.001"))
    text = [p._jdf.queryExecution().executedPlan().toString() for p in plans]
    assert len(text) == 2 and not any("Sort" in p for p in text) and "Exchange hashpartitioning" not in text[1]


def test_sites_of_whole_sequences_vary(spark, tmp_path):
    """Sequences that differ after their tenth residue alone, of several lengths."""
    rows = [(1, "abcdefghijklmnop qrs", "B1"), (2, "abcdefghijklmnop qst", "B1"), (3, "abcdefghijkl", "B1"), (4, "short", "B2"), (5, "", "B2"), (6, None, "B2")]
    pd.DataFrame(rows, columns=["p_partkey", "p_name", "p_brand"]).to_parquet(tmp_path / "part.parquet")
    got = sorted(tuple(r) for r in run(spark, "q_alignment_sites", str(tmp_path)))
    assert got == [("B1", 18, 1, "C"), ("B1", 18, 2, "G"), ("B1", 19, 1, "G"), ("B1", 19, 2, "T")]
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet'")
        assert sorted(db.execute(catalogue.oracle_sql()["q_alignment_sites"]).fetchall()) == got
