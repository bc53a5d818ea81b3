"""The annotation queries' single pass against their operators one after another."""

import numpy as np
import pandas as pd
import pytest

from tarnflow.operators import annotation
from tarnflow.plans import catalogue, q_annotation

QUERIES = {"q_describe_all": ("DESCRIBE", "cluster"), "q_predict_terms": ("PREDICT", "term_scores"), "q_full_annotation": ("EVERYTHING", "findings"), "q_annotation_rows": ("ANNOTATE", "anno")}


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    """Twins, missing and null keys, descriptions that say nothing, a block of more
    than the most hits, orders without hits and hits without orders."""
    folder, rng = tmp_path_factory.mktemp("odd"), np.random.default_rng(5)
    names = ["serine kinase alpha", "serine kinase", "Sugar (permease) OS=X", "sugar permease", "P53", "", None, "db_1 kinase kinase", "putative protein"]
    types = ["LARGE", "SMALL BRUSHED", "SMALL PLATED", "LARGE TIN", None]
    part = pd.DataFrame([(i, names[i % 9], types[i % 5], f"B{i % 4}") for i in range(60)] + [(None, "lone name", "LARGE", "B1")], columns=["p_partkey", "p_name", "p_type", "p_brand"]).astype({"p_partkey": "Int64"})
    supplier = pd.DataFrame([(i, None if i == 3 else f"S{i % 9}", i % 5 if i != 4 else 77) for i in range(12)], columns=["s_suppkey", "s_name", "s_nationkey"])
    n = 700
    orders = np.where(np.arange(n) < 230, 0, rng.integers(1, 60, n))
    line = pd.DataFrame({"l_orderkey": orders, "l_partkey": rng.integers(0, 63, n), "l_suppkey": rng.integers(0, 14, n), "l_linenumber": rng.integers(1, 4, n)}).astype("Int64")
    line = line.assign(l_quantity=rng.integers(20, 51, n) * 1.0, l_extendedprice=rng.integers(1, 400, n) * 1.0, l_discount=rng.integers(0, 70, n) / 100, l_tax=rng.integers(0, 50, n) / 100)
    line.loc[300:310, "l_orderkey"], line.loc[311:330, "l_partkey"], line.loc[331:350, "l_suppkey"], line.loc[351:360, "l_extendedprice"] = None, None, None, None
    line = pd.concat([line, line[400:440]])
    own = pd.DataFrame([(i, ["1-URGENT", " 5-LOW"][i % 2], ["O", "F", None][i % 3]) for i in range(3, 70)] + [(5, "2-HIGH", "F")], columns=["o_orderkey", "o_orderpriority", "o_orderstatus"])
    nation = pd.DataFrame([(i, f"N{i}", i % 2) for i in range(5)], columns=["n_nationkey", "n_name", "n_regionkey"])
    region = pd.DataFrame([(0, "EUROPE"), (1, "AFRICA")], columns=["r_regionkey", "r_name"])
    for name, df in (("part", part), ("supplier", supplier), ("lineitem", line), ("orders", own), ("nation", nation), ("region", region)):
        df.to_parquet(folder / f"{name}.parquet", index=False)
    return str(folder)


def rows(df) -> list[str]:
    def plain(c, x):
        if c.endswith("_rank"):
            return ""  # ties of scores may differ in their last place
        try:
            return "none" if x is None or x != x else f"{float(x):.6g}"
        except ValueError:
            return x

    return sorted("|".join(plain(c, x) for c, x in r.asDict().items()) for r in df.collect())


@pytest.mark.parametrize("name", QUERIES)
def test_one_pass_gives_what_the_operators_give(spark, odd, name, monkeypatch):
    plan, sheet = QUERIES[name]
    t = q_annotation.Tables(spark, odd)
    found = q_annotation.run(getattr(annotation, plan), q_annotation.annotated_sheets(t) if plan == "ANNOTATE" else q_annotation.sheets(t))[sheet]
    # Nothing is stored between operators, and hits are dealt once.
    monkeypatch.setattr(q_annotation, "written", None)
    assert catalogue.queries()[name](spark, odd)._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM") == 1
    if plan in ("PREDICT", "ANNOTATE"):
        monkeypatch.setattr(q_annotation, "SENT", 0)
    got = q_annotation.in_one_pass(t, {"DESCRIBE": "describe", "PREDICT": "predict", "EVERYTHING": "full", "ANNOTATE": "annotate"}[plan])
    one = rows(got)
    assert len(one) > 40 and one == rows(found.select(got.columns))


def test_many_texts_or_repeated_keys_take_the_operators(spark, odd, tmp_path, monkeypatch):
    t = q_annotation.Tables(spark, odd)
    with monkeypatch.context() as m:
        m.setattr(q_annotation, "MOST", 5)
        assert all(q_annotation.in_one_pass(t, what) is None for what in q_annotation.FIELDS)
    part = pd.read_parquet(f"{odd}/part.parquet")
    for name in ("lineitem", "supplier", "orders", "nation", "region"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{odd}/{name}.parquet")
    pd.concat([part, part[:1]]).to_parquet(tmp_path / "part.parquet")
    assert q_annotation.in_one_pass(q_annotation.Tables(spark, str(tmp_path)), "predict") is None
