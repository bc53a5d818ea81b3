"""Boilerplate of sites of any size."""

import corpus_pipeline
from tarnflow.llm import queries


def test_small_sites_lose_their_boilerplate(spark, frame, tmp_path):
    rows = [(i, f"Menu\nbody {i}", "small") for i in range(10)]
    rows += [(100 + i, f"Footer\ntext {i}" if i < 3 else f"text {i}", "middle") for i in range(50)]
    rows += [(200, "alone\nline", "one"), (201, "copy\nof a page", "two"), (202, "copy\nof a page", "two"), (203, None, "two"), (204, "Menu", None)]
    docs = frame(rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.queries()["op1_line_dedup"](spark, str(tmp_path)).collect()}
    assert [got[i].text for i in (0, 9, 100, 102, 103)] == ["body 0", "body 9", "text 0", "text 2", "text 3"]
    assert (got[201].text, got[201].n_dropped, got[201].all_boilerplate) == ("", 2, True)
    assert sum(r.n_dropped for r in got.values()) == 10 + 3 + 4 and sum(r.all_boilerplate for r in got.values()) == 2
    assert [(got[i].text, got[i].n_dropped) for i in (200, 203, 204)] == [("alone\nline", 0), (None, 0), ("Menu", 0)]
    # Whole pages are left to the pipeline's next stage, which keeps one copy.
    kept = {r.doc_id: r.text for r in corpus_pipeline.lines_stage(spark, docs, str(tmp_path)).collect()}
    assert kept[0] == "body 0" and kept[100] == "text 0" and kept[201] == kept[202] == "copy\nof a page"
