"""Rows without an id, in every operator."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tarnflow.llm import decontam, kn_lm, line_dedup, near_dup, packing, quality_qda, quality_rules, secrets, token_counts, token_store

ROWS = [(None, "Some words that a document holds here", "a"), (None, None, None), (3, "Some words that a document holds here", "a"), (4, None, "a"), (None, "password=Abc123xyz789Q alone", "b")]
BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))

OPERATORS = {
    "lines": lambda d, s: line_dedup.drop_boilerplate(d.select("doc_id", "source", "text"), F.col("source")),
    "counts": lambda d, s: token_counts.token_counts(d, BYTE),
    "packing": lambda d, s: packing.pack_documents(d, WORD),
    "secrets": lambda d, s: secrets.secret_scan(d),
    "classifier": lambda d, s: quality_qda.quality_scores(d, s.createDataFrame([(3, 1), (4, 0), (None, 1), (3, None)], "doc_id long, quality int")),
    "store": lambda d, s: token_store.token_store(d, BYTE),
    "benchmark": lambda d, s: decontam.contamination(d, s.createDataFrame([(None, "a document holds"), (2, None)], "item_id long, text string")),
    "model": lambda d, s: kn_lm.lm_scores(d, F.crc32(F.col("doc_id").cast("string")) % 5 != 1),
    "rules": lambda d, s: quality_rules.quality_rules(d),
    "near": lambda d, s: near_dup.near_classes(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_has_a_result(spark, frame, name):
    got = OPERATORS[name](frame(ROWS), spark).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in ROWS)


def test_copy_without_an_id(frame):
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in near_dup.near_classes(frame(ROWS)).collect()}
    assert got[None, 3] == (3, False) and got[3, 3] == (3, True) and got[None, 1] == (None, True)


def test_pipeline_keeps_rows_without_an_id(spark, frame, tmp_path):
    text = " ".join(f"word{i} and more of it." for i in range(40))
    docs = frame([(None, text, "a"), (1, "Another " + text[::-1], "a")]).select(*corpus_pipeline.COLUMNS)
    spark.createDataFrame([(1, "nothing of the sort")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[2:4]:
        assert stage(spark, docs, str(tmp_path)).count() == 2, name
