"""One query for each operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cross_tokens, decontam, html_main, importance, kn_lm, line_dedup, near_dup, packing, quality_qda, quality_rules, secrets, token_counts, token_store

BYTE_BPE, WORD_BPE, PIECE_BPE = "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs, F.col("source"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, public_tokenizers.path(BYTE_BPE)).drop("content_digest")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_scan(_table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_qda.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.token_store(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("spans")


def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = F.crc32(F.col("doc_id").cast("string")) % 5 != 1
    return kn_lm.lm_scores(_table(spark, sf_dir, "documents"), learn)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_classes(_table(spark, sf_dir, "documents"), near_dup.NearRule(shingle=2))


def op11_cross_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_tokens.token_links(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.importance_draw(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.main_texts(_table(spark, sf_dir, "pages"))


def queries() -> dict:
    found = (
        op1_line_dedup,
        op2_token_counts,
        op3_packing,
        op4_secret_scan,
        op5_quality_classifier,
        op6_token_store,
        op7_decontamination,
        op8_lm_scores,
        op9_quality_rules,
        op10_near_dedup,
        op11_cross_tokens,
        op12_importance,
        op13_html_text,
    )
    # One rule under two names, as an earlier version had bounds by size.
    return {f.__name__: f for f in found} | {"op1_line_dedup_all": op1_line_dedup}
