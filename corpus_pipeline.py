"""documents -> packed training sequences, in five stages.

Each stage takes what its predecessor kept; all but the last return the
columns of documents.  A stage's result is stored before the next reads it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnflow.llm import decontam, line_dedup, near_dup, packing, quality_rules
from tarnflow.llm.common import exists, scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; null, empty and wordless
    texts are among them.  Rows that repeat get the same verdict each."""
    return quality_rules.kept_rows(docs.select(*COLUMNS))


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are boilerplate of their source go; n_chars follows.  A null
    text or source loses nothing; rows that repeat are pages of their own."""
    cut = line_dedup.drop_boilerplate(docs, F.col("source"), line_dedup.EVERY_SITE)
    return cut.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the least doc_id, a
    document without one only where its group has none.  Shingles are of five
    words, the rule for stages without a contract of their own.  Texts without
    words have no copies; rows that repeat are copies."""
    return near_dup.one_of_each(docs.select(*COLUMNS))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go, with an id or without; a null
    text holds none."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.clean_rows(docs.select(*COLUMNS), benchmark)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048, packed; a null or empty text is one
    end token, and rows that repeat are packed each.  Workers keep fewer words
    than by default, as executors hold what the joins before have left."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), kept=150_000)


STAGES = [
    ("quality_rules", rules_stage),
    ("line_dedup", lines_stage),
    ("near_dedup", near_stage),
    ("decontamination", benchmark_stage),
    ("packing", packing_stage),
]

#: Estimation, sketches and tokenizers are beyond SQL; tests hold run()
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """All stages over documents.  Results of stages go to scratch paths or,
    where a folder is given, to it by name; a run that finds finished ones
    there, as one that died leaves them, goes on from the last."""
    read = f"{sf_dir}/documents.parquet"
    for name, stage in STAGES:
        path = f"{folder}/{name}" if folder else scratch(spark, f"stage-{name}")
        if not (folder and exists(spark, f"{path}/_SUCCESS")):
            stage(spark, spark.read.parquet(read), sf_dir).write.mode("overwrite").parquet(path)
        read = path
    return spark.read.parquet(read)
