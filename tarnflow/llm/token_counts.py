"""Token counts through a digest cache.

Each text's digest and the tokenizer's digest are looked up in a stored table
of counts; only texts whose pair is missing are moved and encoded, each distinct
one once, and their counts are appended to the table.  The table is kept in a
folder for each tokenizer's digest, so others' counts aren't read.
"""

from __future__ import annotations

import hashlib
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import exists, gathered, materialise, scratch, text_or_empty, tune
from .tokenising import encoder, tokenizer_digest

CACHE_SCHEMA = "content_digest binary, tokenizer_digest string, n_tokens long"


def _first_seen(batches):
    """Drops texts whose digest this task had before."""
    seen: set[bytes] = set()
    for b in batches:
        keep = []
        for d in b.column("dg").to_pylist():
            keep.append(d not in seen)
            seen.add(d)
        yield b.filter(pa.array(keep, pa.bool_()))


def _count(path: str, batches):
    seen: set[bytes] = set()
    for b in gathered(batches):
        new = {d: i for i, d in enumerate(b.column("dg").to_pylist()) if d not in seen}
        if not new:
            continue
        seen.update(new)
        texts = b.column("t").take(pa.array(list(new.values()), pa.int64()))
        counts = encoder(path, counts=True).encode(texts)
        yield pa.RecordBatch.from_arrays([pa.array(list(new), pa.binary()), pa.array(counts, pa.int64())], ["dg", "n_tokens"])


def _read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """(dg, n_tokens) of a tokenizer's stored counts, once each."""
    if not exists(spark, cache):
        return spark.createDataFrame([], "dg binary, n_tokens long")
    # Two writers may both have added a text; their counts are the same.
    known = spark.read.schema(CACHE_SCHEMA).parquet(cache).filter(F.col("tokenizer_digest") == version)
    return known.groupBy(F.col("content_digest").alias("dg")).agg(F.max("n_tokens").alias("n_tokens"))


def _append(counts: DataFrame, cache: str, version: str) -> None:
    rows = counts.select(F.col("dg").alias("content_digest"), "n_tokens", F.lit(version).alias("tokenizer_digest"))
    rows.write.mode("append").partitionBy("tokenizer_digest").option("compression", "zstd").parquet(cache)


def compact(spark: SparkSession, cache: str, into: str) -> None:
    """A copy of a cache with each count once and few files, for when many runs
    have added small ones.  It is written beside the old cache, which stays for
    those that still read it."""
    known = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    once = known.groupBy("content_digest", "tokenizer_digest").agg(F.max("n_tokens").alias("n_tokens"))
    once.repartition("tokenizer_digest", F.substring("content_digest", 1, 1)).write.partitionBy("tokenizer_digest").option("compression", "zstd").parquet(into)


#: Missing digests up to this many are sent to all tasks (about 100 bytes
#: each), so that known texts aren't moved; beyond it, texts meet them by digest.
SENT_DIGESTS = 1_000_000


def token_counts(docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit, content_digest) of every row.

    cache: folder of the stored counts; a new one in the shared folder if None.

    Content is normalised by reading null as empty and by nothing else, as any
    other change could change a count.  Null and empty texts count 0 tokens;
    texts of any length are encoded whole; rows that repeat each keep a row; an
    empty table gives an empty result; other columns are not looked at, so
    their names can't clash.
    """
    spark = docs.sparkSession
    tune(spark)
    version = tokenizer_digest(tokenizer)
    cache = cache or scratch(spark, "token-counts")
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("t"))
    keyed = texts.withColumn("dg", F.unhex(F.sha2(F.col("t").cast("binary"), 256)))

    # Digests first: what the cache has is known before any text moves.
    wanted = materialise(keyed.select("dg").distinct().join(_read_cache(spark, cache, version), "dg", "left"), "digests")
    missing = wanted.filter("n_tokens is null").select("dg")
    fresh = missing.count()
    some = keyed.select("dg", "t")
    if wanted.count() > fresh:
        some = some.join(F.broadcast(missing) if fresh <= SENT_DIGESTS else missing, "dg", "left_semi")
    # Copies in one task go before the shuffle, so a digest that a third of
    # all rows share reaches its partition once from each task.
    misses = some.mapInArrow(_first_seen, "dg binary, t string").repartition("dg")
    counted = misses.mapInArrow(partial(_count, tokenizer), "dg binary, n_tokens long")
    # The counts of this table's digests, stored, so that Spark sees two plain
    # sides and can split a digest that very many rows share.
    counts = wanted.filter("n_tokens is not null")
    if fresh:
        new = materialise(counted, "counted")
        _append(new, cache, version)
        counts = counts.unionByName(new)
    rows = keyed.select("doc_id", F.octet_length("t").cast("long").alias("n_bytes"), "dg")
    return rows.join(counts, "dg").select(
        "doc_id",
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
        F.lower(F.hex("dg")).alias("content_digest"),
    )


def content_digest(text: str | None) -> bytes:
    """The digest that the cache keeps for a text."""
    return hashlib.sha256((text or "").encode()).digest()
