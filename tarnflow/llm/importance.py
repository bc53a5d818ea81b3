"""Importance resampling towards a target set of texts.

Features are runs of up to n words, hashed into buckets.  A bucket's gain is the
log ratio of its share in the target and in the source; a document's weight is
the mean gain of its features, and adding Gumbel noise to it turns taking the
best scores into drawing without replacement.

A document's features come from one scan: a ring keeps the running CRC states of
the last n starts, each of which a word (with a blank before it) extends, so no
run is ever put together as a string.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, spread, text_or_empty, tune

#: A-Z in lower case, 0-9 and a-z as they are, other ASCII as a blank; bytes of
#: other characters belong to words.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


@dataclass(frozen=True)
class DrawRule:
    """Runs of 1 to ``runs`` words in ``buckets`` buckets; ``percent`` of the
    documents of ``least_words`` or more are drawn with the noise of ``seed``."""

    runs: int = 1
    buckets: int = 10_000
    percent: int = 10
    least_words: int = 20
    seed: str = "2024"


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


def run_states(words: list[bytes], n: int) -> list[int]:
    """CRC-32 of every run of 1 to n words, joined by one blank: after each word
    the states of the runs that end there, longest first."""
    if n == 1:  # a ring of one state, which each word replaces
        return list(map(zlib.crc32, words))
    ring: list[int] = []
    out: list[int] = []
    crc = zlib.crc32
    for word in words:
        longer = b" " + word
        ring = [crc(longer, state) for state in ring[-(n - 1) :]]
        ring.append(crc(word))
        out += ring
    return out


def _buckets(rule: DrawRule, text: str) -> tuple[int, np.ndarray]:
    words = words_of(text)
    return len(words), np.array(run_states(words, rule.runs), np.int64) % rule.buckets


def _totals(rule: DrawRule, batches):
    """(bucket, n) of a task's texts."""
    total = np.zeros(rule.buckets, np.int64)
    for b in batches:
        for text in b.column("t"):
            total += np.bincount(_buckets(rule, text.as_py())[1], minlength=rule.buckets)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])


def _weights(rule: DrawRule, gains: np.ndarray, batches):
    for b in batches:
        words, features, weights = [], [], []
        for text in b.column("t"):
            n, found = _buckets(rule, text.as_py())
            words.append(n)
            features.append(len(found))
            weights.append(int(gains[found].sum()) // len(found) if len(found) else 0)
        counts = [pa.array(x, pa.int64()) for x in (words, features, weights)]
        yield pa.RecordBatch.from_arrays([b.column("id"), *counts], ["id", "n_words", "n_features", "weight"])


def bucket_counts(texts: DataFrame, rule: DrawRule = DrawRule(), text_col: str = "text") -> np.ndarray:
    """How many features of all texts fall in each bucket.  Tasks add up their own
    texts, so the shuffle and the driver get a row for each bucket and task, and
    each bucket, at most."""
    rows = spread(texts.select(text_or_empty(text_col).alias("t"))).mapInArrow(partial(_totals, rule), "bucket long, n long")
    out = np.zeros(rule.buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share in the target over its
    smoothed share in the source."""
    buckets, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    ratio = ((target + 1.0) * float(s_all + buckets)) / ((source + 1.0) * float(t_all + buckets))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio.tolist()], np.int64)


def _noise(seed: str):
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def importance_draw(docs: DataFrame, target: DataFrame, rule: DrawRule = DrawRule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_features, weight, score, rank) of every row; rank counts from 1 in
    the order of falling scores, ties by id, and is null if a row isn't drawn.

    Null and empty texts have no features and weight 0; a row without an id has
    noise as an empty id would and comes last among ties; rows that repeat are
    rows of their own, with one rank each; empty tables, of documents or of the
    target, are allowed; other columns aren't looked at, so their names can't
    clash.  Texts are read whole.

    What the driver sees is bounded by the rule: a count for each bucket, then a
    count for each integer score.  Ranks are the rows above a score, from these
    counts, and the place within it, from a window over rows of one score; the
    noise deals even equal weights to thousands of scores.
    """
    tune(docs.sparkSession)
    gains = bucket_gains(bucket_counts(docs, rule, text_col), bucket_counts(target, rule, text_col))
    texts = spread(docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("t")))
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, n_words long, n_features long, weight long"
    weighed = texts.mapInArrow(partial(_weights, rule, gains), schema)
    scored = materialise(weighed.withColumn("score", F.col("weight") + _noise(rule.seed)), "importance")

    able = F.col("n_words") >= rule.least_words
    by_score = sorted(((r.score, r.n) for r in scored.filter(able).groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    draw = rule.percent * sum(n for _, n in by_score) // 100
    above, seen = [], 0
    for score, n in by_score:
        if seen >= draw:
            break
        above.append((score, seen))
        seen += n
    kept = ["n_features", "weight", "score"]
    if not above:
        return scored.select(F.col("id").alias(id_col), *kept, F.lit(None).cast("long").alias("rank"))
    from pyspark.sql import Window

    enough = able & (F.col("score") >= above[-1][0])
    in_order = Window.partitionBy("score").orderBy(F.col("id").asc_nulls_last())
    offsets = F.broadcast(docs.sparkSession.createDataFrame(above, "score long, seen long"))
    drawn = scored.filter(enough).withColumn("at", F.row_number().over(in_order)).join(offsets, "score")
    place = F.col("seen") + F.col("at")
    drawn = drawn.select("id", *kept, F.when(place <= draw, place).alias("rank"))
    rest = scored.filter(~enough).select("id", *kept, F.lit(None).cast("long").alias("rank"))
    return drawn.unionByName(rest).withColumnRenamed("id", id_col)
