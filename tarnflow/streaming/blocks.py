"""Streaming forms: row operators as projections, block operators as keyed
aggregates or keyed state, and windowed aggregates with a watermark."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tarnflow.operators.hits import HitRule, accepted


def read_files(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1) -> DataFrame:
    """Parquet files as a stream, so many a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def filter_hits(hits: DataFrame, rule: HitRule = HitRule()) -> DataFrame:
    """A row operator: the quality filter as a streaming projection."""
    return hits.filter(accepted(F.col("qcov"), F.col("scov"), F.col("pide"), F.col("lali"), rule))


def running_blocks(hits: DataFrame, key: str, value: str) -> DataFrame:
    """A block operator with a finaliser: running count, sum and greatest of
    each key; write it in update or complete mode."""
    return hits.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.max(value).alias("best"))


def first_n(hits: DataFrame, key: str, order: str, most: int) -> DataFrame:
    """Rows until each key has had ``most``: keyed state holds the count so far.
    Rows of one micro-batch are taken in the order of ``order``."""

    def take(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen = state.get[0] if state.exists else 0
        rows = pd.concat(list(frames)).sort_values(order, kind="stable")
        out = rows.head(max(0, most - seen))
        state.update((seen + len(out),))
        yield out

    return hits.groupBy(key).applyInPandasWithState(take, hits.schema, "seen long", "append", GroupStateTimeout.NoTimeout)


def windowed(events: DataFrame, time: str, key: str, value: str, width: str, late: str, slide: str | None = None) -> DataFrame:
    """Count and sum by key in tumbling or sliding windows; rows later than
    ``late`` are left out and closed windows leave the state."""
    w = F.window(time, width, slide) if slide else F.window(time, width)
    grouped = events.withWatermark(time, late).groupBy(w.alias("w"), key)
    return grouped.agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n", "total")


def sessions(events: DataFrame, time: str, key: str, gap: str, late: str) -> DataFrame:
    """Sessions of a key that end after a pause of ``gap``."""
    g = events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), key)
    return g.agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n")


def joined(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, late: str, within: str, how: str = "inner") -> DataFrame:
    """Pairs of two streams' rows of one key whose times are at most ``within``
    apart.  Both have a watermark, so that rows which can't pair any more leave
    the state; an outer join gives such rows then."""
    a = left.withWatermark(left_time, late)
    b = right.withWatermark(right_time, late).withColumnRenamed(key, "__key")
    near = F.expr(f"`{right_time}` BETWEEN `{left_time}` - INTERVAL {within} AND `{left_time}` + INTERVAL {within}")
    return a.join(b, (F.col(key) == F.col("__key")) & near, how).drop("__key")


def stanzas(spark: SparkSession, path: str, separator: str = "\n\n", files_per_batch: int = 1) -> DataFrame:
    """A text operator over a stream of files: each stanza (lines up to the
    separator) is a row (path, place, stanza), so what a line means may depend
    on the lines before it; a file is read by one task, which cuts it."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("maxFilesPerTrigger", files_per_batch).load(path)
    cut = files.select("path", F.posexplode(F.split(F.col("content").cast("string"), f"\\Q{separator}\\E")).alias("place", "stanza"))
    return cut.filter(F.trim("stanza") != "")


def stanza_tags(rows: DataFrame) -> DataFrame:
    """(path, place, kind, tags): a stanza's [Kind] line and its ``tag: value``
    lines as a map of lists."""
    pairs = F.transform(F.regexp_extract_all("stanza", F.lit(r"(?m)^([a-z_]+: *[^\n]*)"), F.lit(1)), lambda line: F.struct(F.regexp_extract(line, "^([a-z_]+):", 1).alias("k"), F.regexp_extract(line, "^[a-z_]+: *(.*)$", 1).alias("v")))
    keys = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    tags = F.map_from_arrays(keys, F.transform(keys, lambda k: F.transform(F.filter(pairs, lambda p: p["k"] == k), lambda p: p["v"])))
    return rows.select("path", "place", F.regexp_extract("stanza", r"(?m)^\[(\w+)\]", 1).alias("kind"), tags.alias("tags"))


def write_batches(df: DataFrame, path: str, checkpoint: str):
    """Appends each micro-batch to its own folder by number, so a batch that
    runs again replaces what it wrote."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
