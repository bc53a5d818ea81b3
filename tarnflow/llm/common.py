"""Helpers that the training-data operators share: scratch tables in the
cluster's shared folder, word hashing, and session settings for Arrow batches.

Scratch tables live under ``spark.checkpoint.dir`` (a folder that the driver
and all executors see).  Where that setting is missing and driver and
executors are one machine, as in tests, a temporary folder stands in for it; on
a cluster that is an error.
"""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}

#: Rows and bytes of one Arrow batch.  Texts may be very long, so a batch is
#: bounded by rows that hold a few MB at usual lengths.
BATCH_ROWS = 400
BATCH_BYTES = 16 << 20


def tune(spark: SparkSession) -> None:
    """Bound Arrow batches, as rows hold whole texts here."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    try:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    except Exception as error:  # noqa: BLE001 - older versions lack the setting
        if "CONFIG" not in str(error).upper():
            raise


def shared_dir(spark: SparkSession) -> str:
    """The folder that all machines share, from ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL:
            _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="tarnflow-")
            spark.sparkContext.setCheckpointDir(_LOCAL[app])
        base = _LOCAL[app]
    return base.rstrip("/")


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder, below a folder of this application's."""
    return f"{_own_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tarnflow/{spark.sparkContext.applicationId}"


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    survives lost executors and is computed once however often it is read.
    Nothing is coalesced in front of the write, as that would take the
    parallelism from the work; Spark joins small partitions by itself."""
    spark = df.sparkSession
    path = scratch(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of any store that Spark knows."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return bool(fs.exists(p))


def clear(spark: SparkSession) -> None:
    """Delete this application's scratch tables, for when its results have been
    written elsewhere: results read them, so operators can't do it."""
    fs, p = _hadoop(spark, _own_dir(spark))
    fs.delete(p, True)


def filesystem(uri: str):
    """(pyarrow file system, path in it) of a shared-folder URI.  The scheme
    names the store, so the same code serves a mounted folder or HDFS."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", uri)
    return fs.FileSystem.from_uri(uri)


def write_file(uri: str, *buffers) -> None:
    """Write whole and then rename, so that a retried or speculative task
    leaves either nothing or a complete file."""
    write_stream(uri, buffers)


def write_stream(uri: str, buffers) -> int:
    """write_file of buffers that are made one by one; their bytes."""
    fs, path = filesystem(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    temporary, size = f"{path}.{uuid.uuid4().hex}.tmp", 0
    with fs.open_output_stream(temporary) as out:
        for b in buffers:
            out.write(b)
            size += len(b)
    fs.move(temporary, path)
    return size


def fresh(taken: list[str], *names: str) -> list[str]:
    """Column names like ``names`` that aren't among ``taken``."""
    lower = {t.lower() for t in taken}
    out = []
    for n in names:
        while n.lower() in lower:
            n += "_"
        lower.add(n.lower())
        out.append(n)
    return out


def input_bytes(df: DataFrame) -> int | None:
    """Spark's own estimate of a plan's size; of a scan, its files' bytes.
    Nothing is read.  None where there is no estimate, as for local rows."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 55 else None


def on_table(function, *arguments):
    """function(*arguments, table) with the type hints that applyInArrow asks for."""
    import pyarrow as pa

    def run(table: pa.Table) -> pa.Table:
        return function(*arguments, table)

    return run


def gathered(batches, column: str = "t", size: int = 8 << 20):
    """Batches joined until their texts have ``size`` bytes: what is done once
    for each distinct word of a batch is done less often."""
    import pyarrow as pa

    held, total = [], 0
    for b in batches:
        held.append(b)
        total += b.column(column).nbytes
        if total >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, total = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def text_or_empty(column: str):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


#: What a Python worker keeps between its tasks: name -> how to let go of it.
_KEPT: dict[object, object] = {}
_USER: list[object] = [None]


def claim(user: object, release, beside: object = None) -> None:
    """A worker serves many operators in turn.  The one that is at work keeps
    its store (and that of ``beside``, which works with it); all others' are
    let go, so that they never add up."""
    if _USER[0] != user:
        for name in [n for n in _KEPT if n not in (user, beside)]:
            _KEPT.pop(name)()
        _USER[0] = user
    _KEPT[user] = release


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, kept for words already seen; emptied when
    full, so memory is bounded whatever the vocabulary."""

    LIMIT = 150_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_HASHES = WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    claim("word hashes", _HASHES.clear, beside="benchmark index")
    return _HASHES.of(words)


#: Odd multipliers for mixing 64-bit words.
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit words that spreads all bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * _M1
    x = x ^ (x >> np.uint64(29))
    x = x * _M2
    return x ^ (x >> np.uint64(32))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all runs of n words."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(count, np.uint64)
    for i in range(n):
        h = h * _M2 + words[i : i + count]
    return mix64(h)


def space_words(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased and nothing else.
    On UTF-8 bytes both are what bytes.lower and bytes.split do."""
    return text.encode("utf-8", "surrogatepass").lower().split()


#: Bytes for each core below which a table is dealt out before Python work.
SPREAD_BYTES = 4 << 20


def spread(df: DataFrame) -> DataFrame:
    """A small table may lie in one row group, which one task would read: below
    SPREAD_BYTES a core its rows are dealt to all cores.  Larger tables have
    row groups enough and stay where they are."""
    cores, size = df.sparkSession.sparkContext.defaultParallelism, input_bytes(df)
    return df.repartition(2 * cores) if size is not None and size < SPREAD_BYTES * cores else df
