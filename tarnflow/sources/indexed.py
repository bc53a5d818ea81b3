"""Records of flat files by key, through a stored index of byte ranges.

``index_records`` scans files once, in parallel, and stores (key, path, start,
length) sorted by key.  ``read_records`` is a Python data source over such an
index: a filter on the key is pushed into it, only the index's rows of these keys
are looked up, and each partition reads its records' bytes and nothing else.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

FORMAT = "tarnflow_records"
INDEX = "key string, path string, start long, length long"

#: Bytes that one task scans when files are indexed; what it reads beyond its range
#: to end its last record, at a time; and records a partition of a read has at most.
SPLIT, STEP, RECORDS = 32 << 20, 1 << 16, 5_000


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", uri) if uri.startswith("file:") else os.path.abspath(uri)


def _files(uri: str) -> list[tuple[str, int]]:
    """(path as the store names it, size) of a file or a folder's files."""
    store, path = _store(uri)
    info = store.get_file_info(path)
    found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(path, recursive=True))
    return [(f.path, f.size) for f in found if f.type == fs.FileType.File and not f.base_name.startswith((".", "_"))]


def _scan(uri: str, begins: bytes, key: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Index rows of the records that begin in a range of a file; a record begins
    where a line does, with the bytes ``begins``."""
    store, _ = _store(uri)
    head = re.compile(key.encode())
    for b in batches:
        for path, low, high, size in zip(*(b.column(c).to_pylist() for c in ("path", "low", "high", "size"))):
            rows: list[tuple[str, int]] = []
            with store.open_input_file(path) as f:
                # One byte before the range tells whether its first line begins there.
                f.seek(max(0, low - 1))
                data = bytearray(b"\n" if low == 0 else b"") + f.read(high - max(0, low - 1))
                base, end = low - 1, None
                while True:
                    at, found = 0, [m.start() + 1 for m in re.finditer(b"\n" + re.escape(begins), data)]
                    starts = [x for x in found if base + x < high]
                    later = [x for x in found if base + x >= high]
                    # Read on until the next record begins, and the last key's line has ended.
                    if later or base + len(data) >= size:
                        end = base + later[0] if later else size
                        break
                    data += f.read(STEP)
                for at, nxt in zip(starts, [*starts[1:], end - base]):
                    line = bytes(data[at : data.find(b"\n", at) if data.find(b"\n", at) >= 0 else len(data)])
                    m = head.match(line)
                    rows.append((m[1].decode("utf-8", "replace") if m else None, base + at, nxt - at))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([path] * len(rows), pa.string()), *(pa.array([r[i] for r in rows], pa.int64()) for i in (1, 2))], ["key", "path", "start", "length"])


def index_records(spark: SparkSession, path: str, index: str, begins: str = ">", key: str = r">(\S+)", split: int = SPLIT) -> DataFrame:
    """Stores the index of the files at ``path`` in the folder ``index`` and
    returns it.  A record begins at a line that starts with ``begins``; its key is
    the first group of ``key`` in that line, and records without one aren't
    indexed.  Large files are scanned in ranges of ``split`` bytes."""
    parts = [(p, low, min(low + split, size), size) for p, size in _files(path) for low in range(0, size, split)]
    ranges = spark.createDataFrame(parts, "path string, low long, high long, size long").repartition(max(1, len(parts)))
    rows = ranges.mapInArrow(partial(_scan, path, begins.encode(), key), INDEX).filter("key is not null")
    # Sorted files of few row groups each: a look-up by key skips most by their bounds.
    rows.repartitionByRange("key").sortWithinPartitions("key", "path", "start").write.mode("overwrite").parquet(index)
    return spark.read.schema(INDEX).parquet(index)


@dataclass
class _Records(InputPartition):
    path: str
    rows: list[tuple[str, int, int]]


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.uri, self.index = options["path"], options["index"]
        self.records = int(options.get("records", RECORDS))
        self.keys: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equality and lists on the key are taken; others stay with Spark."""
        for f in filters:
            keys = {f.value} if isinstance(f, EqualTo) and f.attribute == ("key",) else set(f.value) if isinstance(f, In) and f.attribute == ("key",) else None
            if keys is None:
                yield f
            else:
                self.keys = keys if self.keys is None else self.keys & keys

    def partitions(self) -> Sequence[InputPartition]:
        store, path = _store(self.index)
        table = ds.dataset(path, format="parquet", filesystem=store)
        wanted = None if self.keys is None else ds.field("key").isin(sorted(k for k in self.keys if k is not None))
        out: list[InputPartition] = []
        by_file: dict[str, list] = {}
        for b in table.to_batches(columns=["key", "path", "start", "length"], filter=wanted):
            for k, p, s, n in zip(*(b.column(c).to_pylist() for c in ("key", "path", "start", "length"))):
                rows = by_file.setdefault(p, [])
                rows.append((k, s, n))
                if len(rows) >= self.records:
                    out.append(_Records(p, by_file.pop(p)))
        return out + [_Records(p, rows) for p, rows in by_file.items()]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        store, _ = _store(self.uri)
        keys, records, held = [], [], 0
        with store.open_input_file(partition.path) as f:
            for key, start, length in sorted(partition.rows, key=lambda r: r[1]):
                f.seek(start)
                records.append(f.read(length).decode("utf-8", "replace"))
                keys.append(key)
                held += length
                if held > 4 << 20:
                    yield self._batch(partition.path, keys, records)
                    keys, records, held = [], [], 0
        if keys:
            yield self._batch(partition.path, keys, records)

    @staticmethod
    def _batch(path: str, keys: list, records: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([path] * len(keys), pa.string()), pa.array(records, pa.string())], ["key", "file", "record"])


class RecordSource(DataSource):
    """Options: path (as it was indexed), index, records (of a partition)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "key string, file string, record string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


def read_records(spark: SparkSession, path: str, index: str, records: int = RECORDS) -> DataFrame:
    """(key, file, record) of indexed files.  Filters on the key (= and IN) are
    pushed down: without one all records are read.  A key that several records
    have gives them all; a key without a record gives nothing."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RecordSource)
    return spark.read.format(FORMAT).options(path=path, index=index, records=records).load()


def fetch(spark: SparkSession, path: str, index: str, wanted: DataFrame, key: str, records: int = RECORDS) -> DataFrame:
    """(key, file, record) of the keys of a table of any size: the index is joined
    with the table, so the driver sees no key, and tasks read the ranges."""
    found = spark.read.schema(INDEX).parquet(index).join(wanted.select(F.col(key).alias("key")).distinct(), "key", "left_semi")
    return found.repartitionByRange("path", "start").sortWithinPartitions("path", "start").mapInArrow(partial(_fetch, path, records), "key string, file string, record string")


def _fetch(uri: str, records: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reader = _Reader({"path": uri, "index": "", "records": records})
    for b in batches:
        by_file: dict[str, list] = {}
        for k, p, s, n in zip(*(b.column(c).to_pylist() for c in ("key", "path", "start", "length"))):
            by_file.setdefault(p, []).append((k, s, n))
        for p, rows in by_file.items():
            yield from reader.read(_Records(p, rows))
