"""Token ids in files of 64-bit words (Simple-8b).

A word's top four bits are a selector; the other 60 hold as many equally wide
ids as the selector says.  Selector 15 is an escape: the next word is one id
of up to 64 bits as it is.  Ids are coded in blocks of BLOCK ids, and the
words' offset of each block is kept, so any block can be decoded alone and a
whole segment at once by array operations.

A file is a run of segments:
  magic, documents, ids, blocks, words (5 x uint64)
  doc_id (int64 each), ids of each document (uint64 each)
  first word of each block (uint64 each), words (uint64 each)
"""

from __future__ import annotations

import zlib
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import filesystem, gathered, input_bytes, scratch, text_or_empty, tune, write_stream
from .tokenising import encoder

#: Ids in a word and bits of each, by selector; 15 is the escape.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
BITS = 60 // COUNTS
ESCAPE = 15
BLOCK = 4096
MAGIC = 0x31304238534E5254
#: Stands for a missing doc_id in a file.
NO_ID = -(1 << 63)
#: Ids of one segment at most, but for a longer single document.
SEGMENT = 1 << 19


#: Bits of each number below 2**16.
_SHORT = np.maximum(np.frexp(np.arange(1 << 16, dtype=np.float64))[1], 1).astype(np.uint8)


def _bit_lengths(ids: np.ndarray) -> np.ndarray:
    if ids.max(initial=0) < 1 << 16:
        return _SHORT[ids]
    need = np.ones(len(ids), np.uint8)
    for b in range(1, 64):
        over = ids >> np.uint64(b)
        if not over.any():
            break
        need += over != 0
    return need


def encode_ids(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word of each block, words) of unsigned ids of up to 64 bits.

    All blocks are coded side by side: in each step every block takes the word
    that holds the most of its next ids."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    # What is after the end is too wide for any word.
    size = blocks * BLOCK
    need = np.full(size, 255, np.uint8)
    need[:n] = _bit_lengths(ids)
    # most[i]: selector of the fullest word that can start at i in its block.
    most = np.full(size, ESCAPE, np.uint8)
    widest = {1: need}
    for selector in range(len(COUNTS) - 1, -1, -1):
        c, bits = int(COUNTS[selector]), int(BITS[selector])
        if c not in widest:  # the widest of c ids from i on, from two shorter runs
            half = max(k for k in widest if k < c)
            run, shift = widest[half], c - half
            while shift > half:
                run = np.concatenate([np.maximum(run[:-half], run[half:]), run[-half:]])
                widest[min(2 * half, c)] = run
                half = min(2 * half, c)
                shift = c - half
            longer = run.copy()
            if shift:
                longer[:-shift] = np.maximum(run[:-shift], run[shift:])
            widest[c] = longer
        fits = widest[c] <= bits
        if not fits.any():
            if c > 1:
                break  # then no longer run of still narrower ids fits
            continue
        fits.reshape(blocks, BLOCK)[:, BLOCK - c + 1 :] = False
        most[fits] = selector
    at = np.arange(blocks, dtype=np.int64) * BLOCK
    end = np.minimum(at + BLOCK, n)
    out: list[tuple[np.ndarray, np.ndarray]] = []  # blocks and starts of each step
    live = np.arange(blocks)
    step_of = np.append(COUNTS, [0, 1])
    while len(live):
        here = at[live]
        out.append((live, here))
        at[live] = here + step_of[most[here]]
        live = live[at[live] < end[live]]
    start = np.concatenate([s for _, s in out])
    start.sort()
    selector = most[start]
    words = np.empty(len(start), np.uint64)
    for s in np.unique(selector):
        sel = np.flatnonzero(selector == s)
        if s == ESCAPE:
            words[sel] = np.uint64(ESCAPE) << np.uint64(60)
            continue
        c, bits = int(COUNTS[s]), int(BITS[s])
        word = np.full(len(sel), np.uint64(s) << np.uint64(60), np.uint64)
        for k in range(c):
            word |= ids[start[sel] + k] << np.uint64(k * bits)
        words[sel] = word
    escaped = selector == ESCAPE
    size = 1 + escaped.astype(np.int64)
    place = np.cumsum(size) - size
    full = np.empty(int(size.sum()), np.uint64)
    full[place] = words
    full[place[escaped] + 1] = ids[start[escaped]]
    first = place[np.searchsorted(start, np.arange(blocks) * BLOCK)]
    return first.astype(np.uint64), full


def decode_words(first: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
    """The n ids, by array operations only."""
    ids = np.empty(n, np.uint64)
    if not n:
        return ids
    selector = (words >> np.uint64(60)).astype(np.int64)
    head = np.ones(len(words), bool)
    marks = np.flatnonzero(selector == ESCAPE)
    if len(marks):  # a raw word may look like an escape itself: walk these
        last = -1
        for m in marks.tolist():
            if m != last:
                head[m + 1], last = False, m + 1
    where = np.flatnonzero(head)
    selector = selector[where]
    count = np.append(COUNTS, [0, 1])[selector]
    to = np.cumsum(count) - count
    for s in np.unique(selector):
        sel = np.flatnonzero(selector == s)
        if s == ESCAPE:
            ids[to[sel]] = words[where[sel] + 1]
            continue
        c, bits = int(COUNTS[s]), int(BITS[s])
        mask = np.uint64((1 << bits) - 1)
        for k in range(c):
            ids[to[sel] + k] = (words[where[sel]] >> np.uint64(k * bits)) & mask
    return ids


def decode_block(first: np.ndarray, words: np.ndarray, n: int, block: int) -> np.ndarray:
    """One block's ids, without the others' words."""
    a = int(first[block])
    b = int(first[block + 1]) if block + 1 < len(first) else len(words)
    return decode_words(first[:1], words[a:b], min(BLOCK, n - block * BLOCK))


def segment(doc_ids: list[int], bodies: list[bytes]) -> bytes:
    ids = np.frombuffer(b"".join(bodies), "<u4")
    first, words = encode_ids(ids)
    head = np.array([MAGIC, len(doc_ids), len(ids), len(first), len(words)], "<u8")
    lengths = np.array([len(b) // 4 for b in bodies], "<u8")
    return b"".join(x.tobytes() for x in (head, np.array(doc_ids, "<i8"), lengths, first.astype("<u8"), words.astype("<u8")))


def segments(stream):
    """(doc ids, lengths, ids) of each segment of an open file."""
    while head := stream.read(40):
        magic, docs, n, blocks, count = (int(x) for x in np.frombuffer(head, "<u8"))
        if magic != MAGIC:
            raise ValueError("not a token file")
        doc_ids, lengths, first, words = (np.frombuffer(stream.read(8 * k), kind) for k, kind in ((docs, "<i8"), (docs, "<u8"), (blocks, "<u8"), (count, "<u8")))
        yield doc_ids, lengths, decode_words(first, words, n)


def _write(folder: str, tokenizer: str, end_id: int, batches):
    end = np.uint32(end_id).tobytes()
    shard = TaskContext.get().partitionId()
    name, total = f"{folder}/shard-{shard:08d}.s8b", {"docs": 0, "ids": 0}

    def made(first):
        """Segments one after another; a task holds no more than one."""
        doc_ids, bodies, size = [], [], 0
        for b in chain([first], gathered(batches)):
            for doc, body in zip(b.column("doc_id").to_pylist(), encoder(tokenizer).encode(b.column("t"))):
                doc_ids.append(NO_ID if doc is None else doc)
                bodies.append(body + end)
                size += len(body) // 4 + 1
                if size >= SEGMENT:
                    yield segment(doc_ids, bodies)
                    total["docs"], total["ids"] = total["docs"] + len(bodies), total["ids"] + size
                    doc_ids, bodies, size = [], [], 0
        if bodies:
            yield segment(doc_ids, bodies)
            total["docs"], total["ids"] = total["docs"] + len(bodies), total["ids"] + size

    batches = (b for b in batches if b.num_rows)
    first = next(batches, None)
    if first is not None:
        size = write_stream(name, made(first))
        yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [name], "docs": [total["docs"]], "ids": [total["ids"]], "bytes": [size]})


#: Bytes of stored input that one file is made of.
FILE_BYTES = 64 << 20


SHARDS = "shard long, path string, docs long, ids long, bytes long"


def write_tokens(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 0) -> DataFrame:
    """Writes the ids of every document, each followed by ``end_id``, in
    ascending doc_id order over numbered files; returns the files' list with
    the ids before each: (shard, path, docs, ids, bytes, start).

    Null and empty texts are the end id alone; a null doc_id comes first and is
    stored as NO_ID; rows with the same doc_id stay together in order of a hash
    of their text; an empty table writes no file.
    """
    spark = docs.sparkSession
    tune(spark)
    folder = folder or scratch(spark, "tokens")
    # The text's hash as a second key lets rows of one doc_id part, too.
    rows = docs.select(F.col("doc_id"), text_or_empty("text").alias("t")).withColumn("h", F.xxhash64("t"))
    # As many files as the data asks for, and a few for each core at least.
    size = input_bytes(docs)
    files = int(spark.conf.get("spark.sql.shuffle.partitions")) if size is None else max(4 * spark.sparkContext.defaultParallelism, -(-size // FILE_BYTES))
    ordered = rows.repartitionByRange(files, "doc_id", "h").sortWithinPartitions("doc_id", "h")
    # One row for each file comes back, as many as there are partitions.
    written = sorted(ordered.select("doc_id", "t").mapInArrow(partial(_write, folder, tokenizer, end_id), SHARDS).collect(), key=lambda r: r["shard"])
    start, listed = 0, []
    for r in written:
        listed.append((*r, start))
        start += r["ids"]
    return spark.createDataFrame(listed, SHARDS + ", start long")


def _read(batches):
    for b in batches:
        for path, start in zip(b.column("path").to_pylist(), b.column("start").to_pylist()):
            fs, name = filesystem(path)
            with fs.open_input_stream(name) as stream:
                for doc_ids, lengths, ids in segments(stream):
                    to = np.cumsum(lengths.astype(np.int64))
                    body = memoryview(ids.astype("<u4").tobytes())
                    crc = [zlib.crc32(body[4 * a : 4 * z]) for a, z in zip([0, *to.tolist()[:-1]], to.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(doc_ids, pa.int64(), mask=doc_ids == NO_ID), pa.array(start + to - lengths.astype(np.int64)), pa.array(lengths.astype(np.int64)), pa.array(crc, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )
                    start += len(ids)


def read_tokens(spark: SparkSession, shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from
    the files that write_tokens listed."""
    parts = max(spark.sparkContext.defaultParallelism, shards.count())
    return shards.select("path", "start").repartition(parts).mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_store(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 0) -> DataFrame:
    """Write, then read back."""
    return read_tokens(docs.sparkSession, write_tokens(docs, tokenizer, folder, end_id))
