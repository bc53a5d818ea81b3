"""Best-fit packing of token sequences into bins with several capacities.

A bin has room for ``tokens`` tokens, ``documents`` pieces and ``attention``
cost (the sum of squared lengths).  Pieces go in order of falling size, each
to the open bin that scores best among those with room in every capacity:

* ``norm``: the least weighted norm of what would be left, or
* ``dot``: the greatest weighted dot product of the piece and the bin's room.

Pieces are dealt at random into groups of bounded size, each packed by one
task.  Bins that a group leaves underfull are emptied and their pieces packed
once more among all groups' leavings.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gathered, materialise, on_table, spread, text_or_empty, tune
from .tokenising import Encoder, encoder


@dataclass(frozen=True)
class Capacity:
    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    #: Weights of the three in the score.
    weights: tuple[float, float, float] = (1.0, 1e-3, 1e-3)
    rule: str = "norm"


#: Pieces of one group; a group is what one task holds and packs.
GROUP_PIECES = 20_000
#: Bins filled less than this are packed once more.
UNDERFULL = 0.97

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def best_fit(lengths: np.ndarray, cap: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece.  Ties go to the oldest bin."""
    n = len(lengths)
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    room = np.array([cap.tokens, cap.documents, cap.attention], np.float64)
    if n and (lengths.max() > cap.tokens or float(lengths.max()) ** 2 > cap.attention):
        raise ValueError("a piece is larger than a bin")
    # Open bins: what is left of each capacity as a share, and their numbers.
    left = np.empty((3, 256))
    number = np.empty(256, np.int64)
    opened = used = 0
    weight = np.asarray(cap.weights)[:, None]
    order = np.argsort(-lengths, kind="stable")
    smallest = int(lengths.min()) if n else 0
    least = np.array([smallest, 1, smallest**2]) / room - 1e-12
    for at in order:
        length = int(lengths[at])
        size = np.array([length, 1, length * length]) / room
        now = left[:, :opened] - size[:, None]
        fits = (now >= -1e-12).all(axis=0)
        if fits.any():
            if cap.rule == "dot":
                score = np.where(fits, -(weight * size[:, None] * left[:, :opened]).sum(axis=0), np.inf)
            else:
                score = np.where(fits, (weight * now * now).sum(axis=0), np.inf)
            i = int(score.argmin())
        else:
            if opened == left.shape[1]:
                left, number = np.concatenate([left, np.empty_like(left)], axis=1), np.concatenate([number, np.empty_like(number)])
            i, left[:, opened], number[opened] = opened, 1.0, used
            opened, used = opened + 1, used + 1
        bins[at] = number[i]
        offsets[at] = cap.tokens - round(left[0, i] * cap.tokens)
        left[:, i] -= size
        if (left[:, i] < least).any():  # nothing more can go in
            opened -= 1
            left[:, i : opened], number[i : opened] = left[:, i + 1 : opened + 1].copy(), number[i + 1 : opened + 1].copy()
    return bins, offsets


def _pack_group(cap: Capacity, table: pa.Table) -> pa.Table:
    lengths = table.column("length").to_numpy()
    bins, offsets = best_fit(lengths, cap)
    fill = np.bincount(bins, weights=lengths, minlength=1) if len(bins) else np.zeros(1)
    sequence = (table.column("grp").to_numpy() << 32) | bins
    return (
        table.drop_columns(["grp"])
        .append_column("sequence_id", pa.array(sequence, pa.int64()))
        .append_column("offset", pa.array(offsets, pa.int64()))
        .append_column("full", pa.array(fill[bins] >= UNDERFULL * cap.tokens if len(bins) else [], pa.bool_()))
    )


def _packed(pieces: DataFrame, cap: Capacity, count: int, first_group: int) -> DataFrame:
    groups = max(1, -(-count // GROUP_PIECES))
    # The row's place, not its content, picks the group: rows that repeat
    # don't meet in one.
    dealt = pieces.withColumn("grp", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)) + F.lit(first_group))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return dealt.groupBy("grp").applyInArrow(on_table(_pack_group, cap), f"{fields}, sequence_id long, offset long, full boolean")


def pack(pieces: DataFrame, cap: Capacity = Capacity()) -> DataFrame:
    """Adds sequence_id and offset to pieces, which must come from storage
    (their row order must not change if a task runs again) and have a long
    column ``length`` of 1 or more."""
    count = pieces.count()
    once = materialise(_packed(pieces, cap, count, 0), "packed")
    loose = once.filter(~F.col("full")).drop("sequence_id", "offset", "full")
    left = loose.count()
    groups = max(1, -(-count // GROUP_PIECES))
    again = _packed(loose, cap, left, groups)
    return once.filter("full").unionByName(again).drop("full")


def _tokenise(path: str, longest: int, end_id: int, kept: int, batches):
    end = np.uint32(end_id).tobytes()
    for b in gathered(batches):
        rows: list[tuple] = []
        for doc, body in zip(b.column("doc_id").to_pylist(), encoder(path, limit=kept).encode(b.column("t"))):
            body += end
            step = 4 * longest
            for piece, at in enumerate(range(0, len(body), step)):
                part = memoryview(body)[at : at + step]
                rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part)))
        columns = list(zip(*rows)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
            ["doc_id", "piece", "start", "length", "ids_crc32"],
        )


def cut_documents(docs: DataFrame, tokenizer: str, longest: int = 2048, end_id: int = 0, kept: int = Encoder.LIMIT) -> DataFrame:
    """Pieces of every document: its ids, then ``end_id``, cut every
    ``longest`` tokens.  Stored, so that packing may read it twice."""
    tune(docs.sparkSession)
    texts = docs.select(F.col("doc_id"), text_or_empty("text").alias("t"))
    return materialise(spread(texts).mapInArrow(partial(_tokenise, tokenizer, longest, end_id, kept), PIECES), "pieces")


def pack_documents(docs: DataFrame, tokenizer: str, cap: Capacity = Capacity(), end_id: int = 0, kept: int = Encoder.LIMIT) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset).

    Null and empty texts are a piece of the end id alone; a text longer than a
    sequence is cut; rows that repeat are packed each; ties between bins go to
    the oldest; an empty table gives an empty result; only doc_id and text are
    read, so other columns' names can't clash.  ``kept``: words whose ids a
    worker keeps, which trades its memory for time.
    """
    pieces = cut_documents(docs, tokenizer, cap.tokens, end_id, kept)
    return pack(pieces, cap).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
