"""Statistics of whole texts, for quality rules and the quality classifier.

Words are runs without ASCII white space ([^\\x20\\x09-\\x0D]+).  Everything is
counted over the whole text; null is read as empty.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import gram_hashes, mix64, spread, text_or_empty, tune, word_hashes

#: Fixed by the rules' definition.
_SYMBOLS = b"#*$%&|<>"
_NOT_SYMBOLS = bytes(c for c in range(256) if c not in _SYMBOLS)
_WHITE = b" \t\n\v\f\r"
_CONTINUATION = bytes(range(0x80, 0xC0))
_NOT_DIGIT = bytes(c for c in range(256) if c not in b"0123456789")
_NOT_PUNCTUATION = bytes(c for c in range(256) if c not in b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
_CASED = re.compile(r"[^\W\d_]+")

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SHARES = ["n_lines", "n_chars", "n_distinct_words", "n_upper", "n_letters", "n_digits", "n_punctuation", "longest_word", "top_word", "packed_bytes", "n_bytes"]
SCHEMA = ", ".join(f"{n} long" for n in COUNTS + SHARES)


def repeated_words(words: np.ndarray, n: int = 3) -> int:
    """Words inside windows of n words that occur twice or more (windows may
    overlap; the first occurrence counts too)."""
    grams = gram_hashes(words, n)
    if len(grams) < 2:
        return 0
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(len(grams), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    at = np.flatnonzero(again)
    # Lengths of the union of [i, i + n).
    gap = np.diff(at)
    return int(np.minimum(gap, n).sum() + n)


def text_statistics(text: str) -> tuple[int, ...]:
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    symbols = len(raw.translate(None, _NOT_SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    duplicates = len(lines) - len(set(lines))
    solid = raw.translate(None, _WHITE)
    hashes = word_hashes(words)
    distinct, top = 0, 0
    if len(words):
        ordered = np.sort(mix64(hashes))
        edges = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1], [True])))
        distinct, top = len(edges) - 1, int(np.diff(edges).max())
    letters = "".join(_CASED.findall(text))
    upper = sum(map(str.isupper, letters)) if not letters.islower() else 0
    return (
        len(words),
        len(solid) - len(solid.translate(None, bytes(c for c in range(256) if c not in _CONTINUATION))),
        symbols,
        duplicates,
        repeated_words(hashes),
        len(lines),
        len(text),
        distinct,
        upper,
        len(letters),
        len(raw.translate(None, _NOT_DIGIT)),
        len(raw.translate(None, _NOT_PUNCTUATION)),
        max(map(len, words), default=0),
        top,
        len(zlib.compress(raw, 1)),
        len(raw),
    )


def _statistics(batches):
    for b in batches:
        rows = [text_statistics(t) for t in b.column("t").to_pylist()]
        columns = list(zip(*rows)) or [[]] * len(COUNTS + SHARES)
        yield pa.RecordBatch.from_arrays(
            [*(b.column(i) for i in range(b.num_columns - 1)), *(pa.array(c, pa.int64()) for c in columns)],
            [*b.schema.names[:-1], *COUNTS, *SHARES],
        )


def statistics(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and the statistics of each row's text.  Other
    columns are not read."""
    tune(docs.sparkSession)
    rows = docs.select(*keep, text_or_empty(text_col).alias("t"))
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return spread(rows).mapInArrow(_statistics, f"{head}, {SCHEMA}")
