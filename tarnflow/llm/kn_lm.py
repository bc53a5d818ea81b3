"""Interpolated modified Kneser-Ney language model of two words.

Counts are gathered by Spark and written as sorted arrays of 64-bit hashes
with aligned counts, in shards by the hashes' leading bits; workers map the
files and look words up by binary search, so what a worker holds is what the
texts at hand touch.

* vocabulary: hash of a word -> its count.  A word's number is its place.
* pairs: a bijective hash of two numbers -> the pair's count.  Beyond 2**32
  words, two numbers don't fit 64 bits, and the first one is stored beside a
  hash that is bijective for it.
* contexts, aligned with the vocabulary: the sum of a word's pairs as first
  word, how many of them occur once, twice, more often, and how many different
  words stand before it.

Numbers are stored in 32 bits where all of a shard fit, else in 64.  Counts
reach their shards in steps of STEP_BITS leading bits, so a task makes a bounded
number of rows however many shards there are.

Every document begins with a context of its own and ends with an end token:
    p(w | v) = max(c(v w) - D(c), 0) / c(v) + g(v) p(w)
    p(w)     = max(b(w) - D'(b), 0) / B + g' / (V + 1)
where b(w) is the number of different words before w and B the sum of these.
"""

from __future__ import annotations

import os
import tempfile
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import filesystem, mix64, on_table, scratch, space_words, spread, text_or_empty, tune, word_hashes, write_file

#: Not words, as they hold a blank.
END, START = (word_hashes([w])[0] for w in (b" end", b" start"))
#: Tokens a shard is planned for.
SHARD_TOKENS = 4_000_000
#: Distinct entries after which a task's counts are compacted.
COMPACT = 4_000_000

_I1 = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_I2 = np.uint64(pow(0xC2B2AE3D27D4EB4F, -1, 1 << 64))


def unmix64(x: np.ndarray) -> np.ndarray:
    """The inverse of mix64."""
    x = x ^ (x >> np.uint64(32))
    x = x * _I2
    x = x ^ (x >> np.uint64(29)) ^ (x >> np.uint64(58))
    x = x * _I1
    return x ^ (x >> np.uint64(32))


def summed(keys: list[tuple[np.ndarray, ...]], counts: list[np.ndarray]) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
    """Sorted distinct keys (of one array or several) and their counts."""
    k, c = [np.concatenate(x) for x in zip(*keys)], np.concatenate(counts)
    order = np.argsort(k[0], kind="stable") if len(k) == 1 else np.lexsort(k[::-1])
    k, c = [x[order] for x in k], c[order]
    if not len(c):
        return tuple(k), c
    first = np.flatnonzero(np.concatenate(([True], np.any([x[1:] != x[:-1] for x in k], axis=0))))
    return tuple(x[first] for x in k), np.add.reduceat(c, first)


class _Counter:
    def __init__(self, columns: int = 1):
        self.keys, self.counts, self.size, self.columns = [], [], 0, columns

    def add(self, *keys: np.ndarray) -> None:
        if len(keys) == 1:
            k, c = np.unique(keys[0], return_counts=True)
            k, c = (k,), c.astype(np.uint64)
        else:
            k, c = summed([keys], [np.ones(len(keys[0]), np.uint64)])
        self.keys.append(k)
        self.counts.append(c)
        self.size += len(c)
        if self.size >= COMPACT and len(self.keys) > 8:
            k, c = summed(self.keys, self.counts)
            self.keys, self.counts, self.size = [k], [c], len(c) // 2

    def result(self):
        return summed(self.keys, self.counts) if self.keys else ((np.empty(0, np.uint64),) * self.columns, np.empty(0, np.uint64))


def packed(values: np.ndarray) -> bytes:
    """Unsigned numbers in 32 bits where all fit, else in 64."""
    return values.astype("<u4" if int(values.max(initial=0)) < 1 << 32 else "<u8").tobytes()


def unpacked(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, "<u8" if n and len(raw) == 8 * n else "<u4").astype(np.uint64)


def _shard_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return hashes >> np.uint64(64 - bits) if bits else np.zeros(len(hashes), np.uint64)


def _stretches(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(id, first, end) of runs of equal ids."""
    edges = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1], [True]))) if len(ids) else np.zeros(1, np.int64)
    return [(int(ids[a]), int(a), int(z)) for a, z in zip(edges[:-1], edges[1:])]


#: Leading bits that one step of dealing tells apart.
STEP_BITS = 12
_DEALT = pa.schema([("shard", pa.int64()), ("salt", pa.int64()), ("keys", pa.binary()), ("befores", pa.binary()), ("counts", pa.binary())])
DEALT = "shard long, salt long, keys binary, befores binary, counts binary"


def _dealt(keys: tuple[np.ndarray, ...], counts: np.ndarray, bits: int, salt: int):
    """Sorted keys as one row for each shard that has some."""
    for s, a, z in _stretches(_shard_of(keys[0], bits)):
        before = keys[1][a:z].tobytes() if len(keys) > 1 else None
        yield pa.RecordBatch.from_pydict({"shard": [s], "salt": [salt], "keys": [keys[0][a:z].tobytes()], "befores": [before], "counts": [packed(counts[a:z])]}, schema=_DEALT)


def _merged(table: pa.Table) -> tuple[int, tuple[np.ndarray, ...], np.ndarray]:
    keys, befores = ([None if x is None else np.frombuffer(x, np.uint64) for x in table.column(c).to_pylist()] for c in ("keys", "befores"))
    counts = [unpacked(x, len(k)) for x, k in zip(table.column("counts").to_pylist(), keys)]
    return table.column("shard")[0].as_py(), *summed([(k,) if b is None else (k, b) for k, b in zip(keys, befores)], counts)


def _deal_on(bits: int, table: pa.Table) -> pa.Table:
    _, keys, counts = _merged(table)
    return pa.Table.from_batches(list(_dealt(keys, counts, bits, table.column("salt")[0].as_py())), _DEALT)


def _in_steps(texts: DataFrame, count, bits: int, step: int) -> DataFrame:
    """Rows by shard of all ``bits``.  count(batches, bits) gives a task's rows
    by fewer bits; in each further step, cells of about a shard's size merge
    theirs and tell more bits apart."""
    now = min(bits, step)
    rows = texts.mapInArrow(partial(count, bits=now), DEALT)
    while now < bits:
        after = min(bits, now + step)
        cells = rows.withColumn("salt", F.pmod(F.xxhash64("salt"), F.lit(1 << (bits - now))))
        rows, now = cells.groupBy("shard", "salt").applyInArrow(on_table(_deal_on, after), DEALT), after
    return rows


def _task() -> int:
    return TaskContext.get().partitionId()


def _words_in(batches, bits: int):
    seen = _Counter()
    for b in batches:
        some = [word_hashes(space_words(t)) for t in b.column("t").to_pylist()]
        seen.add(np.concatenate([*some, np.full(len(some), END, np.uint64)]) if some else np.empty(0, np.uint64))
    yield from _dealt(*seen.result(), bits, _task())


def _write_words(folder: str, table: pa.Table) -> pa.Table:
    shard, (keys,), counts = _merged(table)
    name = f"{folder}/words-{shard:06d}"
    write_file(f"{name}.hash", keys.tobytes())
    write_file(f"{name}.count", packed(counts))
    return pa.table({"shard": [shard], "entries": [len(keys)], "tokens": [int(counts.sum())]})


@dataclass(frozen=True)
class Shards:
    """Where sorted arrays lie: a folder, leading bits, all entries.  The
    entries before each shard are a file too, so that this is small."""

    folder: str
    name: str
    bits: int
    entries: int
    wide: bool = False

    @property
    def before(self) -> np.ndarray:
        return mapped(f"{self.folder}/{self.name}.before", (1 << self.bits) + 2)

    def file(self, shard: int, field: str) -> np.ndarray:
        return mapped(f"{self.folder}/{self.name}-{shard:06d}.{field}", int(self.before[shard + 1] - self.before[shard]))


@lru_cache(maxsize=4096)
def mapped(uri: str, n: int) -> np.ndarray:
    """A stored array of n numbers, mapped: the shared folder's own file where
    the folder is mounted, else a copy that this worker fetches, whose name is
    removed at once, so that it goes with the worker."""
    from pyarrow import fs

    store, path = filesystem(uri)
    own = isinstance(store, fs.LocalFileSystem)
    if not own:
        with tempfile.NamedTemporaryFile(delete=False) as copy, store.open_input_stream(path) as source:
            while part := source.read(1 << 24):
                copy.write(part)
        path = copy.name
    try:
        return np.memmap(path, "<u8" if os.path.getsize(path) == 8 * n else "<u4", "r")
    finally:
        if not own:
            os.unlink(path)


def find(shards: Shards, hashes: np.ndarray, befores: np.ndarray | None = None) -> np.ndarray:
    """Places of sorted hashes in the whole array; -1 where there is none.
    Only shards that some hash falls in are touched."""
    out = np.full(len(hashes), -1, np.int64)
    before = shards.before
    for s, a, z in _stretches(_shard_of(hashes, shards.bits)):
        n = int(before[s + 1] - before[s])
        if not n:
            continue
        array, own = shards.file(s, "hash"), hashes[a:z]
        at = np.searchsorted(array, own)
        here = np.minimum(at, n - 1)
        hit = array[here] == own
        if befores is not None:  # equal hashes of different contexts lie side by side
            contexts = shards.file(s, "context")
            wrong = hit & (contexts[here] != befores[a:z])
            while wrong.any():
                here = np.where(wrong, here + 1, here)
                hit = (here < n) & (array[np.minimum(here, n - 1)] == own)
                wrong = wrong & hit & (contexts[np.minimum(here, n - 1)] != befores[a:z])
        out[a:z] = np.where(hit, here + int(before[s]), -1)
    return out


def gather(shards: Shards, field: str, places: np.ndarray) -> np.ndarray:
    """A field's values at places that ascend, but for -1 anywhere: 0 there."""
    out = np.zeros(len(places), np.float64)
    there = np.flatnonzero(places >= 0)
    before = shards.before
    for s, a, z in _stretches(np.searchsorted(before, places[there].astype(before.dtype), "right") - 1):
        own = there[a:z]
        out[own] = shards.file(s, field)[places[own] - int(before[s])]
    return out


def _numbered(texts: list[str], words: Shards) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(numbers of all tokens, -1 for unknown ones; tokens of each text;
    whether a token is its text's first)."""
    each = [np.append(word_hashes(space_words(t)), END) for t in texts]
    lengths = np.array([len(e) for e in each], np.int64)
    distinct, inverse = np.unique(np.concatenate(each), return_inverse=True)
    first = np.zeros(int(lengths.sum()), bool)
    first[np.cumsum(lengths) - lengths] = True
    return find(words, distinct)[inverse], lengths, first


def _pairs_of(numbers: np.ndarray, first: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """(word before, word); ``start`` stands before a text's first word."""
    before = np.concatenate(([0], numbers[:-1]))
    before[first] = start
    return before, numbers


def pair_key(before: np.ndarray, word: np.ndarray, wide: bool) -> tuple[np.ndarray, ...]:
    b, w = before.astype(np.uint64), word.astype(np.uint64)
    return (mix64(mix64(b) ^ w), b) if wide else (mix64((b << np.uint64(32)) | w),)


def pair_of(keys: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The inverse of pair_key."""
    if len(keys) > 1:
        return keys[1].astype(np.int64), (unmix64(keys[0]) ^ mix64(keys[1])).astype(np.int64)
    both = unmix64(keys[0])
    return (both >> np.uint64(32)).astype(np.int64), (both & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _pairs_in(batches, words: Shards, wide: bool, bits: int):
    seen = _Counter(1 + wide)
    for b in batches:
        texts = b.column("t").to_pylist()
        if texts:
            numbers, _, first = _numbered(texts, words)
            seen.add(*pair_key(*_pairs_of(numbers, first, words.entries), wide))
    yield from _dealt(*seen.result(), bits, _task())


_STAT_FIELDS = ("total", "ones", "twos", "more", "before")
_STATS = pa.schema([("target", pa.int64()), ("salt", pa.int64()), ("n", pa.int64()), ("ids", pa.binary()), *((f, pa.binary()) for f in _STAT_FIELDS), ("hist", pa.list_(pa.int64())), ("shards", pa.list_(pa.string()))])
STATS = "target long, salt long, n long, ids binary, " + ", ".join(f"{f} binary" for f in _STAT_FIELDS) + ", hist array<long>, shards array<string>"


def _stat_rows(vocabulary: Shards, ids: np.ndarray, sums: np.ndarray, hist: list[int], shards: list[str], low: int, salt: int) -> pa.Table:
    """Words' sums as a row for each stretch of 2**low shards of the vocabulary
    (the start context, which is no word, is a shard of its own, numbered last);
    hist and shards go with the first."""
    rows: dict[str, list] = {f.name: [] for f in _STATS}
    before = vocabulary.before
    for i, (t, a, z) in enumerate(_stretches((np.searchsorted(before, ids.astype(before.dtype), "right") - 1) >> low)):
        # Steps between sorted numbers are small and shrink in the shuffle.
        for k, v in (("target", t), ("salt", salt), ("n", z - a), ("ids", packed(np.diff(ids[a:z], prepend=0))), ("hist", [0] * 4 if i else hist), ("shards", [] if i else shards)):
            rows[k].append(v)
        for f, v in zip(_STAT_FIELDS, sums):
            rows[f].append(packed(v[a:z]))
    return pa.table(rows, schema=_STATS)


def _write_pairs(folder: str, vocabulary: Shards, low: int, table: pa.Table) -> pa.Table:
    """Writes one shard of pairs, and returns what it adds to the words' own
    counts."""
    shard, keys, counts = _merged(table)
    name = f"{folder}/pairs-{shard:06d}"
    write_file(f"{name}.hash", keys[0].tobytes())
    if len(keys) > 1:
        write_file(f"{name}.context", packed(keys[1]))
    write_file(f"{name}.count", packed(counts))
    before, word = pair_of(keys)
    ids, inverse = np.unique(np.concatenate([before, word]), return_inverse=True)
    as_context, as_word = inverse[: len(counts)], inverse[len(counts) :]
    sums = np.zeros((len(_STAT_FIELDS), len(ids)), np.uint64)
    for k, w in enumerate((counts, counts == 1, counts == 2, counts >= 3)):
        np.add.at(sums[k], as_context, w.astype(np.uint64))
    np.add.at(sums[4], as_word, np.uint64(1))
    return _stat_rows(vocabulary, ids, sums, [int((counts == k).sum()) for k in (1, 2, 3, 4)], [f"{shard}:{len(counts)}"], low, shard)


def _added(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[int], list[str]]:
    """(ids, sums, hist, shards) of rows together."""
    columns = [table.column(c).to_pylist() for c in ("n", "ids", *_STAT_FIELDS)]
    each = [np.cumsum(unpacked(raw, n)).astype(np.int64) for n, raw in zip(columns[0], columns[1])]
    ids, inverse = np.unique(np.concatenate(each), return_inverse=True)
    sums = np.zeros((len(_STAT_FIELDS), len(ids)), np.uint64)
    at = 0
    for i, e in enumerate(each):
        own = inverse[at : at + len(e)]
        for k in range(len(_STAT_FIELDS)):
            sums[k, own] += unpacked(columns[2 + k][i], len(e))
        at += len(e)
    hist = np.array(table.column("hist").to_pylist(), np.int64).sum(axis=0).tolist()
    return ids, sums, hist, [s for some in table.column("shards").to_pylist() for s in some]


def _stats_on(vocabulary: Shards, low: int, table: pa.Table) -> pa.Table:
    return _stat_rows(vocabulary, *_added(table), low, table.column("salt")[0].as_py())


def _write_contexts(folder: str, vocabulary: Shards, table: pa.Table) -> pa.Table:
    target = table.column("target")[0].as_py()
    low, n = int(vocabulary.before[target]), int(vocabulary.before[target + 1] - vocabulary.before[target])
    ids, some, hist, shards = _added(table)
    sums = np.zeros((len(_STAT_FIELDS), n), np.uint64)
    sums[:, ids - low] = some
    for k, f in enumerate(_STAT_FIELDS):
        write_file(f"{folder}/words-{target:06d}.{f}", packed(sums[k]))
    b = sums[-1]
    return pa.table({"hist": [hist], "before": [[int((b == k).sum()) for k in (1, 2, 3, 4)] + [int((b >= 3).sum()), int(b.sum())]], "shards": pa.array([shards], pa.list_(pa.string()))})


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Of entries seen once, twice, three times or more; kept within
    [0, count] where few data give other values."""
    if not n1:
        return 0.0, 0.0, 0.0
    y = n1 / (n1 + 2 * n2)
    d1 = 1 - 2 * y * n2 / n1
    d2 = 2 - 3 * y * n3 / n2 if n2 else d1
    d3 = 3 - 4 * y * n4 / n3 if n3 else d2
    return tuple(float(np.clip(d, 0.0, k)) for d, k in zip((d1, d2, d3), (1, 2, 3)))


@dataclass(frozen=True)
class Model:
    words: Shards
    pairs: Shards
    tokens: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    #: Words with 1, 2, 3 or more different words before them; their sum.
    before: tuple[int, int, int, int]


#: Words' numbers below this fit a pair in 64 bits.
NARROW = 1 << 32


def _shards(folder: str, name: str, bits: int, entries: dict[int, int], extra: int = 0, wide: bool = False) -> Shards:
    """Stores the entries before each shard, and ``extra`` ones at the end."""
    counts = np.zeros((1 << bits) + 2, np.int64)
    counts[1 + np.array(list(entries), np.int64)] = list(entries.values())
    counts[-1] = extra
    before = np.cumsum(counts)
    write_file(f"{folder}/{name}.before", before.astype("<u8").tobytes())
    return Shards(folder, name, bits, int(before[-2]), wide)


def build(texts: DataFrame, folder: str | None = None) -> Model:
    """Counts the rows of ``texts`` (column t, not null) into a new folder."""
    spark = texts.sparkSession
    folder = folder or scratch(spark, "model")
    size = texts.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0)).alias("n")).first()["n"]
    bits, step = max(2, int(np.ceil(np.log2(max(1, size / 6 / SHARD_TOKENS))))), STEP_BITS
    # One row for each shard comes back, here and below.
    counted = _in_steps(texts, _words_in, bits, step).groupBy("shard").applyInArrow(on_table(_write_words, folder), "shard long, entries long, tokens long").collect()
    # The start context is numbered after all words.
    words = _shards(folder, "words", bits, {r["shard"]: r["entries"] for r in counted}, 1)
    wide = words.entries + 1 >= NARROW
    low = max(0, bits - step)
    dealt = _in_steps(texts, partial(_pairs_in, words=words, wide=wide), bits, step)
    stats = dealt.groupBy("shard").applyInArrow(on_table(_write_pairs, folder, words, low), STATS)
    while low:
        after = max(0, low - step)
        cells = stats.withColumn("salt", F.pmod(F.xxhash64("salt"), F.lit(1 << low)))
        stats, low = cells.groupBy("target", "salt").applyInArrow(on_table(_stats_on, words, after), STATS), after
    made = stats.groupBy("target").applyInArrow(on_table(_write_contexts, folder, words), "hist array<long>, before array<long>, shards array<string>").collect()
    hist = np.array([r["hist"] for r in made], np.int64).reshape(-1, 4).sum(axis=0).tolist()
    before = np.array([r["before"] for r in made], np.int64).reshape(-1, 6).sum(axis=0).tolist()
    entries = {int(s): int(e) for r in made for s, e in (x.split(":") for x in r["shards"])}
    return Model(
        words,
        _shards(folder, "pairs", bits, entries, wide=wide),
        sum(r["tokens"] for r in counted),
        discounts(*hist),
        discounts(*before[:4]),
        (before[0], before[1], before[4], before[5]),
    )


def _discounted(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.maximum(counts - np.array([0.0, *d])[np.minimum(counts, 3).astype(np.int64)], 0)


def _at(shards: Shards, fields: list[str], places: np.ndarray) -> list[np.ndarray]:
    """Fields at places in any order."""
    distinct, inverse = np.unique(places, return_inverse=True)
    return [gather(shards, f, distinct)[inverse] for f in fields]


def _pair_counts(pairs: Shards, before: np.ndarray, word: np.ndarray) -> np.ndarray:
    keys = pair_key(before, word, pairs.wide)
    order = np.argsort(keys[0], kind="stable")
    out = np.empty(len(order))
    out[order] = gather(pairs, "count", find(pairs, *(k[order] for k in keys)))
    return out


def score_texts(texts: list[str], model: Model) -> list[tuple[int, int, float, float]]:
    """(tokens, known tokens, base score, model's score) of each text."""
    numbers, lengths, first = _numbered(texts, model.words)
    v = model.words.entries
    count, before = _at(model.words, ["count", "before"], numbers) if v else (np.zeros(len(numbers)),) * 2
    base = np.log10((count + 0.5) / (model.tokens + 0.5 * (v + 1)))
    total = model.before[3]
    if total:
        g = sum(d * n for d, n in zip(model.word_discounts, model.before)) / total
        low = _discounted(before, model.word_discounts) / total + g / (v + 1)
        left, right = _pairs_of(numbers, first, v)
        context, ones, twos, more = _at(model.words, list(_STAT_FIELDS[:4]), left)
        known = (left >= 0) & (right >= 0)
        pair = np.zeros(len(numbers))
        pair[known] = _pair_counts(model.pairs, left[known], right[known])
        d1, d2, d3 = model.pair_discounts
        some = np.maximum(context, 1)
        p = np.where(context > 0, _discounted(pair, model.pair_discounts) / some + (d1 * ones + d2 * twos + d3 * more) / some * low, low)
    else:
        p = np.full(len(numbers), 1 / (v + 1))
    logs = np.log10(p)
    edge = np.cumsum(lengths) - lengths
    return list(zip(lengths.tolist(), np.add.reduceat((count > 0).astype(np.int64), edge).tolist(), np.add.reduceat(base, edge).tolist(), np.add.reduceat(logs, edge).tolist()))


def _score(model: Model, batches):
    for b in batches:
        rows = score_texts(b.column("t").to_pylist(), model) if b.num_rows else []
        columns = list(zip(*rows)) or [[]] * 4
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), *(pa.array(c, k) for c, k in zip(columns, kinds))], ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])


def lm_scores(docs: DataFrame, learn: Column, folder: str | None = None) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    perplexity) of every row, from a model of the rows where ``learn`` holds.

    Null and empty texts are the end token alone; words that weren't learnt
    have the share of unseen words; without any learnt row all words are alike;
    rows that repeat are learnt each and scored each; long texts are read
    whole; an empty table gives an empty result; only doc_id and text (and what
    ``learn`` names) are read.
    """
    tune(docs.sparkSession)
    rows = spread(docs.select(F.col("doc_id"), (~F.coalesce(learn, F.lit(False))).alias("held_out"), text_or_empty("text").alias("t")))
    model = build(rows.filter(~F.col("held_out")).select("t"), folder)
    scored = rows.mapInArrow(partial(_score, model), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity")
    )
