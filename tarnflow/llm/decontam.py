"""Benchmark decontamination by winnowing.

Of every window of ``w`` successive k-grams a text keeps the least hash (the
rightmost of equals).  Two texts that share k + w - 1 words share a window, so
they keep the same k-gram of it: with k + w - 1 = 10, no shared run of ten
words is missed.  Fingerprints of documents are looked up among those of the
benchmark, and each match is extended word by word in both directions; runs of
ten words or more are hits.

Items of fewer than ten words are one window of their own length.  No
winnowing reaches them, so all runs of that length are looked up.

Words are compared by their 64-bit hashes.  A benchmark of up to BLOCK_BYTES
goes to all tasks as sorted arrays, and documents are read once and not moved.
A larger one stays where it is: documents' fingerprints that pass a bitmap of
the benchmark's are joined with these by hash, and matches are extended where
the document's and the items' words meet, also after one pass over the texts.
"""

from __future__ import annotations

import pickle
import uuid
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import claim, gram_hashes, materialise, mix64, spread, tune, word_hashes

#: Words are runs of 0-9, a-z (A-Z lower-cased) and all that isn't ASCII.
_WORD = b"0123456789abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_TABLE = bytes((c + 32 if 65 <= c <= 90 else c if c in _WORD else 32) for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


@dataclass(frozen=True)
class Winnow:
    window: int = 10  # words of a window; the shortest run that counts
    k: int = 6

    @property
    def w(self) -> int:
        return self.window - self.k + 1


def winnowed(grams: np.ndarray, w: int) -> np.ndarray:
    """Places of the kept grams, ascending."""
    n = len(grams) - w + 1
    if n <= 0:
        return np.empty(0, np.int64)
    least, place = grams[w - 1 : w - 1 + n].copy(), np.full(n, w - 1)
    for i in range(w - 2, -1, -1):  # rightmost of equals: strictly less only
        here = grams[i : i + n]
        less = here < least
        least[less] = here[less]
        place[less] = i
    return np.unique(place + np.arange(n))


def prints_of(words: np.ndarray, how: Winnow) -> tuple[np.ndarray, np.ndarray, int]:
    """(hashes, places, words of a gram) of an item's fingerprints."""
    if len(words) < how.window:
        return gram_hashes(words, len(words)), np.zeros(1, np.int64), len(words)
    grams = gram_hashes(words, how.k)
    places = winnowed(grams, how.w)
    return grams[places], places, how.k


def sized(hashes: np.ndarray, n: int) -> np.ndarray:
    """Tells grams of different lengths apart."""
    return mix64(hashes + np.uint64(n))


def same_run(x: np.ndarray, y: np.ndarray) -> int:
    """Length of the common start."""
    n = min(len(x), len(y))
    differ = x[:n] != y[:n]
    first = int(differ.argmax()) if n else 0
    return first if n and differ[first] else n


def extend(words: np.ndarray, other: np.ndarray, p: int, q: int, n: int) -> tuple[int, int] | None:
    """The longest common run around words[p:p+n] == other[q:q+n]."""
    if same_run(words[p : p + n], other[q : q + n]) < n:
        return None
    a = p - same_run(words[max(0, p - q) : p][::-1], other[:q][::-1])
    return a, p + n + same_run(words[p + n :], other[q + n :])


class Extender:
    """Spans of one document from matches with one item after another."""

    def __init__(self, words: np.ndarray, how: Winnow):
        self.words, self.how, self.spans = words, how, []

    def item(self, other: np.ndarray, places: list[tuple[int, int]]) -> bool:
        """places: (p, q) of equal grams, by p.  Whether a window occurs."""
        short = len(other) < self.how.window
        n, found = len(other) if short else self.how.k, False
        reached: dict[int, int] = {}  # diagonal -> end of its last run
        for p, q in places:
            if reached.get(p - q, -1) > p and not short:
                continue
            run = (p, p + n) if short and same_run(self.words[p : p + n], other) == n else None if short else extend(self.words, other, p, q, n)
            if run is None:
                continue
            reached[p - q] = run[1]
            if short or run[1] - run[0] >= self.how.window:
                self.spans.append(run)
                found = True
        return found


class Index:
    """Fingerprints of a benchmark as sorted arrays."""

    def __init__(self, items: list[tuple[object, str | None]], how: Winnow):
        self.how, self.names, self.words = how, [], []
        keys, owners, places = [], [], []
        self.lengths: set[int] = set()  # of items that are one shorter window
        for item_id, text in items:
            words = word_hashes(words_of(text))
            if not len(words):
                continue
            hashes, at, n = prints_of(words, how)
            if len(words) < how.window:
                self.lengths.add(n)
            keys.append(sized(hashes, n))
            owners.append(np.full(len(at), len(self.names), np.int64))
            places.append(at)
            self.names.append(None if item_id is None else str(item_id))
            self.words.append(words)
        keys, owners, places = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (keys, owners, places))
        order = np.argsort(keys, kind="stable")
        self.keys, self.owners, self.places = keys[order].astype(np.uint64), owners[order], places[order]

    def match(self, words: np.ndarray) -> tuple[list[tuple[int, int]], set[int]]:
        """(spans of words that are hit, items with a window that occurs)."""
        look = Extender(words, self.how)
        matches: dict[int, list[tuple[int, int]]] = {}
        for keys, at in looked_up(words, self.how, self.lengths):
            low, high = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
            for i in np.flatnonzero(high > low).tolist():
                for j in range(low[i], high[i]):
                    matches.setdefault(int(self.owners[j]), []).append((int(at[i]), int(self.places[j])))
        found = {item for item, places in matches.items() if look.item(self.words[item], sorted(places))}
        return look.spans, found


def looked_up(words: np.ndarray, how: Winnow, lengths: set[int]):
    """(keys, places) of a document's fingerprints: its winnowed grams, and all
    runs of the shorter windows' lengths."""
    grams = gram_hashes(words, how.k)
    kept = winnowed(grams, how.w)
    yield sized(grams[kept], how.k), kept
    for n in sorted(lengths):
        grams = gram_hashes(words, n)
        yield sized(grams, n), np.arange(len(grams))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


#: Bytes of benchmark text that go to all tasks; a larger one is joined.
BLOCK_BYTES = 32 << 20
_SPAN = pa.list_(pa.struct([("a", pa.int64()), ("z", pa.int64())]))
_SPANS = "n_words bigint, spans array<struct<a:bigint,z:bigint>>, items array<string>"
_INDEXES: dict[str, Index] = {}


def _spans_column(spans: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"a": a, "z": z} for a, z in s] for s in spans], _SPAN)


def _index(name: str, broadcast, how: Winnow) -> Index:
    """Built once in a worker, not in every task."""
    claim("benchmark index", _INDEXES.clear, beside="word hashes")
    if name not in _INDEXES:
        _INDEXES.clear()
        _INDEXES[name] = Index(pickle.loads(broadcast.value), how)
    return _INDEXES[name]


def _matcher(name: str, broadcast, how: Winnow, batches):
    index = None
    for b in batches:
        index = index or _index(name, broadcast, how)
        n, spans, items = [], [], []
        for text in b.column("t").to_pylist():
            words = word_hashes(words_of(text))
            s, found = index.match(words)
            n.append(len(words))
            spans.append(merged(s))
            items.append(sorted({index.names[i] for i in found} - {None}))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc"), pa.array(n, pa.int64()), _spans_column(spans), pa.array(items, pa.list_(pa.string()))], ["doc", "n_words", "spans", "items"]
        )


def _clean(name: str, broadcast, how: Winnow, text_col: str, batches):
    index = None
    for b in batches:
        index = index or _index(name, broadcast, how)
        yield b.filter(pa.array([not index.match(word_hashes(words_of(t)))[0] for t in b.column(text_col).to_pylist()], pa.bool_()))


# The way for a benchmark that is too large to send.


def _item_words(batches):
    for b in batches:
        hashes = [word_hashes(words_of(t)).tobytes() for t in b.column("t").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("name"), pa.array(hashes, pa.binary())], ["name", "words"])


def _item_prints(how: Winnow, batches):
    for b in batches:
        for item, raw in zip(b.column("item").to_pylist(), b.column("words").to_pylist()):
            hashes, at, n = prints_of(np.frombuffer(raw, np.uint64), how)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sized(hashes, n).view(np.int64)), pa.array(np.full(len(at), item, np.int64)), pa.array(at.astype(np.int64)), pa.array(np.full(len(at), n if n < how.k or len(raw) < 8 * how.window else 0, np.int32))],
                ["key", "item", "q", "short"],
            )


def _document_prints(bitmap, bits: int, how: Winnow, lengths: set[int], batches):
    """One row a document: its words' number and, where some fingerprint passes
    the bitmap, those and its words."""
    marks = np.frombuffer(bitmap.value, np.uint8)
    for b in batches:
        n, keys, places, words = [], [], [], []
        for text in b.column("t").to_pylist():
            own = word_hashes(words_of(text))
            some = list(looked_up(own, how, lengths))
            key, at = np.concatenate([k for k, _ in some]), np.concatenate([p for _, p in some])
            place = key >> np.uint64(64 - bits)
            there = np.flatnonzero((marks[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1)
            n.append(len(own))
            keys.append(key[there].view(np.int64))
            places.append(at[there].astype(np.int64))
            words.append(own.tobytes() if len(there) else None)
        kind = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([b.column("doc"), pa.array(n, pa.int64()), pa.array(keys, kind), pa.array(places, kind), pa.array(words, pa.binary())], ["doc", "n_words", "keys", "places", "words"])


def _extend_rows(how: Winnow, batches):
    """Rows in order of a document's number, each led by the document's own
    words (its item is null) and followed by the items that it meets."""
    row, look, names = None, None, set()

    def done() -> pa.RecordBatch:
        some = look is not None and look.spans
        return pa.RecordBatch.from_arrays(
            [pa.array([row] if some else [], pa.int64()), _spans_column([merged(look.spans)] if some else []), pa.array([sorted(names - {None})] if some else [], pa.list_(pa.string()))], ["row", "spans", "items"]
        )

    for b in batches:
        for r, item, name, at, raw in zip(*(b.column(c).to_pylist() for c in ("row", "item", "name", "at", "words"))):
            words = np.frombuffer(raw, np.uint64)
            if item is None:
                yield done()
                row, look, names = r, Extender(words, how), set()
            elif look.item(words, sorted((x["p"], x["q"]) for x in at)):
                names.add(name)
    yield done()


def _bitmap(keys: DataFrame) -> tuple[bytes, int]:
    """A bitmap of the keys' leading bits, of 16 MB at most: ten bits a key up
    to 13 million keys, beyond that it lets more pass, and the join drops them."""
    bits = int(np.clip(np.ceil(np.log2(10 * max(1, keys.count()))), 10, 27))
    place = F.shiftrightunsigned("key", 64 - bits)
    found = keys.select(F.shiftright(place, 3).alias("byte"), F.expr(f"shiftleft(1, cast(shiftrightunsigned(key, {64 - bits}) % 8 AS int))").alias("bit")).groupBy("byte").agg(F.bit_or("bit").alias("marks")).toArrow()
    marks = np.zeros(1 << (bits - 3), np.uint8)
    marks[found.column("byte").to_numpy()] = found.column("marks").to_numpy()
    return marks.tobytes(), bits


def _joined(rows: DataFrame, items: DataFrame, how: Winnow) -> DataFrame:
    """(doc, n_words, spans, items) of rows (doc, t) by joins."""
    spark = rows.sparkSession
    bench = materialise(items.mapInArrow(_item_words, "name string, words binary").filter(F.length("words") > 0).withColumn("item", F.monotonically_increasing_id()), "items")
    prints = materialise(bench.select("item", "words").mapInArrow(partial(_item_prints, how), "key bigint, item bigint, q bigint, short int"), "prints")
    lengths = {r[0] for r in prints.filter("short > 0").select("short").distinct().collect()}  # below the window
    marks, bits = _bitmap(prints.select("key").distinct())
    shape = "doc bigint, n_words bigint, keys array<bigint>, places array<bigint>, words binary"
    shape = shape.replace("doc bigint", f"doc {rows.schema['doc'].dataType.simpleString()}")
    signed = spread(rows).mapInArrow(partial(_document_prints, spark.sparkContext.broadcast(marks), bits, how, lengths), shape)
    signed = materialise(signed.withColumn("row", F.monotonically_increasing_id()), "documents")
    each = signed.filter("words is not null").select("row", F.explode(F.arrays_zip("keys", "places")).alias("k")).select("row", F.col("k.keys").alias("key"), F.col("k.places").alias("p"))
    met = each.join(prints.select("key", "item", "q"), "key").groupBy("row", "item").agg(F.collect_list(F.struct("p", "q")).alias("at"))
    met = materialise(met.join(bench, "item").select("row", "item", "name", "at", "words"), "met")
    lead = signed.select("row", "words").join(met.select("row").distinct(), "row", "left_semi")
    lead = lead.select("row", F.lit(None).cast("long").alias("item"), F.lit(None).cast("string").alias("name"), F.lit(None).cast(met.schema["at"].dataType).alias("at"), "words")
    ordered = lead.unionByName(met).repartition("row").sortWithinPartitions("row", F.asc_nulls_first("item"))
    hits = ordered.mapInArrow(partial(_extend_rows, how), "row bigint, spans array<struct<a:bigint,z:bigint>>, items array<string>")
    out = signed.select("row", "doc", "n_words").join(hits, "row", "left")
    none = lambda c: F.array().cast(hits.schema[c].dataType)
    return out.select("doc", "n_words", *[F.coalesce(c, none(c)).alias(c) for c in ("spans", "items")])


def _items(benchmark: DataFrame) -> tuple[DataFrame, bool]:
    """(name, t) of the items, and whether they are few enough to be sent."""
    items = benchmark.select(F.col("item_id").cast("string").alias("name"), F.col("text").cast("string").alias("t"))
    size = items.agg(F.sum(F.octet_length("t")).alias("t"), F.sum(F.octet_length("name")).alias("n"), F.count(F.lit(1)).alias("c")).first()
    return items, (size["t"] or 0) + (size["n"] or 0) + 16 * size["c"] <= BLOCK_BYTES


def _sent(items: DataFrame):
    return uuid.uuid4().hex, items.sparkSession.sparkContext.broadcast(pickle.dumps([tuple(r) for r in items.collect()]))


def contamination(docs: DataFrame, benchmark: DataFrame, how: Winnow = Winnow(), id_col: str = "doc_id") -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated, spans) of
    every row; spans are the hit words' runs [a, z).

    Null and empty texts have no words; items without words have no window;
    item ids that repeat count once; an item without an id marks words but is
    counted in neither n_items nor items_sha256; rows that repeat an id have a
    row each; long texts are read whole; documents' other columns are not read;
    empty tables give empty results or no hits.
    """
    tune(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc"), F.col("text").cast("string").alias("t"))
    items, few = _items(benchmark)
    if few:
        kind = rows.schema["doc"].dataType.simpleString()
        found = spread(rows).mapInArrow(partial(_matcher, *_sent(items), how), f"doc {kind}, {_SPANS}")
    else:
        found = _joined(rows, items, how)
    # n_hit from the merged spans
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["z"] - x["a"])
    return found.select(
        F.col("doc").alias(id_col),
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        "spans",
    )


def clean_rows(docs: DataFrame, benchmark: DataFrame, how: Winnow = Winnow(), text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a benchmark window, whole; columns may have
    any names.  Nulls, repeats and empty tables are as in contamination; rows
    are judged one by one, so ids aren't needed."""
    tune(docs.sparkSession)
    items, few = _items(benchmark)
    if few:
        inner = {c: f"c{i}" for i, c in enumerate(docs.columns)}
        plain = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in inner.items()])
        out = spread(plain).mapInArrow(partial(_clean, *_sent(items), how, inner[text_col]), plain.schema)
        return out.select(*[F.col(n).alias(c) for c, n in inner.items()])
    # Texts are named by 128 bits, so equal ones share a verdict.
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r"), F.struct(F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), text).alias("h2")).alias("h"))
    texts = docs.select(F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), text).alias("h2"), text.alias("t"))
    dirty = _joined(texts.select(F.concat_ws(" ", "h1", "h2").alias("doc"), "t"), items, how).filter(F.size("spans") > 0).select("doc").distinct()
    return rows.join(materialise(dirty, "dirty"), F.concat_ws(" ", "h.h1", "h.h2") == F.col("doc"), "left_anti").select("r.*")
