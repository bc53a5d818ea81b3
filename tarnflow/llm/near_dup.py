"""Near-duplicate documents: MinHash bands, odd sketches, full sets.

1. One pass makes each row's shingle set, its digest, the keys of its MinHash
   bands and its odd sketch (every MinHash sample toggles one bit), and numbers
   the rows.  All that follows goes by these numbers, so ids may be missing or
   repeat.
2. Rows with equal sets are one class, stood for by the least row.
3. Representatives that share a band are candidates.  In each bucket all are
   compared with one pivot, so a bucket of m costs m - 1 pairs, not m * m / 2.
   The pivot is the member that meets most others over all its buckets: the
   text that a group was copied from shares more bands with its copies than
   they do with each other, and links with those that don't.
   The first bands join most of a group of copies; the others then compare
   only what lies in different components, first with the pivot and, where
   that leaves several components among the rest, with each other, in cells of
   bounded size and in the first bucket that both are in alone.
4. A candidate must pass the sketches' estimate (population count of the XOR)
   and is then confirmed on the full sets of both texts.  A second bitmap holds
   the parity of the whole set: its XOR never has more bits than the sets have
   different shingles, so it rules out pairs for certain, and nearly all that
   fall short where texts are not very long.  Only candidates' sets move, each
   pivot's once for each bounded part of its partners.

At similarity 0.8, 40 bands of 6 miss a pair with probability 5e-6, and the
margin of the sketch test is more than five standard deviations.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .common import gram_hashes, materialise, mix64, scratch, space_words, spread, tune, word_hashes


@dataclass(frozen=True)
class NearRule:
    shingle: int = 5  # words
    percent: int = 80  # least similarity
    bands: int = 40
    rows: int = 6
    first: int = 4  # bands of the first round
    bits: int = 1024  # of a sketch
    margin: float = 0.15  # the sketch's estimate may be so much too low

    @property
    def samples(self) -> int:
        return self.bands * self.rows

    @property
    def most_odd(self) -> int:
        """Greatest XOR count that passes: at similarity s, 2 (1 - s) samples
        differ, which leaves bits / 2 (1 - exp(-2 differing / bits)) odd."""
        differing = 2 * self.samples * (1 - (self.percent / 100 - self.margin))
        return math.ceil(self.bits / 2 * (1 - math.exp(-2 * differing / self.bits)))


def shingle_set(words: list[bytes], n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes; a shorter text is one shingle."""
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(gram_hashes(word_hashes(words), min(n, len(words))))


class _Hasher:
    def __init__(self, rule: NearRule):
        rng = np.random.default_rng(20240917)
        self.rule = rule
        self.a = (rng.integers(0, 2**31, rule.samples, np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
        self.r = rng.integers(0, 2**32, rule.samples, np.uint32)[:, None]
        self.band = mix64(np.arange(1, rule.bands + 1, dtype=np.uint64) << np.uint64(40))
        self.sample = np.arange(1, rule.samples + 1, dtype=np.uint64) << np.uint64(32)
        self.work = np.empty((rule.samples, 512), np.uint32)

    def minimums(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        least = np.full(self.rule.samples, 0xFFFFFFFF, np.uint32)
        for i in range(0, len(x), 512):
            part = x[None, i : i + 512]
            work = self.work[:, : part.shape[1]]
            np.bitwise_xor(part, self.r, out=work)
            np.multiply(work, self.a, out=work)
            np.minimum(least, work.min(axis=1), out=least)
        return least

    def keys(self, least: np.ndarray) -> np.ndarray:
        rows = least.reshape(self.rule.bands, self.rule.rows).astype(np.uint64)
        key = self.band.copy()
        for i in range(self.rule.rows):
            key = mix64(key + rows[:, i])
        return key.view(np.int64)

    def sketch(self, least: np.ndarray) -> np.ndarray:
        at = mix64(self.sample + least) % np.uint64(self.rule.bits)
        return self._parity(at)

    def whole(self, shingles: np.ndarray) -> np.ndarray:
        return self._parity(shingles % np.uint64(self.rule.bits))

    def _parity(self, at: np.ndarray) -> np.ndarray:
        odd = np.bincount(at.astype(np.int64), minlength=self.rule.bits) & 1
        return np.packbits(odd.astype(np.uint8)).view(np.int64)


_SIGNATURE = "doc bigint, h1 bigint, h2 bigint, n_shingles bigint, digest binary, bands array<bigint>, sketch array<bigint>, whole array<bigint>"


def text_key(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), text).alias("h2")]


def _signatures(rule: NearRule, batches):
    hasher = _Hasher(rule)
    for b in batches:
        n, digest, bands, sketch, whole = [], [], [], [], []
        for text in b.column("t").to_pylist():
            s = shingle_set(space_words(text) if text else [], rule.shingle)
            n.append(len(s))
            if len(s):
                least = hasher.minimums(s)
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                bands.append(hasher.keys(least))
                sketch.append(hasher.sketch(least))
                whole.append(hasher.whole(s))
            else:
                digest.append(None)
                bands.append(None)
                sketch.append(None)
                whole.append(None)
        kind = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [*(b.column(c) for c in ("doc", "h1", "h2")), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(bands, kind), pa.array(sketch, kind), pa.array(whole, kind)],
            ["doc", "h1", "h2", "n_shingles", "digest", "bands", "sketch", "whole"],
        )


def _sets(rule: NearRule, batches):
    """Full sets of candidates' texts; of rows that repeat, one from each task."""
    seen: set[int] = set()
    for b in batches:
        nodes, sets = [], []
        for node, alone, text in zip(*(b.column(c).to_pylist() for c in ("node", "alone", "t"))):
            if node in seen:
                continue
            if not alone:
                seen.add(node)
            nodes.append(node)
            sets.append(shingle_set(space_words(text or ""), rule.shingle).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], ["node", "shingles"])


def _confirm(rule: NearRule, batches):
    """Links among rows in order of (a, part), each led by a's own set (its z
    is null) and followed by its partners'."""
    at, x = None, None
    for b in batches:
        found: list[tuple[int, int]] = []
        shingles = b.column("shingles")
        for i, (a, part, z) in enumerate(zip(*(b.column(c).to_pylist() for c in ("a", "part", "z")))):
            own = np.frombuffer(shingles[i].as_py(), np.uint64)
            if z is None:
                at, x = (a, part), own
                continue
            if at != (a, part):
                raise ValueError("a set came before its pivot's")
            both = int((x[np.minimum(np.searchsorted(x, own), len(x) - 1)] == own).sum())
            if 100 * both >= rule.percent * (len(x) + len(own) - both):
                found.append((a, z))
        columns = list(zip(*found)) or [[], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "z"])


#: Rows up to this many are sent to all tasks (about 100 bytes each) to pick
#: the texts of candidates; beyond it, texts are dealt out by key.
BROADCAST_KEYS = 1_000_000
#: Shingles of the partners that one copy of a pivot's set meets.
PART_SHINGLES = 2_000_000
#: Members of one block of a bucket; a cell compares two blocks.
CELL = 1_000


def pick(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """docs (r, doc, h1, h2) joined with stored keys (kdoc, k1, k2) of rows."""
    if keys.count() <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    same = (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")) & F.col("doc").eqNullSafe(F.col("kdoc"))
    return docs.join(keys, same, how)


def _links(pairs: DataFrame, reps: DataFrame, rows: DataFrame, rule: NearRule) -> DataFrame:
    """The pairs (a, z) of nodes that are links; pairs are distinct."""
    left, right = _side(reps, "a"), _side(reps, "z")
    likely = materialise(pairs.join(left, "a").join(right, "z").filter(_likely(rule)).select("a", "z", "nz"), "likely")
    if likely.isEmpty():
        return likely.select("a", "z")
    nodes = likely.select(F.explode(F.array("a", "z")).alias("node")).distinct()
    wanted = materialise(reps.select("node", "alone", F.col("doc").alias("kdoc"), F.col("h1").alias("k1"), F.col("h2").alias("k2")).join(nodes, "node", "left_semi"), "wanted")
    texts = pick(rows, wanted, "inner").select("node", "alone", "t")
    each = materialise(texts.mapInArrow(partial(_sets, rule), "node bigint, shingles binary"), "sets")
    # Only a class of several rows can have a set more than once.
    sets = each.groupBy("node").agg(F.first("shingles").alias("shingles"))
    parts = likely.groupBy("a").agg(F.ceil(F.sum("nz") / PART_SHINGLES).cast("int").alias("parts"))
    own = parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("z"), F.col("a").alias("node"))
    others = likely.join(parts, "a").select("a", F.pmod(F.xxhash64("z"), F.col("parts")).cast("int").alias("part"), "z", F.col("z").alias("node"))
    meeting = own.unionByName(others).join(sets, "node").select("a", "part", "z", "shingles")
    ordered = meeting.repartition("a", "part").sortWithinPartitions("a", "part", F.asc_nulls_first("z"))
    return materialise(ordered.mapInArrow(partial(_confirm, rule), "a bigint, z bigint"), "links")


def _side(reps: DataFrame, name: str, *bands: Column) -> DataFrame:
    return reps.select(F.col("node").alias(name), F.col("n_shingles").alias(f"n{name}"), F.col("sketch").alias(f"s{name}"), F.col("whole").alias(f"w{name}"), *[b.alias(f"b{name}") for b in bands])


def _likely(rule: NearRule):
    """By size, by the whole sets' parity (both for certain) and by the odd
    sketches: sets as similar as asked for have at most (na + nz) (1 - s) /
    (1 + s) different shingles."""
    odd = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, v: s + v)
    sized = 100 * F.least("na", "nz") >= rule.percent * F.greatest("na", "nz")
    certain = (100 + rule.percent) * odd("wa", "wz") <= (100 - rule.percent) * (F.col("na") + F.col("nz"))
    return sized & certain & (odd("sa", "sz") <= rule.most_odd)


def _weighed(edges: DataFrame, tag: str) -> tuple[DataFrame, tuple[int, int]]:
    """Stored edges with their number and a sum that tells sets of edges apart,
    both taken while they are written."""
    seen = Observation()
    spark, path = edges.sparkSession, scratch(edges.sparkSession, tag)
    edges.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "z").bitwiseAND(F.lit((1 << 40) - 1))).alias("s")).write.parquet(path)
    return spark.read.schema(edges.schema).parquet(path), (seen.get["n"], seen.get["s"] or 0)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of edges (a, z), component being the
    least node that can be reached.  Large-star and small-star steps: each
    hangs neighbours on the least one around, and no step gathers a node's
    neighbours in one place.  The steps end for any graph, in a number that
    grows with the square of the logarithm of its nodes at most, so there is
    no bound on rounds."""
    ordered = edges.select(F.least("a", "z").alias("a"), F.greatest("a", "z").alias("z")).filter("a < z")
    now, seen = _weighed(_star(_star(ordered, True), False), "star")
    while seen[0]:
        after, sums = _weighed(_star(_star(now, True), False), "star")
        if sums == seen:
            break
        now, seen = after, sums
    tops = now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return now.select(F.col("z").alias("node"), F.col("a").alias("component")).unionByName(tops)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: distinct or not, a < z."""
    if large:
        near = edges.unionByName(edges.select(F.col("z").alias("a"), F.col("a").alias("z")))
        least = near.groupBy("a").agg(F.least(F.min("z"), F.first("a")).alias("m")).withColumnRenamed("a", "u")
        out = near.join(least, near.a == least.u).filter("z > u").select(F.col("m").alias("a"), "z")
    else:
        least = edges.groupBy("z").agg(F.min("a").alias("m")).withColumnRenamed("z", "u")
        linked = edges.join(least, edges.z == least.u)
        out = linked.select(F.col("m").alias("a"), F.col("a").alias("z")).unionByName(linked.select(F.col("m").alias("a"), F.col("u").alias("z")))
    return out.filter("a < z").distinct()


def _labelled(members: DataFrame, parts: DataFrame) -> DataFrame:
    """Adds each member's component, itself where it has no link."""
    named = parts.select(F.col("node").alias("__n"), "component")
    return members.join(named, members.node == named["__n"], "left").select(*members.columns, F.coalesce("component", "node").alias("component"))


def _pairs(members: DataFrame) -> DataFrame:
    """Each member with its bucket's pivot, once."""
    return members.filter("node != pivot").select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("z")).distinct()


def _pivots(met: DataFrame) -> DataFrame:
    """(band, key, node, pivot) of buckets' members (band, key, node, n): the pivot
    is the member with the most members in all its buckets, of several the least."""
    central = met.groupBy("node").agg(F.sum("n").alias("meets"))
    order = F.struct("meets", -F.col("node"))
    chosen = met.join(central, "node").groupBy("key").agg(F.max_by("node", order).alias("pivot"))
    return met.drop("n").join(chosen, "key")


def _crossed(rest: DataFrame, reps: DataFrame, rule: NearRule) -> DataFrame:
    """Likely pairs of one bucket's members in different components, each once.
    A large bucket is cut into blocks, and two blocks at a time meet in a cell, so
    no task has more than CELL * CELL comparisons of one bucket at once.  A pair
    that shares an earlier bucket meets there, or has met there, if one of them
    was its pivot."""
    large = materialise(rest.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / CELL).cast("int").alias("blocks")).filter("blocks > 1"), "large")
    # Large buckets are few; sent to all tasks, they don't gather a bucket's rows.
    large = F.broadcast(large) if large.count() <= BROADCAST_KEYS else large
    blocked = rest.join(large, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    x = blocked.select("key", "band", F.col("block").alias("i"), F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)).alias("j"), F.col("node").alias("a"), F.col("component").alias("ca"))
    y = blocked.select("key", "band", F.explode(F.sequence(F.lit(0), F.col("block"))).alias("i"), F.col("block").alias("j"), F.col("node").alias("z"), F.col("component").alias("cz"))
    x, y = (df.join(_side(reps, c, F.col("bands")), c).withColumn(f"b{c}", F.slice(f"b{c}", F.lit(1), F.col("band"))).drop("band") for df, c in ((x, "a"), (y, "z")))
    once = (F.col("x.i") < F.col("x.j")) | (F.col("a") < F.col("z"))
    # What fails the sketches, or shares an earlier band, never leaves the join.
    met = x.alias("x").join(y.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.i") == F.col("y.i")) & (F.col("x.j") == F.col("y.j")) & once & (F.col("ca") != F.col("cz")) & _likely(rule) & ~F.arrays_overlap("ba", "bz"))
    return met.select(F.least("a", "z").alias("a"), F.greatest("a", "z").alias("z")).distinct()


def _groups(docs: DataFrame, rule: NearRule, id_col: str, text_col: str, by_id: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, classes, repeated): every row (row, doc, h1, h2, n_shingles,
    digest); every class of equal sets (digest, group, component_id, several),
    group being the least row that can be reached and component_id the least
    id; ids of several rows (doc).  by_id: whether an id's texts are linked."""
    tune(docs.sparkSession)
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), text.alias("t"), *text_key(text))
    signed = materialise(spread(rows).mapInArrow(partial(_signatures, rule), _SIGNATURE).withColumn("row", F.monotonically_increasing_id()), "signatures")
    narrow = signed.select("row", "doc", "h1", "h2", "n_shingles", "digest")
    filled = narrow.filter("n_shingles > 0")
    classes = materialise(filled.groupBy("digest").agg(F.min("row").alias("rep"), F.min("doc").alias("least"), (F.count(F.lit(1)) == 1).alias("alone")), "classes")
    chosen = classes.select(F.col("digest").alias("d"), "rep", "alone")
    reps = materialise(signed.join(chosen, (F.col("digest") == F.col("d")) & (F.col("row") == F.col("rep"))).drop("digest", "d", "rep").withColumnRenamed("row", "node"), "reps")
    keyed = reps.select(F.posexplode("bands").alias("band", "key"), "node")
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = materialise(_pivots(materialise(keyed.join(shared, "key"), "met")), "members")

    repeated = narrow.filter("doc is not null").groupBy("doc").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc")
    repeated = materialise(repeated if by_id else repeated.filter("false"), "repeated")
    twins = filled.join(repeated, "doc", "left_semi").join(classes.select("digest", "rep"), "digest")
    first = twins.groupBy("doc").agg(F.min("rep").alias("a"))
    links = materialise(twins.join(first, "doc").select("a", F.col("rep").alias("z")).filter("a < z").distinct(), "same")

    # A few bands first: they join most of a group of copies, and then no
    # other band compares what is in one component already.
    links = links.unionByName(_links(_pairs(members.filter(F.col("band") < rule.first)), reps, rows, rule))
    parts = components(links)
    placed = materialise(_labelled(members.select("key", "band", "node", "pivot"), parts), "placed")
    home = parts.select(F.col("node").alias("pivot"), F.col("component").alias("home"))
    apart = placed.join(home, "pivot", "left").filter(F.col("component") != F.coalesce("home", "pivot"))
    more = _links(_pairs(apart), reps, rows, rule)
    if not more.isEmpty():
        links = links.unionByName(more)
        parts = components(links)
    # Pairs with the pivot are settled; others of one component need none.
    open_rows = _labelled(placed.filter("node != pivot").select("key", "band", "node"), parts)
    mixed = open_rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo != hi").select("key")
    rest = materialise(open_rows.join(mixed, "key", "left_semi").select("key", "band", "node", "component"), "rest")
    if not rest.isEmpty():
        more = _links(_crossed(rest, reps, rule), reps, rows, rule)
        if not more.isEmpty():
            parts = components(links.unionByName(more))
    placed = classes.join(parts, classes.rep == parts.node, "left").select("digest", "rep", "least", "alone", "component")
    lowest = placed.filter("component is not null").groupBy("component").agg(F.min("least").alias("low")).withColumnRenamed("component", "c")
    named = placed.join(lowest, F.col("component") == F.col("c"), "left").select(
        "digest",
        F.coalesce("component", "rep").alias("group"),
        F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("low")).alias("component_id"),
        (F.col("component").isNotNull() | ~F.col("alone")).alias("several"),
    )
    return narrow, named, repeated


def near_classes(docs: DataFrame, rule: NearRule = NearRule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row.

    Two rows are linked if their shingle sets' similarity is at least
    ``percent``; component_id is the least id that can be reached; kept marks
    the rows of that id.  Null, empty and blank texts have no shingles and are
    linked with nothing; a text of fewer words than a shingle is one shingle;
    rows that repeat an id count as one document, with all their texts' links;
    a row without an id takes its copies' component and is kept if none of them
    has an id and it is the first; long texts are read whole; an empty table
    gives an empty result; other columns are not read.
    """
    narrow, named, repeated = _groups(docs, rule, id_col, text_col, True)
    out = narrow.join(named, "digest", "left").withColumn("component_id", F.when(F.col("digest").isNull(), F.col("doc")).otherwise(F.col("component_id")))
    if not repeated.isEmpty():
        # An id's rows without words go with its others.
        lowest = out.join(repeated, "doc", "left_semi").groupBy("doc").agg(F.min("component_id").alias("low"))
        out = out.join(lowest, "doc", "left").withColumn("component_id", F.coalesce("low", "component_id"))
    first = F.col("component_id").isNull() & (F.col("row") == F.coalesce("group", "row"))
    return out.select(F.col("doc").alias(id_col), "n_shingles", "component_id", F.when(F.col("doc").isNull(), first).otherwise(F.col("doc") == F.col("component_id")).alias("kept"))


def one_of_each(docs: DataFrame, rule: NearRule = NearRule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, one of each group of near copies: that of the
    least id, or one of several rows that have it; of a group without ids, the
    first.  Rows without words all stay.  Links are those of texts alone: an
    id that repeats with another text is a document of its own.  Columns may
    have any names; an empty table gives an empty result.

    Rows are told apart by id and text.  Those that equal the chosen one in
    both are brought together, and one of them stays, whatever their other
    columns hold.
    """
    narrow, named, _ = _groups(docs, rule, id_col, text_col, False)
    members = narrow.join(named.filter("several").select("digest", "group"), "digest")
    order = F.struct(F.col("doc").isNull().alias("none"), "doc", "row", "h1", "h2")
    chosen = members.groupBy("group").agg(F.min(order).alias("c"))
    others = members.join(chosen, "group").filter(F.col("row") != F.col("c.row"))
    twin = F.col("doc").eqNullSafe(F.col("c.doc")) & (F.col("h1") == F.col("c.h1")) & (F.col("h2") == F.col("c.h2"))
    gone = materialise(others.select(F.col("doc").alias("kdoc"), F.col("h1").alias("k1"), F.col("h2").alias("k2"), twin.alias("twin")).distinct(), "gone")
    text = F.col(text_col).cast("string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r"), F.col(id_col).cast("long").alias("doc"), *text_key(text))
    left = pick(rows, gone.filter("not twin").drop("twin"), "left_anti")
    twins = gone.filter("twin").drop("twin")
    if not twins.isEmpty():
        left = pick(left, twins, "left_anti").unionByName(pick(left, twins, "left_semi").dropDuplicates(["doc", "h1", "h2"]))
    return left.select("r.*")
