"""Token links between two tokenizers, over a dictionary of groups.

Byte offsets where tokens of both tokenizers end cut a text into groups: runs of
A ids beside runs of B ids that spell the same bytes.  A corpus has far fewer
distinct groups than groups, so each distinct one is interned once, its links
are expanded once, and counts come from how many documents hold it; documents
get their sums back by joining on the group's key.

An id pair's count is of distinct documents.  A document that holds a pair in
several distinct groups would be counted once for each, so tasks also say how
many times too many, for the pairs where that happens; the rest is exact without
a row for each document and pair.
"""

from __future__ import annotations

import array
import hashlib
import os
import re
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import claim, gathered, materialise, spread, text_or_empty, tune

#: White space, or characters that libraries may class differently.  Texts are
#: cut only at a blank or line end that has none of them beside it.
_SPACES = "\\s\\0\\x1c-\\x1f\\x85\\u180e\\u200b\\u2060\\ufeff"
_CUT = re.compile(f"(?<=[^{_SPACES}])(?=[ \n][^{_SPACES}])")
_ODD = re.compile("[^\\S \n]|[\\0\\x1c-\\x1f\\x85\\u180e\\u200b\\u2060\\ufeff]")


def _byte_alphabet() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves and
    the others, in order, as characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def keys_of(text: str) -> list[str]:
    """The text with a blank before it, cut into units that both tokenizers
    encode apart.  A unit's key leaves its first blank out; a line end is kept,
    and \\0 marks a key that would look like another."""
    parts = text.replace("\n", " \n").split(" ")
    if "" not in parts and "\n" not in parts and not _ODD.search(text):
        return parts
    units = _CUT.split(" " + text)
    return [u if u[0] == "\n" else "\0" + u[1:] if u[1:2] in ("\n", "\0") else u[1:] for u in units]


def _unit(key: str) -> str:
    return key if key[:1] == "\n" else " " + key[key[:1] == "\0" :]


class Units:
    """What a worker knows of units, groups and id pairs, by local numbers."""

    #: Units kept (about 300 bytes each), and units that one call encodes.
    LIMIT, CALL = 300_000, 8192
    #: A unit that is put before others, so that all begin within a text.
    LEAD = " ."

    def __init__(self, a_path: str, b_path: str, seed: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.tok, self.sp, self.seed = Tokenizer.from_file(a_path), sentencepiece.SentencePieceProcessor(model_file=b_path), seed
        self.tok.no_truncation()
        self.tok.no_padding()
        self.tok.encode_special_tokens = True
        bytes_of = _byte_alphabet()
        names = self.tok.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for name, token in names.items():
            self.a_bytes[token] = bytes(bytes_of[c] for c in name) if all(c in bytes_of for c in name) else name.encode()
        sp = self.sp
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.widths = [np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes)]
        # Groups of up to two ids a side go by one number, where ids are small enough.
        self.packed = len(self.a_bytes) <= 1 << 16 and len(self.b_bytes) <= 1 << 15
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.facts = array.array("q")  # n_a, n_b, n_groups, n_links, 1 if the bytes differ
        self.unit_at, self.unit_groups = array.array("q", [0]), array.array("q")
        self.group: dict[int | bytes, int] = {}
        self.name: list[str] = []
        self.group_key = array.array("q")
        self.group_at, self.group_pairs = array.array("q", [0]), array.array("q")
        self.pair: dict[int, int] = {}

    def _group(self, key, a: list[int], b: list[int]) -> int:
        at = self.group.get(key)
        if at is None:
            name = f"{','.join(map(str, a))}|{','.join(map(str, b))}"
            at = self.group[key] = len(self.name)
            self.name.append(name)
            self.group_key.append(xxhash.xxh3_64_intdigest(name, self.seed) - (1 << 63))
            pair = self.pair
            for x in dict.fromkeys(a):
                for y in dict.fromkeys(b):
                    self.group_pairs.append(pair.setdefault(x << 32 | y, len(pair)))
            self.group_at.append(len(self.group_pairs))
        return at

    def _numbers(self, a: np.ndarray, b: np.ndarray, a_at: np.ndarray, b_at: np.ndarray) -> np.ndarray:
        """Local numbers of the groups that a_at and b_at bound."""
        n_a, n_b = np.diff(a_at), np.diff(b_at)
        out = np.empty(len(n_a), np.int64)
        small = (n_a <= 2) & (n_b <= 2) & self.packed
        i = np.flatnonzero(small)
        second = [np.where(n[i] == 2, ids[np.minimum(at[i] + 1, len(ids) - 1)], 0) for n, ids, at in ((n_a, a, a_at), (n_b, b, b_at))]
        head = ((n_a[i] - 1) * 2 + n_b[i] - 1).astype(np.uint64)
        key = head << np.uint64(62)
        for value, shift in ((a[a_at[i]], 46), (second[0], 30), (b[b_at[i]], 15), (second[1], 0)):
            key |= value.astype(np.uint64) << np.uint64(shift)
        known, first, back = np.unique(key, return_index=True, return_inverse=True)
        of = [self._group(k, a[a_at[j] : a_at[j + 1]].tolist(), b[b_at[j] : b_at[j + 1]].tolist()) for k, j in zip(known.tolist(), i[first].tolist())]
        out[i] = np.array(of, np.int64)[back]
        for j in np.flatnonzero(~small).tolist():
            x, y = a[a_at[j] : a_at[j + 1]], b[b_at[j] : b_at[j + 1]]
            out[j] = self._group(x.tobytes() + b"|" + y.tobytes(), x.tolist(), y.tolist())
        return out

    def _together(self, keys: list[str], units: list[str]) -> bool:
        """Adds units by one text that they make; False if that doesn't do."""
        text = self.LEAD + "".join(units)
        body = text.encode("utf-8", "surrogatepass")
        a = self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids
        b = self.sp.encode(text[1:], num_threads=1)  # the library puts a blank before a text
        if any(b"".join([side[i] for i in ids]) != body for side, ids in ((self.a_bytes, a), (self.b_bytes, b))):
            return False
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        a_ends, b_ends = np.cumsum(self.widths[0][a]), np.cumsum(self.widths[1][b])
        sizes = [len(self.LEAD), *(map(len, units) if len(body) == len(text) else [len(u.encode("utf-8", "surrogatepass")) for u in units])]
        stops = np.intersect1d(a_ends, b_ends, assume_unique=True)
        ends = np.cumsum(sizes)
        last = np.searchsorted(stops, ends)
        if not np.array_equal(stops[np.minimum(last, len(stops) - 1)], ends):
            return False
        a_at, b_at = (np.searchsorted(x, stops[last[0] :], side="right") for x in (a_ends, b_ends))
        edges = last - last[0]
        groups = self._numbers(a, b, a_at, b_at)
        links = np.concatenate(([0], np.cumsum(np.diff(a_at) * np.diff(b_at))))
        columns = [np.diff(a_at[edges]), np.diff(b_at[edges]), np.diff(edges), np.diff(links[edges]), np.zeros(len(units), np.int64)]
        self._add(keys, np.stack(columns, axis=1), edges[1:], groups)
        return True

    def _add(self, keys: list[str], facts: np.ndarray, edges: np.ndarray, groups: np.ndarray) -> None:
        first = len(self.number)
        self.number.update(zip(keys, range(first, first + len(keys))))
        self.facts.frombytes(np.ascontiguousarray(facts, np.int64).tobytes())
        self.unit_at.frombytes((edges + len(self.unit_groups)).astype(np.int64).tobytes())
        self.unit_groups.frombytes(groups.astype(np.int64).tobytes())

    def _alone(self, key: str) -> None:
        """A unit that can't stand beside others: at a text's start or end."""
        unit = _unit(key)
        body = unit.encode("utf-8", "surrogatepass")
        a = self.tok.encode(unit, add_special_tokens=False).ids
        b = self.sp.encode(unit[1:] if unit[0] == " " else unit, num_threads=1)
        if unit[0] != " ":
            b = b[1:] if b and self.b_bytes[b[0]] == b" " else []
        facts, groups = [0, 0, 0, 0, 1], np.empty(0, np.int64)
        if a and b and all(b"".join([side[i] for i in ids]) == body for side, ids in ((self.a_bytes, a), (self.b_bytes, b))):
            a, b = np.array(a, np.int64), np.array(b, np.int64)
            a_ends, b_ends = np.cumsum(self.widths[0][a]), np.cumsum(self.widths[1][b])
            stops = np.intersect1d(a_ends, b_ends, assume_unique=True)
            a_at, b_at = (np.concatenate(([0], np.searchsorted(x, stops, side="right"))) for x in (a_ends, b_ends))
            groups = self._numbers(a, b, a_at, b_at)
            facts = [len(a), len(b), len(stops), int((np.diff(a_at) * np.diff(b_at)).sum()), 0]
        self._add([key], np.array([facts]), np.array([len(groups)]), groups)

    def learn(self, keys: list[str]) -> None:
        plain = [k for k in keys if k and k[0] != "\0" and not _ODD.search(k) and k[k[0] == "\n" :].isprintable() and " " not in k and "\n" not in k[1:]]
        taken = set(plain) if len(plain) < len(keys) else ()
        odd = [k for k in keys if k not in taken] if len(plain) < len(keys) else []
        if plain and not self._together(plain, [_unit(k) for k in plain]):
            odd += plain
        for k in odd:
            self._alone(k)

    def numbers(self, keys: list[str]) -> list[int]:
        number = self.number
        new = [k for k in dict.fromkeys(keys) if k not in number]
        for i in range(0, len(new), self.CALL):
            self.learn(new[i : i + self.CALL])
        return [number[k] for k in keys]


def _ragged(at: array.array, values: array.array, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists of ``rows``, joined, and how long each is."""
    at, values = np.array(at, np.int64), np.array(values, np.int64)
    starts, sizes = at[rows], at[rows + 1] - at[rows]
    ends = np.cumsum(sizes)
    return values[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)], sizes


def _distinct(owner: np.ndarray, value: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (owner, value), in order, and how often each is there."""
    both, times = np.unique(owner * width + value, return_counts=True)
    return both // width, both % width, times


_UNITS: dict[tuple, Units] = {}


def _known(*names) -> Units:
    claim(names, lambda: _UNITS.pop(names, None))
    if names not in _UNITS:
        _UNITS[names] = Units(*names)
    return _UNITS[names]


_FACTS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, keys array<long>, times array<int>, key long, ids string, pair long, n long"


def _cut(a_path: str, b_path: str, seed: int, id_type: pa.DataType, batches):
    """Of each document its facts and distinct groups; of a task its distinct
    groups with the documents of each, and pairs counted too often."""
    kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = ["id", *(f.split()[0] for f in _FACTS.split(", "))]
    known = _known(a_path, b_path, seed)
    held, extra = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def rows(count: int, **columns):
        return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(count, k)) for c, k in zip(names, [id_type, *kinds])], names)

    def counted():
        used, more = np.flatnonzero(held), np.flatnonzero(extra)
        ids, pairs = known.name, np.fromiter(known.pair, np.int64, len(known.pair))
        keys = np.array(known.group_key, np.int64)
        for i in range(0, len(used), 20_000):
            some = used[i : i + 20_000]
            yield rows(len(some), key=pa.array(keys[some]), ids=pa.array([ids[j] for j in some]), n=pa.array(held[some]))
        for i in range(0, len(more), 20_000):
            some = more[i : i + 20_000]
            yield rows(len(some), pair=pa.array(pairs[some]), n=pa.array(extra[some]))

    for b in gathered(batches, size=4 << 20):
        if len(known.number) > known.LIMIT:
            yield from counted()
            known.forget()
            held, extra = np.zeros(0, np.int64), np.zeros(0, np.int64)
        units, edges = [], [0]
        for text in b.column("t"):
            text = text.as_py()
            if text:
                units += keys_of(text)
            edges.append(len(units))
        numbers = known.numbers(units)
        del units
        u, edges = np.array(numbers, np.int64), np.array(edges)
        facts = np.array(known.facts, np.int64).reshape(-1, 5)
        sums = np.concatenate((np.zeros((1, 5), np.int64), np.cumsum(facts[u], axis=0)))
        sums = sums[edges[1:]] - sums[edges[:-1]]
        good = (sums[:, 4] == 0) & (edges[1:] > edges[:-1])
        sums[~good] = 0
        doc = np.repeat(np.arange(len(good)), np.diff(edges))
        u, doc = u[good[doc]], doc[good[doc]]
        g, sizes = _ragged(known.unit_at, known.unit_groups, u)
        doc = np.repeat(doc, sizes)
        spelt, bounds, name = g.tolist(), np.searchsorted(doc, np.arange(len(good) + 1)).tolist(), known.name
        sha = [hashlib.sha256(";".join([name[i] for i in spelt[x:z]]).encode()).hexdigest() if ok else "" for x, z, ok in zip(bounds, bounds[1:], good.tolist())]
        doc, g, times = _distinct(doc, g, max(1, len(known.name)))
        p, sizes = _ragged(known.group_at, known.group_pairs, g)
        _, p, often = _distinct(np.repeat(doc, sizes), p, max(1, len(known.pair)))
        held = np.bincount(g, minlength=len(known.name)) + np.pad(held, (0, len(known.name) - len(held)))
        over = np.bincount(p[often > 1], weights=often[often > 1] - 1, minlength=len(known.pair)).astype(np.int64)
        extra = over + np.pad(extra, (0, len(known.pair) - len(extra)))
        at = pa.array(np.searchsorted(doc, np.arange(len(good) + 1)), pa.int32())
        keys = np.array(known.group_key, np.int64)[g]
        yield rows(
            len(good),
            id=b.column("id"),
            **{c: pa.array(sums[:, i]) for i, c in enumerate(("n_a", "n_b", "n_groups", "n_links"))},
            groups_sha256=pa.array(sha, pa.string()),
            keys=pa.ListArray.from_arrays(at, pa.array(keys)),
            times=pa.ListArray.from_arrays(at, pa.array(times, pa.int32())),
        )
    yield from counted()


def _expand(batches):
    """The links of each distinct group: distinct id pairs with how often each
    stands in the group."""
    names = ["key", "pair", "w", "n"]
    for b in batches:
        out: list[list] = [[], [], [], []]
        for key, ids, n in zip(*(b.column(c).to_pylist() for c in ("key", "ids", "n"))):
            a, z = ([int(x) for x in side.split(",")] for side in ids.split("|"))
            for x in dict.fromkeys(a):
                for y in dict.fromkeys(z):
                    for column, value in zip(out, (key, x << 32 | y, a.count(x) * z.count(y), n)):
                        column.append(value)
            if len(out[0]) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names)
                out = [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names)


def _sum_up(sent, batches):
    """Sums of the documents' groups among those sent; the others are left."""
    keys, sums, best = sent.value
    for b in batches:
        mine, times = b.column("keys"), b.column("times")
        doc = np.repeat(np.arange(b.num_rows), mine.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        k, t = mine.flatten().to_numpy(), times.flatten().to_numpy()
        at = np.minimum(np.searchsorted(keys, k), max(0, len(keys) - 1))
        found = keys[at] == k if len(keys) else np.zeros(len(k), bool)
        out = []
        for values in (sums, best):
            total = np.zeros(b.num_rows, np.int64)
            np.add.at(total, doc[found], values[at[found]] * t[found])
            out.append(pa.array(total))
        left = pa.array(np.searchsorted(doc[~found], np.arange(b.num_rows + 1)), pa.int32())
        lists = [pa.ListArray.from_arrays(left, pa.array(x[~found], kind)) for x, kind in ((k, pa.int64()), (t, pa.int32()))]
        rest = [c for c in b.schema.names if c not in ("keys", "times")]
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), *out, *lists], [*rest, "count_sum", "n_best", "keys", "times"])


#: Groups sent to all tasks: those in most documents, 24 bytes each.  Others meet
#: the documents that hold them in a join.
SENT_GROUPS = 300_000


def pair_table(groups: DataFrame, corrections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(links, pairs): of each distinct group (key, ids, n documents) its id pairs
    (key, pair, w, n), and of each pair the documents that hold it and whether
    that is the most of its A id."""
    links = materialise(spread(groups).mapInArrow(_expand, "key long, pair long, w long, n long"), "links")
    all_counts = links.select("pair", "n").unionByName(corrections.select("pair", (-F.col("n")).alias("n")))
    counts = materialise(all_counts.groupBy("pair").agg(F.sum("n").alias("docs")), "pairs")
    a = F.shiftright("pair", 32).alias("a")
    most = counts.groupBy(a).agg(F.max("docs").alias("most"))
    return links, counts.withColumn("a", a).join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def token_links(docs: DataFrame, a_path: str, b_path: str, sent: int = SENT_GROUPS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of
    every row; A is a byte-level .json tokenizer, B a sentencepiece .model.

    Null and empty texts, and those whose tokens don't spell a blank and the
    text again, have zeros and an empty digest.  Texts are encoded whole, units
    that repeat once; rows that repeat count as documents of their own; ids may
    be null; an empty table gives an empty result; other columns aren't looked
    at, so their names can't clash.
    """
    spark = docs.sparkSession
    tune(spark)
    id_type = docs.schema[id_col].dataType
    texts = spread(docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("t")))
    from pyspark.sql.pandas.types import to_arrow_type

    # Keys are 64-bit hashes.  Should two groups share one, others are drawn.
    for seed in range(8):
        cut = texts.mapInArrow(partial(_cut, a_path, b_path, seed, to_arrow_type(id_type)), f"id {id_type.simpleString()}, {_FACTS}")
        stored = materialise(cut.withColumn("row", F.monotonically_increasing_id()), "cut")
        named = stored.filter("ids is not null").groupBy("key", "ids").agg(F.sum("n").alias("n"))
        groups = materialise(named, "groups")
        if groups.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").isEmpty():
            break
    else:
        raise RuntimeError("group keys collide under every seed")

    links, pairs = pair_table(groups, stored.filter("pair is not null"))
    sums = links.join(materialise(pairs, "best"), "pair").groupBy("key").agg(
        F.sum(F.col("w") * F.col("docs")).alias("count_sum"), F.sum(F.when(F.col("best"), F.col("w")).otherwise(0)).alias("n_best"), F.max("n").alias("n")
    )
    sums = materialise(sums, "group-sums")
    total = sums.count()
    head = sums if total <= sent else sums.filter(F.col("n") >= _least_documents(sums, sent))
    arrays = head.select("key", "count_sum", "n_best").toArrow().sort_by("key")
    values = spark.sparkContext.broadcast(tuple(c.to_numpy() for c in arrays.columns))

    facts = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    rows = stored.filter("keys is not null").select("row", *facts, "keys", "times")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select("row", *facts).schema)
    summed = rows.mapInArrow(partial(_sum_up, values), f"{kinds}, count_sum long, n_best long, keys array<long>, times array<int>")
    if total > sent:
        summed = materialise(summed, "summed")
        left = summed.select("row", F.explode(F.arrays_zip("keys", "times")).alias("x")).select("row", F.col("x.keys").alias("key"), F.col("x.times").alias("t"))
        more = left.join(sums.select("key", F.col("count_sum").alias("c"), F.col("n_best").alias("b")), "key")
        more = more.groupBy("row").agg(F.sum(F.col("t") * F.col("c")).alias("c"), F.sum(F.col("t") * F.col("b")).alias("b"))
        summed = summed.join(more, "row", "left")
        for name, value in (("count_sum", "c"), ("n_best", "b")):
            summed = summed.withColumn(name, F.col(name) + F.coalesce(F.col(value), F.lit(0)))
    return summed.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def _least_documents(sums: DataFrame, sent: int) -> int:
    """The least document number such that at most ``sent`` groups have it or
    more, by a histogram of a few hundred steps."""
    step = F.floor(F.log2("n") * 8)
    counts = sums.groupBy(step.alias("step")).agg(F.count("*").alias("c"), F.min("n").alias("n")).collect()
    least, seen = 1 << 62, 0
    for r in sorted(counts, key=lambda r: -r.step):
        seen += r.c
        if seen > sent:
            break
        least = r.n
    return least
