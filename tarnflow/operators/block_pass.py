"""A whole annotation of each block in one pass over rows that are dealt by block.

The results are those of the operators in ``annotation`` one after another, without a
shuffle between them.  Descriptions, terms and lineages are numbers here; what is
known of each lies in a ``Lexicon``, which every worker holds, so there must be few
different ones, however many rows have them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tarnflow.functions import scores as S
from tarnflow.functions.lineage import distance_table
from tarnflow.functions.text import UNINFORMATIVE
from tarnflow.params import Params

from . import clustering as C

PREDICTORS = ("rm3", "share", "jac", "hyge")


class Lists:
    """Lists of numbers by number, in one array."""

    def __init__(self, lists: list[list[int]]):
        self.n = np.array([len(x) for x in lists], np.int64)
        self.start = np.cumsum(self.n) - self.n
        self.flat = np.array([v for x in lists for v in x], np.int64)

    def of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in keys, member) of all members of the lists of ``keys``."""
        n = self.n[keys]
        at = np.repeat(np.arange(len(keys)), n)
        return at, self.flat[self.start[keys[at]] + np.arange(len(at)) - (np.cumsum(n) - n)[at]]


def ranks(texts: list[str | None]) -> np.ndarray:
    """Places in the order of UTF-8, equal for equal texts, none first."""
    order = {x: i for i, x in enumerate(sorted(set(texts), key=lambda x: (x is not None, (x or "").encode())))}
    return np.array([order[x] for x in texts], np.int64)


@dataclass
class Lexicon:
    """kinds: desc, plain, ff, ff_text, words, gene (or None), known, terms (numbers of
    goids); the last kind is that of hits without a description.  lineages: the first
    is unclassified.  background: goid's number, ontology, count and root.  rows: of
    each background entry (type's beginning, id, description)."""

    kinds: list[tuple]
    lineages: list[str]
    goids: list[str]
    background: list[tuple[int, str | None, int, int]]
    counts: dict[str, int]
    all_descriptions: float
    rows: list[list[tuple[str, str, str]]] = field(default_factory=list)
    ups: dict[str, list[str]] = field(default_factory=dict)
    queries: list[tuple[str, str, str]] = field(default_factory=list)

    def __post_init__(self):
        desc, plain, ff, ff_text, words, gene, known, terms = zip(*self.kinds)
        self.desc, self.ff_text, self.gene = pa.array(desc, pa.string()), pa.array(ff_text, pa.string()), pa.array(sorted({g for g in gene if g is not None}), pa.string())
        self.ff, self.desc_rank, self.plain_rank = np.array(ff, float), ranks(list(desc)), ranks(list(plain))
        self.known = np.ones(len(set(plain)))
        self.known[self.plain_rank] = known
        genes = {g: i for i, g in enumerate(self.gene.to_pylist())}
        self.gene_of = np.array([-1 if g is None else genes[g] for g in gene], np.int64)
        names = sorted({w for x in words for w in x})
        number = {w: i for i, w in enumerate(names)}
        self.informative = Lists([[number[w] for w in x if w not in UNINFORMATIVE] for x in words])
        self.cnt = np.array([self.counts.get(w, 1) for w in names], float)
        total = float(sum(self.counts.values()))
        idf = np.log(total / np.maximum(self.cnt, 1)) if total else np.zeros(len(names))
        different = [list(dict.fromkeys(x)) for x in words]
        self.vectors = pa.array(different, pa.list_(pa.string())), pa.array([[idf[number[w]] for w in x] for x in different], pa.list_(pa.float64()))
        self.terms, self.has_terms = Lists([[g for g in x if g is not None] for x in terms]), np.array([len(x) > 0 for x in terms])
        self.entries = Lists(_grouped([b[0] for b in self.background], len(self.goids)))
        self.goid_rank, self.goid = ranks(self.goids), pa.array(self.goids, pa.string())
        ontologies = sorted({b[1] for b in self.background}, key=str)
        self.ontologies = pa.array(ontologies, pa.string())
        self.ontology = np.array([ontologies.index(b[1]) for b in self.background], np.int64)
        self.b, self.root = np.array([max(b[2], 1) for b in self.background], np.int64), np.array([b[3] for b in self.background], np.int64)
        self.row_lists = Lists(_grouped([i for i, x in enumerate(self.rows) for _ in x], len(self.background)))
        flat = [r for x in self.rows for r in x]
        self.row_types = {k: pa.array([r[0] + k.upper() for r in flat], pa.string()) for k in PREDICTORS}
        self.row_ids, self.row_descs = pa.array([r[1] for r in flat], pa.string()), pa.array([r[2] for r in flat], pa.string())
        index = {g: i for i, g in enumerate(self.goids)}
        # Ancestors that no hit has need no number.
        self.inner = np.array([g in self.ups for g in self.goids], bool)
        self.up = [frozenset(index[u] for u in self.ups.get(g, ()) if u in index) for g in self.goids]
        self.eukaryote = np.array(["Eukaryota" in x for x in self.lineages], bool)
        self.distances, self.table, self.labels, self.taken = {}, distance_table(), {}, {}

    def distance(self, first: int, other: int) -> float:
        if (first, other) not in self.distances:
            if first < 0:
                path = 69
            else:
                a, b = self.lineages[first].split("; "), self.lineages[other].split("; ")
                common = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
                path = len(a) + len(b) - 2 * common
            self.distances[first, other] = self.table[path] if path < len(self.table) else 0.0
        return self.distances[first, other]


def _grouped(keys: list[int], n: int) -> list[list[int]]:
    out: list[list[int]] = [[] for _ in range(n)]
    for i, k in enumerate(keys):
        out[k].append(i)
    return out


def _firsts(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by keys (the last is the first) and places within its runs, from 1."""
    order = np.lexsort(keys)
    top = keys[-1][order]
    new = np.append(True, top[1:] != top[:-1])[: len(top)]
    start = np.flatnonzero(new)
    return order, np.arange(len(top)) - np.repeat(start, np.diff(np.append(start, len(top)))) + 1


def _moments(group: np.ndarray, x: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Count, mean and population variance; equal values have exactly their mean and 0."""
    n = np.bincount(group, minlength=groups)
    base = np.zeros(groups)
    base[group[::-1]] = x[::-1]
    size = np.maximum(n, 1)
    mean = base + np.bincount(group, x - base[group], groups) / size
    return n, mean, np.bincount(group, (x - mean[group]) ** 2, groups) / size


def gsz(sample, score, mean, variance, size, total) -> np.ndarray:
    """scores.gsz of arrays."""
    sample, n = sample.astype(float), np.maximum(size, 10).astype(float)
    e = n * sample / total
    v = e * (1 - n / total) * (total - sample) / (total - 1)
    spread = variance * (e * (sample - e) - v) / (sample - 1) + mean * mean * v
    z = (score - mean * e) / np.sqrt(spread)
    z = np.where(np.isnan(z) | (spread == 0), 0.0, z)
    return np.where(size < 2, 0.0, np.where(sample > 1, z, e * v))


def _logmod(x):
    return np.where(x > 1, 1 + np.log(np.where(x > 1, x, 1)), np.where(x < -1, -1 - np.log(np.where(x < -1, -x, 1)), x))


def _description_ppv(x, eukaryote):
    euk = np.where(x < 0.705, np.maximum(0, -1.253 + 2.295 * x), np.where(x < 3.05855, np.minimum(1, -0.05199 + 0.66827 * x - 0.10945 * x * x), 0.9680758))
    return np.where(eukaryote, euk, np.where(x < 1.322, np.maximum(0, -0.5057 + 1.4713 * x - 0.3757 * x * x), np.minimum(1, 0.77258 - 0.01382 * x + 0.01632 * x * x)))


def _ppv(k: str, x: np.ndarray) -> np.ndarray:
    if k == "rm3":
        return np.where(x < 0.466, 0.1205 + 1.6223 * x, np.minimum(1, -0.5582 + 5.6307 * x - 5.4758 * x * x))
    if k == "share":
        z = np.sqrt(np.maximum(x, 0))
        return np.where(x < 0, 0.0, np.where(z < 3.709538, 0.3047 + 0.1452 * z, np.minimum(1, 0.67302 + 0.04591 * z)))
    if k == "jac":
        z = np.log(np.where(x > 0, x, 1))
        return np.where(x <= 0, 0.0, np.where(z >= -3.527961, np.minimum(1, 0.89756 + 0.01835 * z), np.maximum(0, 0.97768 + 0.04106 * z)))
    return np.minimum(1, 0.32608 + 0.05392 * np.log(np.maximum(x, 1)))


def _limited(cache: dict, most: int = 200_000) -> dict:
    if len(cache) > most:
        cache.clear()
    return cache


class Blocks:
    """Rows of whole blocks, by block and subject; arrays are by row, block (b),
    cluster or term."""

    def __init__(self, t: pa.Table, starts: np.ndarray, x: Lexicon, p: Params):
        column = lambda c: t.column(c).to_numpy()
        own = column("own")
        self.x, self.p, self.names = x, p, t.column("qpid").take(pa.array(starts))
        of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, t.num_rows)))
        self.blocks = len(starts)
        # The query's own row: the least of them.
        self.query = np.full(self.blocks, len(x.queries) - 1 if x.queries else 0, np.int64)
        if own.any():
            np.minimum.at(self.query, of[own], column("kind")[own])
        hit = ~own
        self.b, self.kind, self.lineage, self.ok = of[hit], column("kind")[hit].astype(np.int64), column("lineage")[hit].astype(np.int64), column("ok")[hit]
        self.kind[self.kind < 0] = len(x.kinds) - 1
        self.no_bits = t.column("bits").is_null().to_numpy()[hit]
        self.bits = np.where(self.no_bits, 0.0, column("bits")[hit])
        self.n = np.bincount(self.b, minlength=self.blocks)
        self.start = np.cumsum(self.n) - self.n
        qcov, scov, pide = (column(c)[hit].astype(float) for c in ("qcov", "scov", "pide"))
        place = np.arange(len(self.b))
        best = np.where(np.isnan(self.bits), np.inf, self.bits)
        order = np.lexsort((place, -best, self.no_bits, self.b))
        run = np.cumsum(self.ok[order])
        before = np.append(0, run)[self.start]
        self.status = np.empty(len(order), bool)
        self.status[order] = self.ok[order] & (run - before[self.b[order]] <= p.max_hits)
        known = order[self.lineage[order] > 0]
        self.first = np.full(self.blocks, -1, np.int64)
        self.first[self.b[known][::-1]] = self.lineage[known][::-1]
        pairs, inverse = np.unique((self.first[self.b] + 1) * len(x.lineages) + self.lineage, return_inverse=True)
        far = np.array([x.distance(int(k // len(x.lineages)) - 1, int(k % len(x.lineages))) for k in pairs], float)[inverse] if len(pairs) else np.zeros(0)
        self.rm1 = np.where(self.status, 0.21 * np.log10(100 * qcov) + 0.26 * scov * pide + 0.40 * pide * far, 0.0)

    def clusters(self, whole: bool) -> None:
        """All of a block's clusters that are described, by block and rank; with
        ``whole`` without those that are all of their background or have no score."""
        x, p = self.x, self.p
        ok = self.status & (x.ff[self.kind] >= p.form_factor)
        rows = np.flatnonzero(ok)
        at, word = x.informative.of(self.kind[rows])
        row = rows[at]
        each, inverse = np.unique(self.b[row] * max(1, len(x.cnt)) + word, return_inverse=True)
        of, word = each // max(1, len(x.cnt)), each % max(1, len(x.cnt))
        total = 1.0 + np.bincount(self.b[row], self.bits[row], self.blocks)
        v = np.bincount(inverse, self.bits[row], len(each)) / total[of]
        vj = v * np.bincount(inverse, minlength=len(each)) / np.maximum(x.cnt[word], p.least_word_count) if len(each) else v
        # Words without any bits are no words of a mean.
        some = (np.bincount(inverse, ~self.no_bits[row], len(each)) > 0)[inverse]
        n = np.maximum(np.bincount(row[some], minlength=len(self.b)), 1)
        value, jaccard = (np.bincount(row[some], y[inverse][some], len(self.b)) / n for y in (v, vj))
        self.label = self._labels()
        key, inverse = np.unique((self.start[self.b] + self.label)[rows], return_inverse=True)
        size = np.bincount(inverse, minlength=len(key))
        mean = lambda y: np.bincount(inverse, y[rows], len(key)) / np.maximum(size, 1)
        of = np.zeros(len(key), np.int64)
        of[inverse] = self.b[rows]
        kind = self.kind[rows]
        order = np.lexsort((x.desc_rank[kind], self.bits[rows], ~self.no_bits[rows], x.ff[kind], inverse))
        best = np.zeros(len(key), np.int64)
        best[inverse[order]] = kind[order]
        plains = np.unique(inverse * len(x.known) + x.plain_rank[kind])
        cnt = np.bincount(plains // len(x.known), x.known[plains % len(x.known)], len(key))
        n, m, var = _moments(self.b[rows], self.rm1[rows], self.blocks)
        sums = np.bincount(inverse, self.rm1[rows], len(key))
        z = gsz(n[of], sums, m[of], var[of], cnt, x.all_descriptions)
        val, jac = mean(value), mean(jaccard)
        rm2 = 0.59 + 0.53 * _logmod(val) + 0.02 * jac + 0.0004 * z
        keep = np.flatnonzero((size != cnt) & (sums != 0)) if whole else np.arange(len(key))
        order, place = _firsts(key[keep], x.plain_rank[best[keep]], -rm2[keep], of[keep])
        at = keep[order]
        self.c = {"b": of[at], "rank": place, "label": (key - self.start[of])[at], "kind": best[at], "size": size[at], "rm1sum": sums[at], "val": val[at], "jac": jac[at], "gsz": z[at], "rm2": rm2[at]}
        self.described = ok

    def _labels(self) -> np.ndarray:
        """Clusters of each block's hits; blocks of the same descriptions are the same."""
        x, out, cache = self.x, np.zeros(len(self.b), np.int64), _limited(self.x.labels)
        for n in np.unique(self.n[self.n > 1]).tolist():
            at = self.start[self.n == n][:, None] + np.arange(n)
            different, inverse = np.unique(x.desc_rank[self.kind[at]], axis=0, return_inverse=True)
            keys = [r.tobytes() for r in different]
            new = [i for i, k in enumerate(keys) if k not in cache]
            if new:
                one = np.zeros(x.desc_rank.max() + 1, np.int64)
                one[x.desc_rank] = np.arange(len(x.desc_rank))
                kinds = pa.array(one[different[new]].ravel())
                found = C._labels(np.arange(len(new)) * n, x.vectors[0].take(kinds), x.vectors[1].take(kinds), self.p.cluster_cut).reshape(-1, n)
                cache.update({keys[i]: r for i, r in zip(new, found)})
            out[at] = np.stack([cache[k] for k in keys])[inverse.ravel()]
        return out

    def only_best_cluster(self) -> None:
        best = np.full(self.blocks, -1, np.int64)
        top = (self.c["rank"] == 1) & (self.c["rm2"] > 0)
        best[self.c["b"][top]] = self.c["label"][top]
        self.status = self.label == best[self.b]

    def term_scores(self) -> None:
        x = self.x
        rows = np.flatnonzero(self.status & x.has_terms[self.kind])
        n, m, var = _moments(self.b[rows], self.rm1[rows], self.blocks)
        total = 1.0 + np.bincount(self.b[rows], self.bits[rows], self.blocks)
        at, goid = x.terms.of(self.kind[rows])
        row = rows[at]
        each, inverse = np.unique(self.b[row] * len(x.goids) + goid, return_inverse=True)
        k, score, bits = np.bincount(inverse, minlength=len(each)), np.bincount(inverse, self.rm1[row], len(each)), np.bincount(inverse, self.bits[row], len(each))
        none = np.bincount(inverse, ~self.no_bits[row], len(each)) == 0
        at, entry = x.entries.of(each % len(x.goids))
        keep = x.b[entry] != x.root[entry]
        at, entry = at[keep], entry[keep]
        of, goid, k, score, bits, b, root = (each // len(x.goids))[at], (each % len(x.goids))[at], k[at], score[at], bits[at], x.b[entry], x.root[entry]
        n, total = n[of], total[of]
        z = gsz(n, score, m[of], var[of], b, root.astype(float))
        jsc = k / (b + n - k)
        g = {"b": of, "entry": entry, "goid": goid, "k": k, "score": score, "bits": bits, "n": n, "gsz": z}
        rm3 = np.maximum(0.0, 0.36 + 0.01 * np.log(np.where(jsc > 0, jsc, 1)) + 0.02 * _logmod(z) - 3.67e-5 * np.sqrt(b) - 0.007 * np.sqrt(n))
        g["rm3_score"], g["share_score"], g["jac_score"] = np.where(jsc > 0, rm3, 0.0), bits / total * np.log2(root / b), bits / total * jsc
        g["bg_score"], g["voted_score"] = b / root, np.minimum(k / n, 0.99)
        tails, inverse = np.unique(np.stack([k, root, n, b], axis=1), axis=0, return_inverse=True)
        g["hyge_score"] = -np.log(np.maximum(np.array([S._tail(*r) for r in tails.tolist()], float), 1e-300))[inverse.ravel()]
        for name in PREDICTORS:
            g[f"{name}_ppv"] = _ppv(name, g[f"{name}_score"])
        # Without any bits there is no share, which the curve's bound makes 1.
        self.no_share = none[at]
        g["share_ppv"] = np.where(self.no_share, 1.0, g["share_ppv"])
        g["voted_ppv"], g["bg_ppv"] = g["voted_score"], g["bg_score"]
        self.g = g

    def ranked(self, names: tuple[str, ...]) -> None:
        """Places within block and ontology."""
        g, x = self.g, self.x
        run = g["b"] * len(x.ontologies) + x.ontology[g["entry"]]
        for name in names:
            order, place = _firsts(x.goid_rank[g["goid"]], -g[f"{name}_ppv"], run)
            g[f"{name}_rank"] = np.empty(len(order), np.int64)
            g[f"{name}_rank"][order] = place

    def chosen(self, name: str) -> np.ndarray:
        """Terms that aren't redundant by a predictor's ranks."""
        g, x = self.g, self.x
        run = g["b"] * len(x.ontologies) + x.ontology[g["entry"]]
        inner = np.flatnonzero(x.inner[g["goid"]])
        order = inner[np.lexsort((g[f"{name}_rank"][inner], run[inner]))]
        goid, cut = g["goid"][order].astype(np.int32), np.flatnonzero(np.append(True, np.diff(run[order]) != 0)[: len(order)])
        cache, found, raw = _limited(x.taken), [], goid.tobytes()
        for a, z in zip((4 * cut).tolist(), (4 * np.append(cut[1:], len(order))).tolist()):
            key = raw[a:z]
            if key not in cache:
                taken, above = set(), set()
                for t in np.frombuffer(key, np.int32).tolist():
                    if t not in above and taken.isdisjoint(x.up[t]):
                        taken.add(t)
                        above |= x.up[t]
                cache[key] = np.array([t in taken for t in np.frombuffer(key, np.int32).tolist()], bool)
            found.append(cache[key])
        good = np.zeros(len(goid), bool) if not found else np.concatenate(found)
        # A term that is chosen in one ontology is chosen for its block.
        of = g["b"] * len(x.goids) + g["goid"]
        return np.isin(of, of[order[good]])

    # What the queries show.

    def describe(self):
        c = {k: v[self.c["rank"] == 1] for k, v in self.c.items()}
        yield [self.names.take(pa.array(c["b"])), self.x.desc.take(pa.array(c["kind"])), pa.array(c["size"]), *[pa.array(c[k]) for k in ("rm1sum", "val", "jac", "gsz", "rm2")]]

    def predict(self):
        g, x = self.g, self.x
        plain = [pa.array(v, mask=self.no_share if k in ("bits", "share_score", "jac_score") else None) for k, v in g.items() if k not in ("b", "entry", "goid")]
        entry = g["entry"]
        yield [self.names.take(pa.array(g["b"])), x.goid.take(pa.array(g["goid"])), x.ontologies.take(pa.array(x.ontology[entry])), pa.array(x.b[entry]), pa.array(x.root[entry]), *plain]

    def _terms(self, name: str, keep: np.ndarray):
        g, x = self.g, self.x
        at = np.flatnonzero(keep & (g[f"{name}_score"] > 0))
        some, row = x.row_lists.of(g["entry"][at])
        at, row = at[some], pa.array(row)
        return self.names.take(pa.array(g["b"][at])), x.row_types[name].take(row), pa.array(g[f"{name}_score"][at]), pa.array(g[f"{name}_ppv"][at]), x.row_ids.take(row), x.row_descs.take(row)

    def full(self):
        c = {k: v[self.c["rank"] == 1] for k, v in self.c.items()}
        yield [self.names.take(pa.array(c["b"])), _same("DE", c["b"]), pa.array(c["rm2"]), pa.array(_description_ppv(c["rm2"], False)), self.x.desc.take(pa.array(c["kind"]))]
        for name in PREDICTORS:
            yield list(self._terms(name, np.ones(len(self.g["b"]), bool))[:5])

    def annotate(self):
        x, c = self.x, self.c
        euk = np.where(self.first < 0, False, x.eukaryote[self.first])
        at = np.flatnonzero(self.n > 0)
        none = lambda kind, a: pa.nulls(len(a), kind)
        queries = [pa.array([q[i] for q in x.queries], pa.string()).take(pa.array(self.query[at])) for i in range(3)]
        names = self.names.take(pa.array(at))
        yield [names, _same("original_DE", at), none(pa.float64(), at), none(pa.float64(), at), queries[2], queries[0], pa.array(euk[at])]
        yield [names, _same("qseq", at), none(pa.float64(), at), none(pa.float64(), at), none(pa.string(), at), queries[1], none(pa.bool_(), at)]
        c = {k: v[c["rank"] == 1] for k, v in c.items()} if self.p.best_cluster_only else c
        names, kind = self.names.take(pa.array(c["b"])), pa.array(c["kind"])
        yield [names, _same("DE", c["b"]), pa.array(c["rm2"]), pa.array(_description_ppv(c["rm2"], euk[c["b"]])), x.ff_text.take(kind), x.desc.take(kind), none(pa.bool_(), c["b"])]
        gene = self._genes()[c["b"]]
        has = np.flatnonzero(gene >= 0)
        yield [names.take(pa.array(has)), _same("GN", has), none(pa.float64(), has), none(pa.float64(), has), none(pa.string(), has), x.gene.take(pa.array(gene[has])), none(pa.bool_(), has)]
        for name in self.p.predictors:
            found = self._terms(name, self.chosen(name))
            yield [*found, none(pa.bool_(), found[0])]

    def _genes(self) -> np.ndarray:
        """The commonest gene name of each block's described hits, if it has more than
        half of one plus all names; else -1.  Before the best cluster is chosen."""
        rows = np.flatnonzero(self.described & (self.x.gene_of[self.kind] >= 0))
        size = max(1, len(self.x.gene))
        each, votes = np.unique(self.b[rows] * size + self.x.gene_of[self.kind[rows]], return_counts=True)
        total = np.bincount(self.b[rows], minlength=self.blocks)
        good = votes > 0.5 * (1 + total[each // size])
        out = np.full(self.blocks, -1, np.int64)
        out[each[good] // size] = each[good] % size
        return out


def _same(text: str, like) -> pa.Array:
    return pa.DictionaryArray.from_arrays(np.zeros(len(like), np.int32), pa.array([text])).dictionary_decode()


def annotated(batches, lexicon: Lexicon, p: Params, what: str, names: list[str]):
    """Arrow batches of a query (describe, predict, full, annotate) from batches sorted
    by block."""

    def run(t: pa.Table, starts: np.ndarray):
        with np.errstate(all="ignore"):
            x = Blocks(t, starts, lexicon, p)
            if what != "predict":
                x.clusters(what == "annotate")
            if what == "annotate":
                x.only_best_cluster()
            if what != "describe":
                x.term_scores()
            if what in ("predict", "annotate"):
                x.ranked((*PREDICTORS, "voted", "bg") if what == "predict" else p.predictors)
            for columns in getattr(x, what)():
                yield from pa.Table.from_arrays(columns, names).to_batches(max_chunksize=10_000)

    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        names_of = b.column(0)
        new = 1 + np.flatnonzero(pc.not_equal(names_of.slice(1), names_of.slice(0, len(names_of) - 1)).to_numpy(zero_copy_only=False))
        if held and held[-1].column(0)[-1] != names_of[0]:
            new = np.append(0, new)
        # The last block may go on in the next batch.
        if len(new):
            if held or new[-1]:
                yield from _whole([*held, b.slice(0, new[-1])], run)
            held = []
            b = b.slice(new[-1])
        held.append(b)
    if held:
        yield from _whole(held, run)


def _whole(batches: list[pa.RecordBatch], run):
    t = pa.Table.from_batches(batches).combine_chunks()
    key = t.column("qpid").combine_chunks()
    starts = np.append(0, 1 + np.flatnonzero(pc.not_equal(key.slice(1), key.slice(0, len(key) - 1)).to_numpy(zero_copy_only=False)))
    return run(t, starts)
