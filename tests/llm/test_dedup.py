"""Line dedup, near-duplicates and decontamination against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from tarnflow.llm import decontam, line_dedup, near_dup

from .conftest import ODD

RULE = line_dedup.LineRule(ratio=0.3, min_pages=4, min_line_pages=3, keep_copies=True)


def cut(frame, rows, rule=RULE):
    from pyspark.sql import functions as F

    got = line_dedup.drop_boilerplate(frame(rows), F.col("source"), rule)
    return sorted((r.doc_id, r.text, r.n_dropped) for r in got.collect())


def test_boilerplate_goes_by_site(frame):
    rows = [(i, f"Menu \nbody {i}\n\nfoot", "a") for i in range(4)] + [(9, "Menu\nbody", "b"), (10, None, "a"), (11, "Menu\nx", None)]
    got = {i: (t, n) for i, t, n in cut(frame, rows)}
    assert got[0] == ("body 0\n", 2) and got[9] == ("Menu\nbody", 0) and got[10] == (None, 0) and got[11] == ("Menu\nx", 0)


def test_copied_pages_stay_whole(frame):
    rows = [(i, "copied\npage", "a") for i in range(4)] + [(8, "copied\nown", "a")]
    got = {i: (t, n) for i, t, n in cut(frame, rows)}
    assert got[0] == ("copied\npage", 0) and got[8] == ("own", 1)


def test_line_dedup_odd_rows(frame, monkeypatch):
    assert len(cut(frame, ODD)) == len(ODD)
    assert cut(frame, []) == []
    rows = [(i, f"Menu\nbody {i}", "a") for i in range(5)]
    plain = cut(frame, rows)
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", -1)  # the salted join
    assert cut(frame, rows) == plain


def test_added_columns_have_names_of_their_own(frame):
    from pyspark.sql import functions as F

    docs = frame([(i, f"Menu\nbody {i}", "a") for i in range(5)]).withColumn("n_dropped", F.lit("mine")).withColumnsRenamed({"host": "__host", "key": "lines", "row": "salt"})
    got = line_dedup.drop_boilerplate(docs, F.col("source"), RULE, count_col="dropped").collect()
    assert {(r.n_dropped, r.dropped, r["__host"], r.lines, r.salt, r.bad) for r in got} == {("mine", 1, "x", 1, 1, "x")}
    assert {r.n_dropped for r in line_dedup.drop_boilerplate(docs, F.col("source"), RULE).collect()} == {1}


def test_url_host(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("http://www.A.com/x?y",), ("https://u@b.org:80",), ("nothing",), (None,)], "u string")
    assert [r[0] for r in df.select(line_dedup.url_host(F.col("u"))).collect()] == ["a.com", "b.org", None, None]


def shingles(text, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)}


def brute_classes(rows, n, percent=80):
    sets = {i: shingles(t, n) for i, t, _ in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("n", [2, 5])
def test_near_classes_equal_brute_force(frame, n):
    rng = random.Random(n)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(25):
        base = rng.choices(vocabulary, k=rng.randint(1, 120))
        for _ in range(rng.randint(1, 8)):
            copy = list(base)
            for _ in range(rng.randint(0, 5)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows) * 3, " ".join(copy), "s"))
    rows += [(900, None, "s"), (901, "", "s"), (902, " \n", "s"), (903, "W1", "s"), (904, "w1", "s")]
    rng.shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_classes(frame(rows), near_dup.NearRule(shingle=n)).collect()}
    assert got == brute_classes(rows, n)


def test_chain_of_links_is_one_component(frame):
    words = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(words[:100] if not i else words[5 * i :] + [f"x{k}" for k in range(5 * i)]), "s") for i in range(8)]
    got = {r.doc_id: r.component_id for r in near_dup.near_classes(frame(rows)).collect()}
    assert got == {i: c for i, (_, c) in brute_classes(rows, 5).items()}
    assert len(set(got.values())) < 8


def test_late_rounds_lose_no_link(frame, monkeypatch):
    """A bucket whose pivots link with nothing else in it."""
    monkeypatch.setattr(near_dup.NearRule, "most_odd", property(lambda s: s.bits))
    base = [f"w{i}" for i in range(60)]
    far = [" ".join(base[:30] + [f"y{k}{i}" for i in range(30)]) for k in range(3)]
    near = [" ".join(base[:50] + [f"z{i}" for i in range(10)]), " ".join(base[:50] + [f"z{i}" for i in range(9)] + ["q"])]
    rows = [(i, t, "s") for i, t in enumerate(far + near)]
    got = {r.doc_id: r.component_id for r in near_dup.near_classes(frame(rows), near_dup.NearRule(shingle=2, bands=60, rows=1)).collect()}
    assert got == {i: c for i, (_, c) in brute_classes(rows, 2).items()}


def test_copies_of_one_text_make_few_pairs(frame, monkeypatch):
    """All copies link with their origin, which comes last, and hardly any two
    with each other: what the pivots leave isn't the square of the group."""
    counts = []
    links = near_dup._links
    monkeypatch.setattr(near_dup, "_links", lambda pairs, *rest: counts.append(pairs.count()) or links(pairs, *rest))
    rng = random.Random(1)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        copy = list(base)
        for k in rng.sample(range(120), 6):
            copy[k] = f"x{i}_{k}"
        rows.append((i, " ".join(copy), "s"))
    rows.append((60, " ".join(base), "s"))
    got = {r.doc_id: r.component_id for r in near_dup.near_classes(frame(rows), near_dup.NearRule(shingle=2)).collect()}
    assert got == {i: c for i, (_, c) in brute_classes(rows, 2).items()} and len(set(got.values())) == 1
    assert sum(counts) < 200


def test_pairs_meet_in_one_bucket(frame, spark, monkeypatch):
    """Two texts that share most bands, neither a pivot's partner, leave the join once."""
    rule = near_dup.NearRule(shingle=2)
    hasher = near_dup._Hasher(rule)
    made = []
    for node, last in ((1, "x"), (2, "y")):
        s = near_dup.shingle_set([f"w{i}".encode() for i in range(100)] + [last.encode()], 2)
        least = hasher.minimums(s)
        made.append((node, len(s), *([int(v) for v in a] for a in (hasher.keys(least), hasher.sketch(least), hasher.whole(s)))))
    reps = spark.createDataFrame(made, "node long, n_shingles long, bands array<long>, sketch array<long>, whole array<long>")
    shared = [(i, k) for i, k in enumerate(made[0][2]) if k == made[1][2][i]]
    assert len(shared) > 10
    rest = spark.createDataFrame([(k, i, n, n) for i, k in shared for n in (1, 2)], "key long, band int, node long, component long")
    monkeypatch.setattr(type(rest), "distinct", lambda df: df)
    assert [tuple(r) for r in near_dup._crossed(rest, reps, rule).collect()] == [(1, 2)]


def test_texts_of_one_id_are_one_document(frame):
    """Id 1 has two different texts, 2 is near the first, 3 near the second."""
    rng = random.Random(3)
    x, y = ([f"{c}{rng.randrange(1000)}" for _ in range(120)] for c in "xy")
    near = lambda w: [*w[:118], "other", "end"]
    rows = [(1, " ".join(x), "s"), (1, " ".join(y), "s"), (2, " ".join(near(x)), "s"), (3, " ".join(near(y)), "s"), (1, "", "s"), (4, "alone", "s")]
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near_dup.near_classes(frame(rows)).collect())
    assert got == [(1, 1, True)] * 3 + [(2, 1, False), (3, 1, False), (4, 4, True)]
    # By texts alone, both texts of id 1 stay.
    left = sorted((r.doc_id, r.text) for r in near_dup.one_of_each(frame(rows)).collect())
    assert left == sorted([(1, " ".join(x)), (1, " ".join(y)), (1, ""), (4, "alone")])


def test_one_of_each_group_stays(frame):
    """Ids that are missing or repeat, and rows that repeat."""
    text = [" ".join(f"{c}{i}" for i in range(60)) for c in "abcd"]
    rows = [(None, text[0], "s")] * 3 + [(5, text[0] + " x", "s"), (5, text[0] + " x", "s"), (6, text[0], "s")]
    rows += [(None, text[1], "s"), (None, text[1] + " y", "s"), (7, text[2], "s"), (7, text[2], "s"), (8, text[3], "s"), (None, None, "s"), (None, "", "s"), (9, " ", "s")]
    got = near_dup.one_of_each(frame(rows)).collect()
    assert sorted(str(r.doc_id) for r in got) == ["5", "7", "8", "9", "None", "None", "None"]
    assert sum(r.doc_id is None and bool(r.text) for r in got) == 1 and {r.bad for r in got} == {"x"}
    assert near_dup.one_of_each(frame([])).count() == 0


@pytest.mark.parametrize("keys, part, cell", [(0, 1, 1_000), (1_000_000, 2_000_000, 1)])
def test_large_tables_ways_find_the_same(frame, monkeypatch, keys, part, cell):
    """Texts dealt out by key, pivots' sets in many copies, buckets in cells."""
    for name, value in (("BROADCAST_KEYS", keys), ("PART_SHINGLES", part), ("CELL", cell)):
        monkeypatch.setattr(near_dup, name, value)
    monkeypatch.setattr(near_dup.NearRule, "most_odd", property(lambda s: s.bits))
    base = [f"w{i}" for i in range(60)]
    far = [" ".join(base[:30] + [f"y{k}{i}" for i in range(30)]) for k in range(4)]
    near = [" ".join(base[:50] + [f"z{i}" for i in range(10 - k)] + [f"q{k}{i}" for i in range(k)]) for k in range(4)]
    rows = [(i, t, "s") for i, t in enumerate(far + near + near[:2])]
    got = {r.doc_id: r.component_id for r in near_dup.near_classes(frame(rows), near_dup.NearRule(shingle=2, bands=60, rows=1)).collect()}
    assert got == {i: c for i, (_, c) in brute_classes(rows, 2).items()}


def test_components_equal_label_passing(spark):
    """Hubs with least and with greatest numbers, a path, random edges, edges
    both ways and one from a node to itself, which links it with nothing."""
    rng = random.Random(5)
    edges = [(0, i) for i in range(1, 60)] + [(i, 99) for i in range(61, 80)] + [(100 + i, 101 + i) for i in range(7)]
    edges += [(z, a) for a, z in edges[:3]] + [tuple(rng.sample(range(200, 260), 2)) for _ in range(40)]
    top = {n: n for e in edges for n in e}
    for _ in top:
        for a, z in edges:
            top[a] = top[z] = min(top[a], top[z])
    got = near_dup.components(spark.createDataFrame([*edges, (300, 300)], "a long, z long")).collect()
    assert len(got) == len(top) and {r.node: r.component for r in got} == top


def test_recall_near_the_threshold(frame):
    """Pairs whose similarity is just 0.8 or a little more, each alone."""
    rng = random.Random(9)
    rows = []
    for k in range(150):
        words = [f"{k}w{i}" for i in range(rng.randint(60, 200))]
        other = list(words)
        for i in rng.sample(range(0, len(words) - 5, 11), max(1, len(words) // 110)):
            other[i] = f"{k}changed{i}"
        rows += [(2 * k, " ".join(words), "s"), (2 * k + 1, " ".join(other), "s")]
    linked = {i for i, (_, c) in brute_classes(rows, 5).items() if c != i}
    found = {r.doc_id for r in near_dup.near_classes(frame(rows)).collect() if r.component_id != r.doc_id}
    assert len(linked) > 60 and found <= linked and len(found) >= 0.99 * len(linked)


def test_near_odd_rows(frame, odd):
    got = sorted((r.doc_id, r.component_id, r.kept) for r in near_dup.near_classes(odd).collect())
    assert len(got) == len(ODD) and (7, 6, False) in got and (1, 1, True) in got and (2, 2, True) in got
    assert near_dup.near_classes(frame([])).count() == 0


def test_odd_sketch_estimates_similarity():
    rule = near_dup.NearRule()
    hasher = near_dup._Hasher(rule)
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 1000).astype(np.uint64)
    for same in (1000, 900, 800):
        b = np.concatenate([a[:same], rng.integers(0, 2**63, 1000 - same).astype(np.uint64)])
        odd = sum(int(x).bit_count() for x in (hasher.sketch(hasher.minimums(a)) ^ hasher.sketch(hasher.minimums(b))).view(np.uint64))
        estimate = 1 + rule.bits / (4 * rule.samples) * np.log(1 - 2 * odd / rule.bits)
        assert abs(estimate - same / (2000 - same)) < 0.12


def brute_hits(text, items, n=10):
    lower = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s or "")
    words = lambda s: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(s))
    doc, hit, found = words(text), set(), set()
    for item, body in items:
        w = words(body)
        size = min(n, len(w))
        windows = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()
        for i in range(len(doc) - size + 1):
            if size and tuple(doc[i : i + size]) in windows:
                hit.update(range(i, i + size))
                found.add(str(item))
    return len(doc), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def contamination(spark, frame, rows, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.contamination(frame(rows), bench).collect()
    return sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got)


@pytest.mark.parametrize("blocks", [1, 3])
def test_contamination_equals_brute_force(spark, frame, monkeypatch, blocks):
    rng = random.Random(blocks)
    vocabulary = [f"v{i}" for i in range(12)] + ["Über", "ß"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 7, 9, 10, 11, 25])))) for i in range(40)] + [(40, None)]
    rows = []
    for i in range(60):
        words = rng.choices(vocabulary, k=rng.randint(0, 60))
        if i % 2:
            body = (items[rng.randrange(40)][1] or "").split()
            words[5:5] = body[rng.randrange(3) :]
        rows.append((i, ", ".join(words).upper() if i % 3 else " ".join(words), "s"))
    rows += [(90, None, "s"), (91, "", "s"), (92, "v1 " * 500, "s")]
    if blocks > 1:
        monkeypatch.setattr(decontam, "BLOCK_BYTES", 500)
    assert contamination(spark, frame, rows, items) == sorted((i, *brute_hits(t, items)) for i, t, _ in rows)


@pytest.mark.parametrize("bound", [1 << 20, 0])
def test_items_without_an_id_and_clean_rows(spark, frame, monkeypatch, bound):
    """They mark words but aren't counted; both ways agree; rows pass whole."""
    monkeypatch.setattr(decontam, "BLOCK_BYTES", bound)
    bench = spark.createDataFrame([(None, "one two three"), (4, "one two three"), (None, "six seven"), (5, None), (4, "one two three")], "item_id long, text string")
    docs = frame([(1, "x One, two three y", "a"), (2, "six seven", "a"), (2, "nothing", "a"), (None, "six seven eight", "a"), (None, None, "a"), (3, "", "a"), (3, "", "a")])
    got = sorted((str(r.doc_id), r.n_hit, r.n_items, r.contaminated) for r in decontam.contamination(docs, bench).collect())
    assert got == sorted([("1", 3, 1, True), ("2", 2, 0, True), ("2", 0, 0, False), ("None", 2, 0, True), ("None", 0, 0, False), ("3", 0, 0, False), ("3", 0, 0, False)])
    assert hashlib.sha256(b"").hexdigest() in {r.items_sha256 for r in decontam.contamination(docs, bench).collect() if r.n_hit == 2}
    left = decontam.clean_rows(docs, bench)
    assert left.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in left.collect() if r.text) == [("2", "nothing")] and left.count() == 4


def test_contamination_odd_rows(spark, frame, odd):
    assert decontam.contamination(odd, spark.createDataFrame([], "item_id long, text string")).filter("contaminated").count() == 0
    assert contamination(spark, frame, [], [(1, "a b c")]) == []


def test_winnowing_guarantee():
    rng = np.random.default_rng(2)
    how = decontam.Winnow()
    for _ in range(300):
        shared = rng.integers(0, 2**63, how.window).astype(np.uint64)
        kept = []
        for _ in range(2):
            text = np.concatenate([rng.integers(0, 2**63, rng.integers(0, 20)).astype(np.uint64), shared, rng.integers(0, 2**63, rng.integers(0, 20)).astype(np.uint64)])
            grams = decontam.gram_hashes(text, how.k)
            kept.append(set(grams[decontam.winnowed(grams, how.w)].tolist()))
        assert kept[0] & kept[1]
