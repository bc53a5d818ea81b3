"""Secrets, quality rules, quality classifier and language model."""

import hashlib
import math
import random
import re
import string
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnflow.llm import kn_lm, quality_qda, quality_rules, secrets, textstats

from .conftest import LONG, ODD

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    found = [(m.start(), 0, "assign", m.end(), m[2]) for m in ASSIGN.finditer(text or "") if len(m[2]) >= 8]
    found += [(m.start(), 1, "access", m.end(), m[0]) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end(), m[0]) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 32]
    return sorted(found)


def scan(docs):
    return sorted(secrets.secret_scan(docs).collect(), key=lambda r: r.doc_id)


def test_base_spans_equal_regular_expressions(frame):
    rng = random.Random(4)
    bits = ["password", "PassWd", "secret ", "token", "api_key", "apikey", "=", ": ", "'", '"', "hunter2hunter2", "short", "AKIA", "ABCD1234EFGH5678", "0123456789abcdef" * 2, "dead", "é", "🙂", "\n", " ", "-"]
    rows = [(i, "".join(rng.choices(bits, k=rng.randint(0, 14))), "ab"[i % 2]) for i in range(400)] + [(500, None, "a"), (501, "token: secret = abcdefghij", None)]
    for r in scan(frame(rows)):
        want = base_spans(dict((i, t) for i, t, _ in rows)[r.doc_id])
        joined = ",".join(f"{k}:{a}:{z}" for a, _, k, z, _ in want)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(w[2] == k for w in want) for k in ("assign", "access", "hex"))
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def test_owners_tell_live_from_example(frame):
    rows = [(1, "password=Abc123xyz789Q", "a"), (2, "x password=Abc123xyz789Q", "a")]
    rows += [(10 + i, "token: Examp1eExamp1e9", "ab"[i % 2]) for i in range(4)]
    rows += [(20 + i, "token: Copied1Copied29", "a") for i in range(5)] + [(30, "secret=aaaaaaaaaa", "a")]
    got = {r.doc_id: r for r in scan(frame(rows))}
    assert (got[1].n_live, got[1].n_example) == (1, 0) and got[1].spans == "assign:0:22,live:9:22"
    assert (got[10].n_live, got[10].n_example) == (0, 1) and (got[20].n_live, got[20].n_example) == (0, 1)
    assert (got[30].n_live, got[30].n_example) == (0, 0) and got[30].spans == "assign:0:17"


def test_secret_scan_is_native_and_total(frame, odd):
    plan = secrets.candidates(odd, ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert len(scan(odd)) == len(ODD) and scan(frame([])) == []


def brute_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = Counter(zip(words, words[1:], words[2:]))
    hit = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i : i + 3])] > 1:
            hit.update((i, i + 1, i + 2))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def random_texts(seed, n):
    rng = random.Random(seed)
    words = ["The", "cat", "sat", "é€🙂", "x#y", "100%", "a|b", "Ünder", "mat."]
    seps = [" ", "  ", "\n", "\t", "\r\n", " ", "\v"]
    return ["".join(rng.choice(words) + rng.choice(seps) for _ in range(rng.randint(0, 80))) for _ in range(n)]


def brute_shares(text):
    """The other statistics, character by character."""
    words, raw = re.findall(r"[^\x20\x09-\x0D]+", text), text.encode()
    letters = [c for c in text if (c.isalnum() or unicodedata.category(c)[0] in "LN") and not c.isdecimal() and c != "_"]
    return (
        sum(bool(re.search(r"[^\x20\x09-\x0D]", line)) for line in text.split("\n")),
        len(text),
        len(set(words)),
        sum(c.isupper() for c in letters),
        len(letters),
        sum(c in string.digits for c in text),
        sum(c in string.punctuation for c in text),
        max((len(w.encode()) for w in words), default=0),
        max(Counter(words).values(), default=0),
        len(zlib.compress(raw, 1)),
        len(raw),
    )


def test_statistics_equal_brute_force():
    more = ["ÀÉ straße ŁÓDŹ 123 ٣٤ _x_ ²½", "ABC def GHI!?", "中文 日本 中文", "a_b_c 9 9 9\n\n  \n9", "ǅ ﬁ Ⅷ ⓐ"]
    for t in [*random_texts(1, 200), *more, "", "a a a a a", "x", LONG[:500]]:
        got = textstats.text_statistics(t)
        assert len(got) == len(textstats.COUNTS + textstats.SHARES)
        assert got[:5] == brute_statistics(t)
        assert dict(zip(textstats.SHARES, got[5:])) == dict(zip(textstats.SHARES, brute_shares(t))), t


def test_rules_base_columns(frame, odd):
    rows = [(i, t, "s") for i, t in enumerate(random_texts(2, 60))] + [(70, "w " * 60, "s"), (71, " ".join(f"w{i}" for i in range(60)), "s")]
    for r in quality_rules.quality_rules(frame(rows)).collect():
        want = brute_statistics(dict((i, t) for i, t, _ in rows)[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r.base_failed == failed and not (failed and r.kept)
    assert quality_rules.quality_rules(odd).count() == len(ODD)
    assert quality_rules.quality_rules(frame([])).count() == 0


def test_estimation_over_patterns_equals_over_rows():
    rng = np.random.default_rng(0)
    bad = rng.random(3000) < 0.15
    votes = np.where(rng.random((3000, 6)) < 0.97, 1, -1)
    kind = rng.integers(0, 3, 3000)
    for k in range(3):
        mine = bad & (kind == k)
        votes[mine, 2 * k] = np.where(rng.random(mine.sum()) < 0.95, -1, 1)
        votes[mine, 2 * k + 1] = np.where(rng.random(mine.sum()) < 0.8, -1, 1)
    votes[rng.random(votes.shape) < 0.1] = 0
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    a, b = quality_rules.estimate(patterns, counts.astype(float)), quality_rules.estimate(votes, np.ones(len(votes)))
    assert np.allclose(a.good, b.good, atol=1e-5) and np.allclose(a.bad, b.bad, atol=1e-5)
    p = a.posterior(patterns)[inverse.ravel()]
    assert ((p < 0.5) == bad).mean() > 0.93
    clean = a.posterior(np.ones((1, 6), int))[0]
    assert clean > 0.95


def plain_em(rows, rounds=4000):
    """The same model, document by document and without arrays; kinds that
    half a document doesn't support go, as the operator's docstring says."""
    r = len(rows[0])
    q = quality_rules
    share = {None: q.SHARES[0] / (q.SHARES[0] + r * q.SHARES[1])} | {k: q.SHARES[1] / (q.SHARES[0] + r * q.SHARES[1]) for k in range(r)}
    agree = {(None, i): 0.95 for i in range(r)} | {(k, i): 0.9 if i == k else 0.3 for k in range(r) for i in range(r)}
    for _ in range(rounds):
        mass, voted, right = Counter(), Counter(), Counter()
        for v in rows:
            joint = {}
            for z in share:
                joint[z] = share[z]
                for i in range(r):
                    if v[i]:
                        ok = (v[i] > 0) == (z is None)
                        joint[z] *= agree[z, i] if ok else 1 - agree[z, i]
            total = sum(joint.values())
            for z in share:
                w = joint[z] / total
                mass[z] += w
                for i in range(r):
                    if v[i]:
                        voted[z, i] += w
                        right[z, i] += w * ((v[i] > 0) == (z is None))
        before = dict(agree)
        for z in share:
            for i in range(r):
                prior = q.ON_GOOD if z is None else q.OWN if z == i else q.OTHER
                agree[z, i] = (right[z, i] + prior[0]) / (voted[z, i] + sum(prior))
        weight = {z: mass[z] + (q.SHARES[0] if z is None else q.SHARES[1]) for z in share}
        share = {z: w / sum(weight.values()) for z, w in weight.items()}
        if max(abs(agree[k] - before[k]) for k in before) < 1e-9:
            gone = [z for z in share if z is not None and mass[z] < 0.5]
            if not gone:
                break
            share = {z: w for z, w in share.items() if z not in gone}
            share = {z: w / sum(share.values()) for z, w in share.items()}
            agree = {k: a for k, a in agree.items() if k[0] not in gone}
    return share, agree


def test_estimation_equals_a_plain_one():
    rng = np.random.default_rng(4)
    bad = rng.random(150) < 0.2
    votes = np.where(rng.random((150, 4)) < 0.9, 1, -1)
    votes[bad, 0] = np.where(rng.random(bad.sum()) < 0.9, -1, 1)
    votes[bad, 1] = np.where(rng.random(bad.sum()) < 0.8, -1, 1)
    votes[rng.random(votes.shape) < 0.2] = 0
    got, (share, agree) = quality_rules.estimate(votes, np.ones(150), rounds=4000), plain_em(votes.tolist())
    kinds = [z for z in share if z is not None]
    assert len(got.shares) == len(share) and np.allclose(got.shares, [share[None], *[share[k] for k in kinds]], atol=1e-4)
    assert np.allclose(got.good, [agree[None, i] for i in range(4)], atol=1e-4)
    assert np.allclose(got.bad, [[agree[k, i] for i in range(4)] for k in kinds], atol=1e-4)


def test_planted_accuracies_are_found():
    """Good documents' rules right in 80 to 95 of 100 votes, two kinds of junk."""
    rng = np.random.default_rng(5)
    n, good, kinds = 40_000, np.array([0.95, 0.9, 0.85, 0.92, 0.8, 0.94]), {0: [0.95, 0.85, 0.1, 0.2, 0.15, 0.9], 3: [0.1, 0.15, 0.85, 0.95, 0.8, 0.1]}
    z = rng.choice([-1, 0, 3], n, p=[0.8, 0.12, 0.08])
    wrong = np.where((z == -1)[:, None], 1 - good, 0.0)
    for k, b in kinds.items():
        wrong[z == k] = b
    votes = np.where(rng.random((n, 6)) < wrong, -1, 1)
    votes[rng.random(votes.shape) < 0.1] = 0
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    model = quality_rules.estimate(patterns, counts.astype(float), rounds=5000)
    assert np.abs(model.good - good).max() < 0.03 and model.good.min() < 0.85
    assert abs(model.shares[0] - 0.8) < 0.04
    verdict = model.posterior(patterns)[inverse.ravel()] >= 0.5
    assert (verdict == (z == -1)).mean() > 0.95


def test_unsupported_kinds_go():
    votes = np.array([[1, 1, 1], [-1, -1, 1]])
    model = quality_rules.estimate(votes, np.array([900.0, 100.0]))
    assert len(model.shares) < 4 and model.posterior(votes)[0] > 0.99 > 0.01 > model.posterior(votes)[1]


def test_clean_corpus_is_kept():
    votes = np.array([[1, 1, 1, 0], [1, 1, 1, 1], [1, 1, 0, 1], [-1, 1, 1, 1]])
    model = quality_rules.estimate(votes, np.array([5000.0, 3000.0, 2000.0, 40.0]))
    assert (model.posterior(votes[:3]) > 0.99).all()


def test_rules_on_labelled_documents(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality_rules.quality_rules(docs).join(labels, "doc_id").collect()
    good = [r for r in got if r.quality == 1 and not r.base_failed]
    assert sum(r.kept for r in good) >= 0.97 * len(good)
    bad = [r for r in got if r.quality == 0]
    assert sum(r.kept for r in bad) <= 0.2 * len(bad)


def test_discriminant_equals_gaussian_densities(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 1, (200, 3)), rng.normal(1.5, 2, (80, 3))])
    y = [1] * 200 + [0] * 80
    df = spark.createDataFrame([(*map(float, r), k) for r, k in zip(x, y)] + [(9.0, 9.0, 9.0, None)], "x0 double, x1 double, x2 double, quality int")
    model = quality_qda.train(df, ["x0", "x1", "x2"], 0.1, 0.05)
    got = [r[0] for r in df.filter("quality is not null").select(quality_qda.log_odds(model, [F.col(c) for c in ("x0", "x1", "x2")])).collect()]
    logs = []
    covs = [np.cov(x[np.array(y) == k].T, bias=True) for k in (0, 1)]
    pooled = (80 * covs[0] + 200 * covs[1]) / 280
    for k, n in ((0, 80), (1, 200)):
        cov, mean = quality_qda.shrunk(covs[k], pooled, 0.1, 0.05), x[np.array(y) == k].mean(axis=0)
        d = x - mean
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) - 0.5 * np.linalg.slogdet(cov)[1] + np.log((n + 1) / 282))
    assert np.allclose(sorted(got), sorted(logs[1] - logs[0]))


def test_quality_scores_hold_out(spark, frame, sf, odd):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality_qda.quality_scores(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == r.quality for r in held) >= 0.9 * len(held)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_qda.quality_scores(odd, none).count() == len(ODD)
    assert quality_qda.quality_scores(frame([]), labels).count() == 0


def brute_kn(train, texts):
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) + [None]
    unigrams, pairs = Counter(), Counter()
    for t in train:
        w = words(t)
        unigrams.update(w)
        pairs.update(zip(["<s>", *w[:-1]], w))
    n, v = sum(unigrams.values()), len(unigrams)
    before, context, kinds = Counter(), Counter(), defaultdict(lambda: [0, 0, 0])
    for (a, b), c in pairs.items():
        before[b] += 1
        context[a] += c
        kinds[a][min(c, 3) - 1] += 1
    hist = lambda counts: kn_lm.discounts(*[sum(c == k for c in counts) for k in (1, 2, 3, 4)])
    d, e = hist(pairs.values()), hist(before.values())
    total = sum(before.values())
    g = sum(x * sum((c == k if k < 3 else c >= 3) for c in before.values()) for k, x in zip((1, 2, 3), e)) / total if total else 1
    cut = lambda c, by: max(c - (by[min(c, 3) - 1] if c else 0), 0)
    out = []
    for t in texts:
        w, base, score = words(t), 0.0, 0.0
        for a, b in zip(["<s>", *w[:-1]], w):
            base += math.log10((unigrams[b] + 0.5) / (n + 0.5 * (v + 1)))
            low = cut(before[b], e) / total + g / (v + 1) if total else 1 / (v + 1)
            if context[a]:
                low = (cut(pairs[a, b], d) + sum(x * k for x, k in zip(d, kinds[a])) * low) / context[a]
            score += math.log10(low)
        out.append((len(w), sum(unigrams[b] > 0 for b in w), n, base, score))
    return out


@pytest.mark.parametrize("shard_tokens, step_bits, narrow", [(4_000_000, 12, 1 << 32), (20, 12, 1 << 32), (20, 2, 1 << 32), (40, 2, 10)])
def test_language_model_equals_brute_force(frame, monkeypatch, shard_tokens, step_bits, narrow):
    """In one step of dealing and in several, with pairs of either width."""
    monkeypatch.setattr(kn_lm, "SHARD_TOKENS", shard_tokens)
    monkeypatch.setattr(kn_lm, "STEP_BITS", step_bits)
    monkeypatch.setattr(kn_lm, "NARROW", narrow)
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(30)] + ["Ä", "THE"]
    rows = [(i, " ".join(rng.choices(vocabulary, weights=range(1, 33), k=rng.randint(0, 40))), "s") for i in range(60)] + [(60, None, "s"), (61, "never seen words", "s")]
    got = {r.doc_id: r for r in kn_lm.lm_scores(frame(rows), F.col("doc_id") % 3 != 1).collect()}
    want = brute_kn([t for i, t, _ in rows if i % 3 != 1], [t for _, t, _ in rows])
    for (i, _, _), w in zip(rows, want):
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == w[:3] and r.held_out == (i % 3 == 1)
        assert math.isclose(r.base_score, w[3], rel_tol=1e-9) and math.isclose(r.score, w[4], rel_tol=1e-6)


def test_language_model_odd_rows(frame, odd):
    assert kn_lm.lm_scores(odd, F.lit(True)).count() == len(ODD)
    unlearnt = kn_lm.lm_scores(odd, F.lit(False)).collect()
    assert len(unlearnt) == len(ODD) and all(r.train_tokens == 0 and r.score == 0 for r in unlearnt)
    assert kn_lm.lm_scores(frame([]), F.lit(True)).count() == 0
    x = np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64)
    assert (kn_lm.unmix64(kn_lm.mix64(x)) == x).all()


@pytest.mark.parametrize("wide", [False, True])
def test_counts_and_numbers_of_any_size(wide):
    """Counts beyond 32 bits don't wrap; pairs come back from their keys."""
    big = np.array([3, 1 << 33, (1 << 40) + 1], np.uint64)
    for values in (big, big[:1], big[:0]):
        assert (kn_lm.unpacked(kn_lm.packed(values), len(values)) == values).all()
    (keys,), counts = kn_lm.summed([(np.array([5, 9], np.uint64),), (np.array([9], np.uint64),)], [big[:2], big[1:2]])
    assert keys.tolist() == [5, 9] and counts.tolist() == [3, 1 << 34]
    top = 1 << (40 if wide else 32)
    before, word = np.random.default_rng(2).integers(0, top, (2, 1000))
    b, w = kn_lm.pair_of(kn_lm.pair_key(before, word, wide))
    assert (b == before).all() and (w == word).all()


def test_equal_hashes_of_different_contexts(tmp_path):
    folder = tmp_path.as_uri()
    for field, values in (("hash", [7, 7, 7, 9]), ("context", [1, 2, 5, 1]), ("count", [10, 20, 50, 90])):
        kn_lm.write_file(f"{folder}/pairs-000000.{field}", np.array(values, "<u8").tobytes())
    shards = kn_lm._shards(folder, "pairs", 2, {0: 4}, wide=True)
    found = kn_lm.find(shards, np.array([7, 7, 7, 9], np.uint64), np.array([5, 2, 3, 1], np.uint64))
    assert found.tolist() == [2, 1, -1, 3]
