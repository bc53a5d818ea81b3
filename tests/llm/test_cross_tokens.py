"""Token links against whole texts encoded by the libraries and plain Python."""

import hashlib
import random
from bisect import bisect_right
from collections import Counter, defaultdict
from itertools import product

import pytest
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from tarnflow.llm import cross_tokens

from .conftest import ODD

A_PATH, B_PATH = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def brute(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, digest) of each text, from
    every link of every occurrence."""
    tok, sp = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    tok.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    odd = [b for b in range(256) if b not in plain]
    of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(odd)}
    docs = []
    for t in texts:
        a = tok.encode(" " + t, add_special_tokens=False).ids if t else []
        b = sp.encode(t) if t else []
        a_bytes = [bytes(of[c] for c in tok.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not t or b"".join(a_bytes) != (" " + t).encode() or b"".join(b_bytes) != (" " + t).encode():
            docs.append(None)
            continue
        ends = []
        for parts in (a_bytes, b_bytes):
            at, mine = 0, []
            for p in parts:
                at += len(p)
                mine.append(at)
            ends.append(mine)
        stops = sorted(set(ends[0]) & set(ends[1]))
        groups, low = [], 0
        for high in stops:
            groups.append(tuple(ids[bisect_right(mine, low) : bisect_right(mine, high)] for ids, mine in ((a, ends[0]), (b, ends[1]))))
            low = high
        docs.append((len(a), len(b), groups))
    counts = Counter()
    for d in docs:
        counts.update({p for x, y in d[2] for p in product(x, y)} if d else ())
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        links = [p for x, y in d[2] for p in product(x, y)]
        name = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in d[2])
        out.append((d[0], d[1], len(d[2]), len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), hashlib.sha256(name.encode()).hexdigest()))
    return out


def texts_of(n, seed):
    rng = random.Random(seed)
    bits = ["token", "ization", "Grüße", "中文", "1234", "'s", " ", " ", " ", "\n", "\n\n", "  ", "\t", "\0", "<|endoftext|>", "<s>", "<0x0A>", ".", "…", "​", "\x1c", "the", "re", "aaaaaaa", "🙂", "é", "▁", "\r\n", "?", "!!"]
    return ["".join(rng.choices(bits, k=rng.randint(0, 25))) for _ in range(n)]


@pytest.mark.parametrize("sent", [cross_tokens.SENT_GROUPS, 40, 0])
def test_equals_brute_force(frame, sent):
    rows = [(i, t, "a") for i, t in enumerate(texts_of(400, 11), 100)] + ODD + [(None, "the same tokens", "a"), (1, "the the  the\nthe", "a")]
    got = cross_tokens.token_links(frame(rows), A_PATH, B_PATH, sent).collect()
    want = [(r[0], *b) for r, b in zip(rows, brute([t for _, t, _ in rows]))]
    assert sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got), key=str) == sorted(want, key=str)


def test_units_in_any_batch(frame, monkeypatch):
    """Units learnt few at a time, and forgotten again and again, give the same."""
    texts = texts_of(300, 5)
    for t in filter(None, texts):
        assert "".join(cross_tokens._unit(k) for k in cross_tokens.keys_of(t)) == " " + t
    want = brute(texts)
    for call, packed in ((1, True), (7, True), (5000, False)):
        known = cross_tokens.Units(A_PATH, B_PATH, 0)
        known.packed = packed
        monkeypatch.setattr(cross_tokens.Units, "CALL", call)
        for t, w in zip(texts, want):
            numbers = known.numbers(cross_tokens.keys_of(t)) if t else []
            facts = [known.facts[5 * i : 5 * i + 5] for i in numbers]
            sums = [sum(f[k] for f in facts) for k in range(5)]
            assert (0, 0, 0, 0) == w[:4] if sums[4] else tuple(sums[:4]) == w[:4]


def test_empty(frame):
    assert cross_tokens.token_links(frame([]), A_PATH, B_PATH).count() == 0


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    want = {r.doc_id: b for r, b in zip(rows, brute([r.text for r in rows]))}
    got = cross_tokens.token_links(docs, A_PATH, B_PATH).collect()
    assert {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got} == want
