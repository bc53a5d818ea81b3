"""Token counts, packing and token files."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tarnflow.llm import packing, token_counts, token_store
from tarnflow.llm.tokenising import Encoder, tokenizer_digest

from .conftest import ODD

BYTE, WORD, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))


def ids_of(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_encoder_equals_library(path):
    rng = random.Random(5)
    bits = ["a", "Z", "é", "ß", "中", "1", "'s", " ", "\n", "  ", "\t", "\x01", "\0", "<|endoftext|>", "<|startoftext|>", ".", "　", "​", "\x1c", "word", "́", "\r\n", "?", "🙂"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 12))) for _ in range(3000)]
    tok, enc, counts = Tokenizer.from_file(path), Encoder(path), Encoder(path, counts=True)
    enc.LIMIT = 50  # emptied again and again
    for i in range(0, len(texts), 100):
        some = texts[i : i + 100]
        want = [e.ids for e in tok.encode_batch(some, add_special_tokens=False)]
        assert [np.frombuffer(b, "<u4").tolist() for b in enc.encode(some)] == want
        assert counts.encode(some) == [len(w) for w in want]


def test_sentencepiece_model():
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    assert Encoder(PIECE, counts=True).encode(["Hello world", ""]) == [len(sp.encode("Hello world")), 0]


def test_counts_match_library(odd):
    rows = {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(odd, BYTE).collect()}
    want = set()
    for i, t, _ in ODD:
        n = len(ids_of(BYTE, t))
        want.add((i, len((t or "").encode()), n, n > 512))
    assert rows == want
    assert token_counts.token_counts(odd, BYTE).count() == len(ODD)


def test_cache_is_used_and_appended(spark, frame, tmp_path):
    cache = (tmp_path / "cache").as_uri()
    token_counts.token_counts(frame([(1, "first text", "a"), (2, "first text", "a")]), BYTE, cache).collect()
    stored = spark.read.parquet(cache)
    assert stored.count() == 1 and stored.first().tokenizer_digest == tokenizer_digest(BYTE)
    # A planted count shows that a known text isn't encoded again.
    fake = [(token_counts.content_digest("planted"), tokenizer_digest(BYTE), 77), (token_counts.content_digest("other"), "another version", 99)]
    spark.createDataFrame(fake, token_counts.CACHE_SCHEMA).write.mode("append").partitionBy("tokenizer_digest").parquet(cache)
    got = token_counts.token_counts(frame([(3, "planted", "a"), (4, "new one", "a"), (5, "other", "a")]), BYTE, cache).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {3: 77, 4: len(ids_of(BYTE, "new one")), 5: len(ids_of(BYTE, "other"))}
    assert spark.read.parquet(cache).count() == 5
    # Two runs that add the same text, put together.
    spark.createDataFrame(fake, token_counts.CACHE_SCHEMA).write.mode("append").partitionBy("tokenizer_digest").parquet(cache)
    token_counts.compact(spark, cache, f"{cache}-2")
    assert spark.read.parquet(f"{cache}-2").count() == 5


def test_known_texts_are_not_moved(spark, frame, tmp_path, monkeypatch):
    """With a warm cache, known texts go before the exchange of texts, which
    isn't made at all if all are known."""
    cache, plans = (tmp_path / "cache").as_uri(), {}
    plain = token_counts.materialise
    monkeypatch.setattr(token_counts, "materialise", lambda df, tag: plans.setdefault(tag, df) is None or plain(df, tag))
    old = [(i, f"known text {i}", "a") for i in range(20)]
    token_counts.token_counts(frame(old), BYTE, cache).collect()
    assert plans["counted"].count() == 20
    plans.clear()
    assert token_counts.token_counts(frame([*old, (90, "new text", "a"), (91, "new text", "a")]), BYTE, cache).count() == 22
    assert plans["counted"].count() == 1
    tree = plans["counted"]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" in tree and tree.index("Exchange hashpartitioning") < tree.index("LeftSemi")
    plans.clear()
    assert token_counts.token_counts(frame(old), BYTE, cache).count() == 20 and "counted" not in plans
    monkeypatch.setattr(token_counts, "SENT_DIGESTS", 0)  # dealt out by digest
    assert token_counts.token_counts(frame([*old, (92, "newer text", "a")]), BYTE, cache).count() == 21


def test_empty_tables(frame):
    none = frame([])
    assert token_counts.token_counts(none, BYTE).count() == 0
    assert packing.pack_documents(none, WORD).count() == 0
    assert token_store.token_store(none, BYTE).count() == 0


def test_packing_round_trip(odd):
    rows = packing.pack_documents(odd, WORD, packing.Capacity(tokens=64, documents=3, attention=64 * 64)).collect()
    want = []
    for i, t, _ in ODD:
        ids = np.array([*ids_of(WORD, t), 0], "<u4")
        for k in range(0, len(ids), 64):
            want.append((i, k // 64, k, len(ids[k : k + 64]), zlib.crc32(ids[k : k + 64].tobytes())))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64 and len(parts) <= 3


def test_best_fit_obeys_all_capacities_and_fills():
    rng = np.random.default_rng(3)
    lengths = np.minimum(2048, rng.lognormal(6, 1, 4000).astype(np.int64) + 1)
    for rule in ("norm", "dot"):
        cap = packing.Capacity(documents=20, attention=3_000_000 if rule == "dot" else 2048 * 2048, rule=rule)
        small = lengths if rule == "norm" else np.minimum(lengths, 1700)
        bins, offsets = packing.best_fit(small, cap)
        for b in np.unique(bins):
            mine = small[bins == b]
            assert mine.sum() <= cap.tokens and len(mine) <= cap.documents and (mine.astype(float) ** 2).sum() <= cap.attention
        if rule == "norm":
            assert len(np.unique(bins)) <= 1.02 * np.ceil(small.sum() / cap.tokens)
    with pytest.raises(ValueError):
        packing.best_fit(np.array([3000]), packing.Capacity())


def test_simple8b_round_trip():
    rng = np.random.default_rng(1)
    cases = [[], [0], [1] * 500, rng.integers(0, 50000, 10000), rng.integers(0, 2, 9001), [2**64 - 1, 15 << 60, 5] * 7, rng.choice([0, 1, 7, 200, 70000, 2**61], 9000).astype(np.uint64)]
    for case in cases:
        ids = np.array(case, np.uint64)
        first, words = token_store.encode_ids(ids)
        assert (token_store.decode_words(first, words, len(ids)) == ids).all()
        for b in range(len(first)):
            part = ids[b * token_store.BLOCK : (b + 1) * token_store.BLOCK]
            assert (token_store.decode_block(first, words, len(ids), b) == part).all()
    assert len(token_store.encode_ids(np.zeros(6000, np.uint64))[1]) < 110  # sixty to a word


def test_token_store_order_and_bodies(odd):
    rows = sorted(token_store.token_store(odd, BYTE).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted(i for i, _, _ in ODD)
    at = 0
    texts = {i: t for i, t, _ in ODD}
    for r in rows:
        ids = np.array([*ids_of(BYTE, texts[r.doc_id]), 0], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
