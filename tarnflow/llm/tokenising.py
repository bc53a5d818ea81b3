"""Exact token ids by a tokenizer file, with the ids of repeated pieces kept.

A text is cut only where the tokenizer's own pre-tokenizer must cut too, each
distinct piece is encoded once by the library, and the ids are joined.  What
can't be cut safely (odd white space, tokenizers of other kinds) is encoded
whole by the library.
"""

from __future__ import annotations

import array
import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import claim

#: White space, or characters that libraries may class differently.  A text
#: with a piece that holds one is encoded whole.
_UNSAFE = re.compile("[\\s\\0\\x1c-\\x1f\\x85\\u180e\\u200b\\u2060\\ufeff]")
#: Those of them that Python doesn't split at.
_UNLIKE = re.compile("[\\0\\u180e\\u200b\\u2060\\ufeff]")

#: Stands for ids that aren't known yet.
_HOLE = b"?"
#: A word that is put between pieces; pieces that hold it are encoded alone.
_APART = "\x01"


def tokenizer_digest(path: str) -> str:
    """Names the tokenizer's version: its file and its library's version."""
    with open(path, "rb") as f:
        body = f.read()
    if path.endswith(".json"):
        import tokenizers

        version = f"tokenizers {tokenizers.__version__}"
    else:
        import sentencepiece

        version = f"sentencepiece {sentencepiece.__version__}"
    return hashlib.sha256(version.encode() + b"\0" + body).hexdigest()


class _Cache(dict):
    """piece -> ids; what is missing is noted and leaves a hole.  When it is
    full, its pieces become the old ones and those that were old go; an old
    piece that is asked for is new again, so frequent ones stay."""

    def __init__(self, hole, empty):
        self.hole, self.empty, self.missing, self.old = hole, empty, [], {}

    def __missing__(self, piece: str):
        value = self.old.get(piece)
        if value is None:
            self.missing.append(piece)
            return self.hole
        self[piece] = value
        return value

    def age(self) -> None:
        self.old = dict(self)
        self.clear()


class Encoder:
    """encode(texts) gives each text's ids as little-endian uint32 bytes, or
    their number if ``counts``.  No begin, end or other special tokens are
    added; special strings inside texts are handled as the library's default."""

    #: New pieces kept, and as many old ones (about 190 bytes each).
    LIMIT = 600_000
    #: Pieces that are encoded in one call.
    CALL = 4096

    def __init__(self, path: str, counts: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.counts, self.cache = counts, (_Cache(-1, 0) if counts else _Cache(_HOLE, b""))
        if path.endswith(".model"):
            import sentencepiece

            self.sp, self.mode = sentencepiece.SentencePieceProcessor(model_file=path), "whole"
            return
        from tokenizers import Tokenizer

        self.sp, self.tok = None, Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        spec = json.loads(self.tok.to_str())
        self.mode = self._mode(spec)
        self.special = [a["content"] for a in spec["added_tokens"]]
        if self.mode == "blank-led":
            # Bytes of each token: its text has one character for each byte.
            names = self.tok.get_vocab(with_added_tokens=True)
            self.width = np.zeros(max(names.values()) + 1, np.int64)
            for name, token in names.items():
                self.width[token] = len(name)
        elif self.mode == "blank-parted":
            # A word of its own that is one token keeps pieces apart.
            ids = self.tok.encode(_APART, add_special_tokens=False).ids
            self.apart = ids[0] if len(ids) == 1 else None

    @staticmethod
    def _mode(spec: dict) -> str:
        if any(a["lstrip"] or a["rstrip"] or a["single_word"] or re.search(r"\s", a["content"]) for a in spec["added_tokens"]):
            return "whole"
        pre = spec["pre_tokenizer"] or {}
        if not spec["normalizer"] and pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]:
            return "blank-led"
        parts = pre.get("pretokenizers", [])
        steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        if (
            set(steps) <= {"NFC", "Replace", "Lowercase"}
            and [p["type"] for p in parts] == ["Split", "ByteLevel"]
            and parts[0]["behavior"] == "Removed"
            and parts[0]["invert"]
            and "[^\\s" in parts[0]["pattern"].get("Regex", "")
            and not parts[1]["use_regex"]
            and not parts[1]["add_prefix_space"]
        ):
            return "blank-parted"
        return "whole"

    def _pack(self, ids: list[int]):
        return len(ids) if self.counts else array.array("I", ids).tobytes()

    def _whole(self, text: str):
        ids = self.sp.encode(text, num_threads=1) if self.sp else self.tok.encode(text, add_special_tokens=False).ids
        return self._pack(ids)

    def _unit(self, piece: str) -> str | None:
        """The piece as it stands in a text; None if it can't stand alone."""
        if self.mode == "blank-parted":
            return piece
        led = piece[:1] in ("\0", "\n")
        body = piece[1:] if led else piece
        if not body or _UNSAFE.search(body):
            return None
        return body if piece[0] == "\0" else piece if led else " " + piece

    def _alone(self, unit: str) -> bytes:
        return array.array("I", self.tok.encode(unit, add_special_tokens=False).ids).tobytes()

    def _encode_units(self, units: list[str]) -> list[bytes]:
        """The ids of units that begin with white space or, in the other mode,
        are words: many in one call, then parted where each one ends."""
        parted = self.mode == "blank-parted"
        if parted:
            text = f" {_APART} ".join(units)
        else:
            text = "".join(units)
        ids = np.frombuffer(array.array("I", self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids), "<u4")
        if parted:
            at = np.flatnonzero(ids == self.apart)
            starts, stops = np.concatenate(([0], 4 * at + 4)).tolist(), np.append(4 * at, 4 * len(ids)).tolist()
        else:
            sizes = map(len, units) if text.isascii() else [len(u.encode("utf-8", "surrogatepass")) for u in units]
            ends = np.cumsum(np.fromiter(sizes, np.int64, len(units)))
            done = np.cumsum(self.width[ids])
            at = np.searchsorted(done, ends)
            if not np.array_equal(done[at], ends):
                raise RuntimeError("a token goes on over two pieces")
            stops = (4 * at + 4).tolist()
            starts = [0, *stops[:-1]]
        if len(stops) != len(units):
            raise RuntimeError("pieces and their ids differ in number")
        body = ids.tobytes()
        return [body[a:z] for a, z in zip(starts, stops)]

    def _learn(self, pieces: set[str]) -> set[str]:
        """Adds pieces to the cache; returns those that can't stand alone."""
        parted, pack = self.mode == "blank-parted", (lambda b: len(b) >> 2) if self.counts else (lambda b: b)
        alone = [p for p in pieces if not p] if parted else [p for p in pieces if p[:1] == "\0"]
        names = list(pieces.difference(alone))
        units = names if parted else [p if p[:1] == "\n" else " " + p for p in names]
        for i in range(0, len(units), self.CALL):
            some, text = units[i : i + self.CALL], names[i : i + self.CALL]
            if self._plain(some):
                bodies = self._encode_units(some)
                self.cache.update(zip(text, map(pack, bodies) if self.counts else bodies))
            else:
                alone += text
        odd = set()
        for p in alone:
            unit = self._unit(p)
            if unit is None:
                odd.add(p)
            else:
                self.cache[p] = pack(self._alone(unit) if unit else b"")
        return odd

    def _plain(self, units: list[str]) -> bool:
        """Whether all may go in one call: no special strings, and each a blank
        or line end and then no other white space."""
        text = "".join(units)
        if any(x in text for x in self.special):
            return False
        if self.mode == "blank-parted":
            return self.apart is not None and _APART not in text
        return text.split() == [u[1:] for u in units] and not _UNLIKE.search(text)

    def _cut(self, texts: pa.Array) -> pa.ListArray:
        """Pieces of each text.  A blank or line end between two other
        characters starts a token and no token goes on over it; \\0 marks the
        piece at a text's start."""
        if self.mode == "blank-parted":
            return pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        return pc.split_pattern(pc.binary_join_element_wise("\0", pc.replace_substring(texts, "\n", " \n"), ""), " ")

    def encode(self, texts: pa.Array | list[str]) -> list:
        """Ids (or their number) of each text; empty texts have none.

        Texts are cut and their distinct pieces found by Arrow; only these are
        looked up, and Arrow strings their ids together again."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        if self.mode == "whole" or not len(texts):
            return [self._whole(t) for t in texts.to_pylist()]
        cut = self._cut(texts)
        bounds = cut.offsets.to_numpy()
        pieces = cut.flatten().dictionary_encode()
        place, names = pieces.indices.to_numpy(), pieces.dictionary.to_numpy(zero_copy_only=False).tolist()

        cache = self.cache
        if len(cache) > self.LIMIT:
            cache.age()
        cache.missing = []
        values = list(map(cache.__getitem__, names))
        missing, cache.missing = cache.missing, []
        odd = self._learn(set(missing))
        at = -1
        for p in missing:
            at = values.index(cache.hole, at + 1)
            values[at] = cache.get(p, cache.empty)
        for p in missing:
            if len(p) > 64:  # long pieces seldom come again
                cache.pop(p, None)

        if self.counts:
            sums = np.concatenate(([0], np.cumsum(np.array(values, np.int64)[place])))
            out = (sums[bounds[1:]] - sums[bounds[:-1]]).tolist()
        else:
            joined = pa.array(values, pa.large_binary()).take(pieces.indices)
            _, edges, body = joined.buffers()
            edges = np.frombuffer(edges, np.int64)[joined.offset : joined.offset + len(joined) + 1][bounds].tolist()
            body = memoryview(body) if body is not None else memoryview(b"")
            out = [bytes(body[a:z]) for a, z in zip(edges, edges[1:])]
        whole = set()
        if odd:
            bad = np.flatnonzero(np.fromiter((n in odd for n in names), bool, len(names))[place])
            whole.update((np.searchsorted(bounds, bad, side="right") - 1).tolist())
        if self.mode == "blank-led":
            whole.update(np.flatnonzero(pc.match_substring(texts, "\0").to_numpy(zero_copy_only=False)).tolist())
        for i in whole:
            out[i] = self._whole(texts[i].as_py())
        return out


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, counts: bool = False, limit: int = Encoder.LIMIT) -> Encoder:
    """The worker's encoder of this file, made once for each Python worker."""
    claim((path, counts), lambda: _ENCODERS.pop((path, counts), None))
    if (path, counts) not in _ENCODERS:
        _ENCODERS[path, counts] = Encoder(path, counts)
    _ENCODERS[path, counts].LIMIT = limit
    return _ENCODERS[path, counts]
