"""Ids of a byte-level BPE vocabulary, through a bounded cache of words.

The ids are those of the tokenizers library. A text without special tokens and
with usual signs only is cut at its spaces: the vocabulary's pattern never
matches over the front of a single space, so the parts can be encoded alone,
and mostly come from the cache. Parts that the cache lacks are cut by the
pattern and merged by tiktoken's core over the same vocabulary. All other texts
go to the tokenizers library whole.
"""

from __future__ import annotations

import json
import re

import numpy as np

WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
#: Latin letters, ASCII and usual punctuation: here \w, \d and \s mean the same in re as letters, numbers and white space do in the pattern.
SAFE = re.compile("[\t-\r -~\xa0\xa1-\xb1\xb4-\xb8\xbb\xbf-ɏ–—‘-„…€]*")
_RUNS = tuple(" " + s for s in "\t\n\x0b\x0c\r \xa0")


def byte_signs() -> list[str]:
    """The sign that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class WordCache:
    """word -> value in two generations of at most `most` / 2 words; words in use move to the younger."""

    def __init__(self, most: int):
        self.half, self.young, self.old = most // 2, {}, {}

    def lacking(self, seen: set[str]) -> list[str]:
        """Those of the seen words that have to be added to young; the rest is there afterwards."""
        if len(self.young) > self.half:
            self.young, self.old = {}, self.young
        missing = seen.difference(self.young)
        if self.old:
            again = [w for w in missing if w in self.old]
            self.young.update(zip(again, map(self.old.__getitem__, again)))
            missing.difference_update(again)
        return list(missing)


class ByteBpe:
    def __init__(self, path: str, most: int = 600_000):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [x["content"] for x in spec["added_tokens"]]
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        by_sign = {s: b for b, s in enumerate(byte_signs())}
        ranks = {bytes(by_sign[c] for c in t): i for t, i in vocab.items() if t not in self.special}
        # The core merges by id, the library by the merges' order: only where these agree it may stand in.
        made = [vocab["".join(m)] for m in merges]
        self.core = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe if made == sorted(set(made)) else None
        self.cache, self.pieces = WordCache(most), {}

    def library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        got = self.pieces.get(piece)
        if got is None:
            got = np.array(self.core.encode_single_piece(piece.encode()), "<u4").tobytes() if self.core else self.library(piece)
            if len(self.pieces) > 50_000:
                self.pieces.clear()
            if len(piece) < 40:
                self.pieces[piece] = got
        return got

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        parts: list[list[str] | None] = []
        for text in texts:
            plain = SAFE.fullmatch(text) and not text.endswith(" ") and not any(x in text for x in (*_RUNS, *self.special))
            parts.append(text.split(" ") if plain else None)
        seen: set[str] = set()
        for p in parts:
            if p:
                seen.update(p[1:])
        known = self.cache
        for w in known.lacking(seen):
            known.young[w] = b"".join(map(self._piece, WORD.findall(" " + w)))
        get = known.young.__getitem__
        return [self.library(t) if p is None else b"".join(map(self._piece, WORD.findall(p[0]))) + b"".join(map(get, p[1:])) for t, p in zip(texts, parts)]
