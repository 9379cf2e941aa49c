"""BPE with word ends: speculate and verify.

Greedy longest match proposes the tokens of a word. A token sequence is the BPE
result exactly if every adjacent pair of its tokens is what BPE makes of that
pair alone; those checks run for all new pairs of a batch at once in numpy, by
undoing the merges of both tokens from the seam outwards. Only words with a
failing pair go through exact merging. Words are cached, within a bound.

Defined results
  null or empty text: no tokens, the hash of no bytes; repeated rows: each
  special token strings in a text: their ids, as the library does it
  no rows: no rows; extra columns: ignored; null doc_id: stays null
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from plumbline.llm.bytebpe import SAFE, WordCache, byte_signs
from plumbline.llm.common import chunks, ship, table

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
END = "</w>"
FAST = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
EXACT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class WordBpe:
    def __init__(self, path: str, most: int = 800_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        texts = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.text_of = [texts.get(i, "") for i in range(max(texts) + 1)]
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.normalizer = None
        self.path = path
        self.signs = byte_signs()
        self.cache = WordCache(most)
        #: first two signs -> the longest token that begins with them
        self.longest: dict[str, int] = {}
        for t in self.vocab:
            self.longest[t[:2]] = max(self.longest.get(t[:2], 0), len(t))
        n = max(self.vocab.values()) + 1
        self.n = n
        #: rank: a token's merge, -1 for single signs; left, right: what it is merged from.
        self.rank, self.left, self.right = np.full(n, -1, np.int64), np.arange(n), np.arange(n)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for r, (a, b) in enumerate(spec["model"]["merges"]):
            x, y, made = self.vocab[a], self.vocab[b], self.vocab[a + b]
            if (x, y) not in self.merges:
                self.merges[x, y] = (r, made)
                if self.rank[made] < 0:
                    self.rank[made], self.left[made], self.right[made] = r, x, y
        keys = np.array([a * n + b for a, b in self.merges], np.int64)
        order = np.argsort(keys)
        self.merge_keys, self.merge_ranks = keys[order], np.array([r for r, _ in self.merges.values()], np.int64)[order]
        self.made = np.zeros(len(spec["model"]["merges"]), np.int64)
        for r, made in self.merges.values():
            self.made[r] = made
        self.sound = self._prove()

    # exact merging

    def merge(self, words: list[list[int]]) -> list[list[int]]:
        """Exact BPE of all words at once: each round merges, in every word, its pair of least rank."""
        if not words:
            return []
        length = np.array([len(w) for w in words])
        token = np.array([t for w in words for t in w], np.int64)
        word = np.repeat(np.arange(len(words)), length)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        none = np.iinfo(np.int64).max
        while len(token):
            key = token[:-1] * self.n + token[1:]
            at = np.minimum(np.searchsorted(self.merge_keys, key), len(self.merge_keys) - 1)
            rank = np.where((self.merge_keys[at] == key) & (word[:-1] == word[1:]), self.merge_ranks[at], none)
            rank = np.append(rank, none)
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            least = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(word))))
            over = least == none
            if over.any():
                done.append((word[over], token[over]))
                token, word, rank, least = token[~over], word[~over], rank[~over], least[~over]
                if not len(token):
                    break
            hit = np.flatnonzero(rank == least)
            # In a run such as a a a the pairs overlap: the first, third, ... of each run of hits are merged.
            run = np.append(True, np.diff(hit) != 1)
            odd = (np.arange(len(hit)) - np.flatnonzero(run)[np.cumsum(run) - 1]) % 2
            hit = hit[odd == 0]
            token[hit] = self.made[rank[hit]]
            keep = np.ones(len(token), bool)
            keep[hit + 1] = False
            token, word = token[keep], word[keep]
        word, token = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(word, kind="stable")
        return [x.tolist() for x in np.split(token[order], np.cumsum(np.bincount(word, minlength=len(words)))[:-1])]

    def start(self, word: str) -> list[int]:
        return [self.vocab[c] for c in word[:-1]] + [self.vocab[word[-1] + END]]

    def _prove(self) -> np.ndarray:
        """Whether BPE makes each token of its own text; tokens of which it doesn't are never accepted unmerged."""
        ids = list(self.vocab.values())
        parts = [self.start(t[: -len(END)]) if t.endswith(END) and len(t) > len(END) else [self.vocab[c] for c in t] for t in self.vocab]
        sound = np.zeros(self.n, bool)
        for i, got in zip(ids, self.merge(parts)):
            sound[i] = got == [i]
        return sound

    # speculate

    def propose(self, word: str) -> list[int]:
        full, at, out, vocab, longest = word + END, 0, [], self.vocab, self.longest
        n, last = len(full), len(word)
        while at < last:
            most = longest.get(full[at : at + 2], 1) if at + 1 < last else n - at
            if n - at <= most:
                found = vocab.get(full[at:])
                if found is not None:
                    out.append(found)
                    return out
            for to in range(min(last - 1, at + most), at, -1):
                found = vocab.get(full[at:to])
                if found is not None:
                    out.append(found)
                    at = to
                    break
            else:
                return []
        return out

    # verify

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether BPE leaves each pair of tokens as it is.

        Were the two merged together, some merge over the seam would come
        before the last merge on either side. So from the whole tokens inwards,
        a merge of the two at the seam counts if its rank is below the limit,
        the rank of the merge undone last; ties go to the left, which is merged
        first.
        """
        a, b = a.copy(), b.copy()
        good, open_ = np.ones(len(a), bool), np.arange(len(a))
        limit = np.full(len(a), np.iinfo(np.int64).max)
        while len(open_):
            x, y, lim = a[open_], b[open_], limit[open_]
            key = x * self.n + y
            at = np.minimum(np.searchsorted(self.merge_keys, key), len(self.merge_keys) - 1)
            bad = (self.merge_keys[at] == key) & (self.merge_ranks[at] < lim)
            good[open_[bad]] = False
            rx, ry = self.rank[x], self.rank[y]
            done = bad | ((rx < 0) & (ry < 0))
            undo_x = ~done & (rx > ry)
            undo_y = ~done & ~undo_x
            # Left of the seam an equal rank comes first; right of it a merge over the seam of equal rank comes first.
            limit[open_[undo_x]] = rx[undo_x]
            limit[open_[undo_y]] = ry[undo_y] + 1
            a[open_[undo_x]] = self.right[x[undo_x]]
            b[open_[undo_y]] = self.left[y[undo_y]]
            open_ = open_[~done]
        return good

    def learn(self, words: list[str]) -> list[bytes]:
        """The ids of each word as little-endian 32-bit integers."""
        if not words:
            return []
        signs = self.signs
        coded = [w if w.isascii() and w.isprintable() else "".join(map(signs.__getitem__, w.encode("utf-8"))) for w in words]
        proposed = [self.propose(c) for c in coded]
        length = np.array([len(t) for t in proposed])
        token = np.array([i for t in proposed for i in t], np.int64)
        word = np.repeat(np.arange(len(words)), length)
        bad = length == 0
        bad[word[~self.sound[token]]] = True
        seam = np.flatnonzero(word[:-1] == word[1:])
        pairs, at = np.unique(token[seam] * self.n + token[seam + 1], return_inverse=True)
        good = self.compatible(pairs // self.n, pairs % self.n)
        bad[word[seam[~good[at]]]] = True
        again = np.flatnonzero(bad).tolist()
        for k, t in zip(again, self.merge([self.start(coded[k]) for k in again])):
            proposed[k] = t
        ends = np.cumsum([4 * len(t) for t in proposed]).tolist()
        raw = np.array([i for t in proposed for i in t], "<u4").tobytes()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def split(self, text: str) -> list[str]:
        """Parts between white space, or words of the pattern where the text has unusual signs."""
        low = text.lower()
        if SAFE.fullmatch(text) and (low.isascii() or SAFE.fullmatch(low)):
            return low.split()
        import regex
        from tokenizers import Tokenizer

        self.normalizer = self.normalizer or Tokenizer.from_file(self.path).normalizer
        return regex.findall(EXACT, self.normalizer.normalize_str(text))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        parted, seen = [], set()
        for text in texts:
            parts = self.cut.split(text) if "<|" in text else [text]
            parted.append([(p, None if k % 2 else self.split(p)) for k, p in enumerate(parts) if p])
            for _, words in parted[-1]:
                if words:
                    seen.update(words)
        known = self.cache
        lacking = known.lacking(seen)
        # A part such as "word," is several words of the pattern; only single words are merged.
        cut = [[w] if w.isalpha() else FAST.findall(w) if SAFE.fullmatch(w) else [w] for w in lacking]
        words = list({w for c in cut for w in c})
        ids = dict(zip(words, self.learn(words)))
        known.young.update((w, ids[c[0]] if len(c) == 1 else b"".join(map(ids.__getitem__, c))) for w, c in zip(lacking, cut))
        get = known.young.__getitem__
        return [b"".join(np.array([self.special[p]], "<u4").tobytes() if words is None else b"".join(map(get, words)) for p, words in parts) for parts in parted]

    def decode(self, ids: bytes) -> str:
        """Tokens joined by spaces: the vocabulary has no decoder of its own."""
        return " ".join(map(self.text_of.__getitem__, memoryview(ids).cast("I")))


def encode_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per row of docs(doc_id, text): count and hash of the ids and hash of the decoded text."""
    ship(docs.sparkSession)
    path = path or public_tokenizers.path("word_bpe_49k.json")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        bpe = WordBpe(path)

        for doc_ids, texts in chunks(batches):
            got = bpe.encode(texts)
            columns = [pa.array(doc_ids, pa.int64()), pa.array([len(i) // 4 for i in got], pa.int64()), pa.array([hashlib.sha256(i).hexdigest() for i in got]), pa.array([hashlib.sha256(bpe.decode(i).encode()).hexdigest() for i in got])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text").mapInArrow(run, SCHEMA)


def op5_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"))
