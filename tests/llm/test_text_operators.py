from __future__ import annotations

import hashlib
import io
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import LONG, NASTY, nasty, none
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plumbline.llm import blocks, licenses, media, minhash, ngrams, packing, suffix, toxicity, wordbpe
from plumbline.llm.bytebpe import ByteBpe

TEXTS = [r[1] or "" for r in NASTY]


@pytest.fixture(scope="module")
def fuzz():
    rng = random.Random(1)
    signs = "abcdeABC 1'\"\n\t<|>_é漢²ß  İΣσ́\x1c\xa0.,—½"
    return [*TEXTS, *("".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(400)), *(" ".join("".join(rng.choice("aehinorst") for _ in range(rng.randint(1, 30))) for _ in range(20)) for _ in range(100)), "<|endoftext|>x <|startoftext|> a", "aaaaaaaaaaaaaaaa " * 5]


def test_byte_bpe_equals_the_library(fuzz):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ours = ByteBpe(public_tokenizers.path("byte_bpe_50k.json"), most=50)
    for _ in range(2):
        got = [x for i in range(0, len(fuzz), 50) for x in ours.encode(fuzz[i : i + 50])]
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == [e.ids for e in t.encode_batch(fuzz, add_special_tokens=False)]


def test_word_bpe_equals_the_library(fuzz):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ours = wordbpe.WordBpe(public_tokenizers.path("word_bpe_49k.json"), most=50)
    got = [x for i in range(0, len(fuzz), 50) for x in ours.encode(fuzz[i : i + 50])]
    want = [e.ids for e in t.encode_batch(fuzz, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == want
    assert [ours.decode(x) for x in got] == [t.decode(i, skip_special_tokens=False) for i in want]


def test_pair_checks_agree_with_exact_merging():
    b = wordbpe.WordBpe(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(2)
    inner = [i for t, i in b.vocab.items() if not t.endswith("</w>") and b.sound[i]]
    pairs = np.array([(rng.choice(inner), rng.choice(inner)) for _ in range(2000)])
    exact = b.merge([[b.vocab[c] for c in b.text_of[x] + b.text_of[y]] for x, y in pairs.tolist()])
    assert b.compatible(pairs[:, 0], pairs[:, 1]).tolist() == [e == p for e, p in zip(exact, pairs.tolist())]


def test_encode_digests(spark):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = wordbpe.encode_digests(nasty(spark)).collect()
    want = []
    for r in NASTY:
        ids = t.encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert wordbpe.encode_digests(none(spark)).count() == 0


@pytest.mark.parametrize("size,bins,block", [(2048, 8192, 16384), (64, 3, 5)])
def test_packing_is_whole_and_gapless(spark, size, bins, block):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = packing.pack(nasty(spark), size=size, open_bins=bins, block=block).collect()
    at: dict = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values()) <= size
    want = Counter()
    for r in NASTY:
        ids = np.array([*t.encode(r[1] or "", add_special_tokens=False).ids, 0], "<u4")
        for k, (s, n) in enumerate(packing.cut(len(ids), size)):
            want[r[0], k, s, n, zlib.crc32(ids[s : s + n].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    assert packing.pack(none(spark)).count() == 0


def test_packing_wastes_little_however_the_input_is_cut_up(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for parts in (1, 64):
        used = packing.pack(docs.repartition(parts)).groupBy("sequence_id").agg({"length": "sum"}).collect()
        assert max(r[1] for r in used) <= 2048 and len(used) <= 1.01 * sum(r[1] for r in used) / 2048 + 1
    assert {r.packer for r in packing.pack(docs, part_pieces=100).selectExpr("sequence_id >> 32 as packer").distinct().collect()} == {0, 1, 2}


def test_packing_wastes_little():
    rng = random.Random(4)
    items = sorted((rng.randint(1, 2048) for _ in range(5000)), reverse=True)
    bins = packing.OpenBins(2048, 8192)
    for n in items:
        bins.put(n)
    assert bins.made <= 1.01 * max(sum(items) / 2048, sum(n > 1024 for n in items)) + 1
    few = packing.OpenBins(2048, 4)
    assert all(few.put(n) and few.count <= 4 for n in items)


def test_cut_shortens_the_first_piece_only():
    assert packing.cut(5, 8) == [(0, 5)] and packing.cut(8, 8) == [(0, 8)] and packing.cut(19, 8) == [(0, 3), (3, 8), (11, 8)]


def test_media_round_trip(spark):
    path = media.work_path(spark, "media-test")
    listed = media.write_archives(nasty(spark), path).collect()
    rows = media.digests(media.read_archives(spark, path, [r.archive for r in listed], rangebytes=300, batchbytes=100)).collect()
    want = []
    for r in NASTY:
        p = media.pad(r[1])
        want.append((r[0], len((r[1] or "").encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:])))
        assert len(p) % 576 == 0 and p and media.from_png(media.to_png(p)) == p
    assert sorted(repr(tuple(r)[:5]) for r in rows) == sorted(map(repr, want))
    assert media.write_archives(none(spark), media.work_path(spark, "media-none")).count() == 0


def test_a_damaged_member_is_retried_alone_and_then_named(spark, tmp_path):
    media.write_archives(nasty(spark).coalesce(1), f"file://{tmp_path}").collect()
    reader = media.ArchiveReader({"path": f"file://{tmp_path}", "retries": "1"})
    part = reader.partitions()[0]
    fs, _ = media.filesystem(reader.path)
    offset, length = reader.entries(fs, part)[3]
    tries = []

    class Flaky(list):
        def append(self, f):
            tries.append(f)
            super().append(f)

    with open(part.archive, "r+b") as f:
        f.seek(offset + length - 1)
        last = f.read(1)
        f.seek(offset + length - 1)
        f.write(bytes([last[0] ^ 1]))
    with pytest.raises(OSError, match=f"at {offset}"):
        reader.member(fs, part.archive, offset, length, Flaky())
    assert len(tries) == 2
    first = reader.entries(fs, part)[0]
    assert reader.member(fs, part.archive, *first, [])[0] == 1


def test_media_query_over_a_manifest(spark, tmp_path):
    nasty(spark).write.parquet(f"{tmp_path}/documents.parquet")
    got = media.op2_media_columns(spark, str(tmp_path)).collect()
    want = []
    for r in NASTY:
        p = media.pad(r[1])
        stored = media.to_png(p)
        x = np.frombuffer(p, np.uint8).astype(float)
        edges = [k * len(x) // 64 for k in range(65)]
        bits = "".join("1" if x[a:b].mean() > x.mean() else "0" for a, b in zip(edges, edges[1:]))
        want.append((r[0], len((r[1] or "").encode()), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]), len(stored), hashlib.sha256(stored).hexdigest(), f"{x.mean():.6f}:{x.std():.6f}:{int(bits, 2):016x}"))
        assert stored[:8] == b"\x89PNG\r\n\x1a\n" and stored[16:24] == (576).to_bytes(4, "big") + (len(p) // 576).to_bytes(4, "big")
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    none(spark).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert media.op2_media_columns(spark, f"{tmp_path}/none").count() == 0


def test_a_member_that_fails_for_a_while_is_read_in_the_end(spark, tmp_path):
    media.write_archives(nasty(spark).coalesce(1), f"file://{tmp_path}").collect()
    reader = media.ArchiveReader({"path": f"file://{tmp_path}", "retries": "2"})
    part = reader.partitions()[0]
    fs, _ = media.filesystem(reader.path)
    offset, length = reader.entries(fs, part)[3]
    right = reader.member(fs, part.archive, offset, length, [])
    opened = []

    class Flaky:
        """A file system that can't be reached at first, and then gives a file that breaks off."""

        def open_input_file(self, name):
            opened.append(name)
            if len(opened) == 1:
                raise OSError("no route to the store")
            return io.BytesIO(b"cut off") if len(opened) == 2 else fs.open_input_file(name)

    assert reader.member(Flaky(), part.archive, offset, length, []) == right and len(opened) == 3


def brute_repeats(texts, width):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + width] for r in raw for i in range(len(r) - width + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - width + 1):
            if seen[r[i : i + width]] > 1:
                gone[i : i + width] = True
        edges = np.count_nonzero(np.diff(np.concatenate([[0], gone, [0]]).astype(int)))
        out.append((len(r), int(gone.sum()), int(edges) // 2, hashlib.sha256(np.frombuffer(r, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def test_repeated_windows_of_random_segments():
    rng = random.Random(3)
    for trial in range(60):
        width = rng.choice([4, 9, 40])
        segments = [bytes(rng.choice(b"abc\x00" if trial % 5 == 0 else b"ab") for _ in range(rng.randint(width, 3 * width))) for _ in range(rng.randint(1, 9))]
        seen = Counter(s[i : i + width] for s in segments for i in range(len(s) - width + 1))
        for s, hit in zip(segments, suffix.repeated_windows(segments, width)):
            assert hit.tolist() == [seen[s[i : i + width]] > 1 for i in range(len(s) - width + 1)]


def test_segments_without_a_repeated_window_need_no_suffix_array(monkeypatch):
    rng = random.Random(8)
    lone = [bytes(rng.choice(b"abcd") for _ in range(rng.randint(40, 90))) for _ in range(30)]
    shared = bytes(rng.choice(b"abcd") for _ in range(50))
    segments = [lone[0], shared + lone[1], *lone[2:], lone[1] + shared]
    want = [b for b, hit in enumerate(suffix.repeated_windows(segments, 40)) if hit.any()]
    given = []
    real = suffix.repeated_windows
    monkeypatch.setattr(suffix, "repeated_windows", lambda some, width: given.extend(some) or real(some, width))
    columns = {"unit": [7] * 31, "block": list(range(31)), "first": [0] * 31, "wants": [True] * 31, "bytes": segments}
    assert sorted(suffix.search(pa.table(columns), 40).column("part").to_pylist()) == want == [1, 30]
    assert given == [segments[1], segments[30]]
    assert suffix.search(pa.table({k: v[2:5] for k, v in columns.items()}), 40).num_rows == 0


def test_segments_are_found_once(spark, monkeypatch):
    texts = ["x" * 300, "é漢" * 100, "", "short", *(" ".join(f"{i * k}" for i in range(90)) for k in range(9))]
    block = suffix.Block(texts, 50)
    again = suffix.Block(texts, 50, block.packed())
    for name in ("buf", "end", "first", "last", "anchor", "segment"):
        assert (getattr(block, name) == getattr(again, name)).all()
    assert "hasher" not in vars(again) and len(again.first) > 20


def test_anchors_are_spread_over_partitions(tmp_path):
    rng = random.Random(9)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(20_000)) for _ in range(10)]
    path = f"file://{tmp_path}"
    blocks.store(path, 0, [pa.RecordBatch.from_pydict({"doc_id": list(range(10)), "text": texts})])
    units = pa.RecordBatch.from_arrays([pa.array([0]), pa.array([[0]])], ["unit", "blocks"])
    rows = pa.Table.from_batches(suffix.send(path, iter([units]), 200, 3)).to_pylist()
    for kind in (0, 1):
        sizes = {r["part"]: r["n"] for r in rows if r["kind"] == kind}
        assert len(sizes) == 8 and max(sizes.values()) < 2 * sum(sizes.values()) / 8


@pytest.mark.parametrize("hot", [20_000, 1])
def test_suffix_dedup_equals_brute_force(spark, hot):
    rng = random.Random(5)
    words = ["aé", "bb", "漢", "dddd", "e"]
    passages = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(4)]
    texts = [" ".join([" ".join(rng.choice(words) for _ in range(rng.randint(0, 40))), rng.choice(passages), " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))]) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100, None), (101, ""), (0, texts[0]), (None, LONG[:700])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, block long").repartition(3)
    got = suffix.remove_repeats(df, width=50, hot=hot, block_bytes=2000, part_bytes=3000, part_entries=40).collect()
    want = [(r[0], *b) for r, b in zip(rows, brute_repeats([r[1] for r in rows], 50))]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_suffix_dedup_cuts_rows_at_characters(spark):
    got = suffix.remove_repeats(nasty(spark), cut=True)
    assert got.schema == nasty(spark).schema
    rows = got.collect()
    assert len(rows) == len(NASTY) and all((r.n_chars or 0) == len(r.text or "") for r in rows)
    assert suffix.remove_repeats(none(spark)).count() == 0 and suffix.remove_repeats(none(spark), cut=True).count() == 0
    two = spark.createDataFrame([(1, "x" + "é" * 40), (2, "yy" + "é" * 40)], "doc_id long, text string")
    assert sorted(r.text for r in suffix.remove_repeats(two, width=11, cut=True).collect()) == ["x", "yy"]


def test_words_are_split_without_an_object_for_each(fuzz, monkeypatch):
    for texts in (fuzz, TEXTS, ["", " \t\n"], []):
        want = [ngrams.words_of(t) for t in texts]
        words, text = ngrams.split_words(texts)
        assert words.to_pylist() == [w for ws in want for w in ws] and text.to_pylist() == [i for i, ws in enumerate(want) for _ in ws]
    want = [len(ngrams.words_of(t)) for t in fuzz]
    monkeypatch.delattr(ngrams, "words_of")
    count, found = ngrams.hashes(fuzz)
    assert count.tolist() == want and ngrams.count_tokens(fuzz) == sum(want)
    assert [len(f) for f in found] == [sum(max(0, n - k) for n in want) for k in range(3)]


@pytest.mark.parametrize("least", [1, 2])
def test_lm_scores_equal_brute_force(spark, least):
    import math

    rows = [("a b a b c", 1), ("a b a b c", 2), (None, 3), ("A\tB z", 4), ("", None), ("a", 1)]
    docs = [[w for w in (t or "").lower().replace("\t", " ").split(" ") if w] for t, _ in rows]
    c = [Counter(tuple(d[i : i + n]) for d in docs for i in range(len(d) - n + 1)) for n in (1, 2, 3)]
    total = sum(c[0].values())

    def s(gram):
        n = len(gram)
        if n == 1:
            return math.log(c[0][gram] / total)
        return math.log(c[n - 1][gram] / c[n - 2][gram[:-1]]) if c[n - 1][gram] >= least else math.log(0.4) + s(gram[1:])

    want = [(i, len(d), round(float(sum(s(tuple(d[max(0, k - 2) : k + 1])) for k in range(len(d)))), 4)) for (_, i), d in zip(rows, docs)]
    df = spark.createDataFrame([(i, t, 1) for t, i in rows], "doc_id long, text string, part long").repartition(3)
    for chars in (8_000_000, 4):
        got = ngrams.backoff_scores(df, min_count=least, block_chars=chars, table_chars=8 if chars == 4 else 16_000_000).collect()
        assert sorted(map(repr, [tuple(r)[:3] for r in got])) == sorted(map(repr, want))
        found = ngrams.count_table(df, block_chars=chars, table_chars=8 if chars == 4 else 16_000_000).collect()
        assert [sorted(r.n for r in found if r.ngram == k) for k in range(3)] == [sorted(x.values()) for x in c] and len({(r.ngram, r.hash) for r in found}) == len(found)
    assert ngrams.backoff_scores(none(spark)).count() == 0 and ngrams.backoff_scores(nasty(spark)).count() == len(NASTY)


def test_license_rules(spark):
    apache = " ".join(licenses.SENTENCES[k] for k in ("apache2-notice-long", "apache2-comply", "apache2-copy"))
    mit = "\n".join(licenses.SENTENCES[k] for k in ("mit-title", "mit-grant", "mit-keep"))
    rows = [(1, "Intro. Released under the MIT license! More."), (2, mit + "\nother words"), (3, apache), (4, None), (5, "no such thing"), (6, "license " * 5), (7, "Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0."), (None, "Released under the MIT License.")]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, ids string")).collect()}
    assert [got[k].license for k in (1, 2, 3, 4, 5, 6, 7, None)] == ["MIT", "MIT", "Apache-2.0", None, None, None, "Apache-2.0", "MIT"]
    assert got[2].rule == 3 and got[3].rule == 7 and got[7].licenses == "Apache-2.0,CC-BY-NC-4.0" and got[4].n_sentences == 0
    assert licenses.scan(none(spark)).count() == 0 and licenses.scan(nasty(spark)).count() == len(NASTY)
    for key, text in licenses.SENTENCES.items():
        one = licenses.scan(spark.createDataFrame([(1, f"Before.\n{text} After it.")], "doc_id long, text string")).first() if key in ("gpl2-free", "mpl2", "gpl-warranty") else None
        assert one is None or one.sentence_ids == key


@pytest.mark.parametrize("width,sign,end", [(72, "", "\n"), (72, " * ", "\n"), (60, "# ", "\r\n"), (40, "// ", "\n")])
def test_wrapped_licenses(spark, width, sign, end):
    import textwrap

    wrap = lambda ks: (end + sign.rstrip() + end).join((end).join(sign + x for x in textwrap.wrap(licenses.SENTENCES[k], width)) for k in ks)
    kept = [(k, rule) for k, (_, rule) in enumerate(licenses.RULES)]
    rows = [(k, "Some words" + end + wrap(rule) + end + "more words") for k, rule in kept] + [(100, "Released under the MIT\nLicense."), (101, "nothing is\nReleased under the MIT\n\nLicense."), (102, "in the public\ndomain: This is free and unencumbered software released into the public\ndomain.")]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: got[k].sentence_ids for k, _ in kept} == {k: ",".join(rule) for k, rule in kept}
    assert [got[k].license for k in (100, 101, 102)] == ["MIT", None, "Unlicense"]


def scanned(text):
    """Brute force: every run of lines of a sentence is looked up; of runs within each other, the longest counts."""
    out = []
    t = re.sub("[\x01\x02]", " ", text or "")
    t = re.sub(r"([.!?;:])(?:[ \t\r]+|\n)", "\\1\x01", t)
    for part in re.sub(r"\n(?:(?:(?!\n)[\W_])*\n)+", "\x01", t).split("\x01"):
        lines = [licenses.normal(x) for x in part.split("\n")]
        runs = [(i, j, licenses.KNOWN[" ".join(lines[i:j])]) for i in range(len(lines)) for j in range(i + 1, len(lines) + 1) if " ".join(lines[i:j]) in licenses.KNOWN]
        out += [k for i, j, k in runs if not any(a <= i and j <= b and b - a > j - i for a, b, _ in runs)]
    return ",".join(out)


LICENCE_TEXTS = {
    "MIT": """/*
 * Copyright (c) 2020 Somebody
 *
 * Permission is hereby granted, free of charge, to any person obtaining a copy
 * of this software and associated documentation files (the "Software"), to deal
 * in the Software without restriction, including without limitation the rights
 * to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
 * copies of the Software, and to permit persons to whom the Software is
 * furnished to do so, subject to the following conditions:
 *
 * The above copyright notice and this permission notice shall be included in all
 * copies or substantial portions of the Software.
 */""",
    "LGPL-2.1-or-later": """# This library is free software; you can redistribute it and/or
# modify it under the terms of the GNU Lesser General Public
# License as published by the Free Software Foundation; either
# version 2.1 of the License, or (at your option) any later version.
#
# This library is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY.""",
    "GPL-3.0-or-later": """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.""",
    "Zlib": """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:""",
    "ISC": """// Permission to use, copy, modify, and/or distribute this software for any
// purpose with or without fee is hereby granted, provided that the above
// copyright notice and this permission notice appear in all copies.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
}


def test_licences_as_files_have_them(spark):
    rng = random.Random(6)
    rows = list(LICENCE_TEXTS.items()) + [(f"{k}+", "int x;\n" + v + "\n\nmore") for k, v in LICENCE_TEXTS.items()]
    sentences = list(licenses.SENTENCES.values())
    for k in range(60):
        words = " ".join(rng.choice([rng.choice(sentences), "some words", "a heading", "x"]) for _ in range(rng.randint(1, 6))).split(" ")
        rows.append((str(k), "".join(w + rng.choice([" "] * 12 + ["\n", "\n * ", "\n\n"]) for w in words)))
    df = spark.createDataFrame([(k, name, t) for k, (name, t) in enumerate(rows)], "doc_id long, name string, text string")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert {k: got[k].sentence_ids for k in got} == {k: scanned(t) for k, (_, t) in enumerate(rows)}
    for k, (name, _) in enumerate(rows[: 2 * len(LICENCE_TEXTS)]):
        assert got[k].license == name.rstrip("+")


def words_set(text):
    import re

    w = re.sub(r"[\W_]+", " ", (text or "").lower()).strip().split(" ")
    return {tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))}


def test_near_duplicates(spark):
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(500)]
    base = [[rng.choice(vocabulary) for _ in range(120)] for _ in range(12)]
    rows, truth = [], {}
    for g, words in enumerate(base):
        for k in range(6 if g else 40):
            w = list(words)
            for at in rng.sample(range(120), 0 if k < 2 else 4):
                w[at] = rng.choice(vocabulary)
            truth[len(rows)] = g
            rows.append((len(rows), " ".join(w)))
    df = spark.createDataFrame([*rows, (1000, "few words"), (1001, "Few, words!"), (1002, None), (1003, ""), (None, "few words"), (1004, "other words")], "doc_id long, text string")
    got = {r.doc_id: r for r in minhash.near_duplicates(df).collect()}
    least: dict = {}
    for i, g in truth.items():
        least.setdefault(g, i)
    assert all(got[i].class_id == least[g] and got[i].kept == (i == least[g]) for i, g in truth.items())
    assert got[1001].class_id == 1000 and got[1003].class_id == 1002 and got[1004].kept and got[None].class_id == 1000 and not got[None].kept
    kept = minhash.keep_one(df).collect()
    assert len(kept) == 12 + 3 and df.columns == minhash.keep_one(df).columns
    assert minhash.near_duplicates(none(spark)).count() == 0
    assert minhash.near_duplicates(nasty(spark)).count() == len(NASTY)


def linked_texts(rows, containment):
    """Brute force: pairs of distinct texts (by their least doc_id) whose smaller set lies in the larger one."""
    least: dict = {}
    for i, t in rows:
        least.setdefault(" ".join(re.sub(r"[\W_]+", " ", t.lower()).split()), i)
    sets = {i: words_set(t) for t, i in least.items()}
    return {(i, k) for i in sets for k in sets if i < k and len(sets[i] & sets[k]) / min(len(sets[i]), len(sets[k])) >= containment}


@pytest.fixture(scope="module")
def copies_of_all_sizes(spark):
    """(rows, links by brute force, result): texts cut and changed to any degree, clusters, short texts."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    texts = []
    for n in (300, 90, 60, 40, 9, 7):
        for _ in range(4):
            base = [rng.choice(vocabulary) for _ in range(n)]
            texts += [base, base[: n * 4 // 5], base[: n // 2], base[n // 3 :], [*base, *rng.choices(vocabulary, k=n // 2)]]
            for share in (0.02, 0.05, 0.08, 0.1, 0.12):
                texts.append([rng.choice(vocabulary) if rng.random() < share else w for w in base])
    quoted = [rng.choice(vocabulary) for _ in range(12)]
    texts += [[*rng.choices(vocabulary, k=60), *quoted, *rng.choices(vocabulary, k=60)] for _ in range(6)] + [quoted, texts[0]]
    rng.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    return rows, linked_texts(rows, 0.65), got, [i for i, t in enumerate(texts) if t == quoted][0], [i for i, t in enumerate(texts) if len(t) == 132]


def test_far_sizes_link(copies_of_all_sizes):
    rows, links, got, _, _ = copies_of_all_sizes
    size = {i: len(words_set(t)) for i, t in rows}
    far = [(a, b) for a, b in links if max(size[a], size[b]) > 1.5 * min(size[a], size[b])]
    assert len(far) > 40 and all(got[a].n_links and got[b].n_links for a, b in far)
    for a, b in links:  # the smaller one of two goes, or both lie in one class
        assert got[a].class_id == got[b].class_id or not got[min(a, b, key=size.get)].kept or not got[max(a, b, key=size.get)].kept


def test_every_link_counts(copies_of_all_sizes):
    rows, links, got, _, _ = copies_of_all_sizes
    want = Counter(x for pair in links for x in pair)
    twins: dict = {}
    for i, t in rows:
        twins.setdefault(t, i)
    assert {i: got[i].n_links for i, _ in rows} == {i: want[twins[t]] for i, t in rows}


def test_short_near_copies_link(spark):
    df = spark.createDataFrame([(1, "aa bb cc dd ee ff gg"), (2, "aa bb cc dd ee ff hh"), (3, "aa bb xx yy zz ww vv")], "doc_id long, text string")
    got = {r.doc_id: r for r in minhash.near_duplicates(df).collect()}
    assert [got[k].class_id for k in (1, 2, 3)] == [1, 1, 3] and [got[k].n_links for k in (1, 2, 3)] == [1, 1, 0]


def test_runs_are_hashed_without_an_array_for_each(spark):
    sets = minhash.shingle_sets(nasty(spark))
    assert "slice(" not in sets._jdf.queryExecution().toString()
    words = minhash.named(nasty(spark)).select("id", F.split("t", " ").alias("w"))
    runs = words.select("id", F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - 2, F.lit(1)))).alias("i"), "w").select("id", F.expr("shiftrightunsigned(xxhash64(slice(w, i, 3)), 16)").alias("x"))
    want = {r.id: set(r.h) for r in runs.groupBy("id").agg(F.collect_set("x").alias("h")).collect()}
    assert {r.id: set(r.h) for r in sets.collect()} == want and all(r.n == len(want[r.id]) for r in sets.collect())


def test_a_quotation_makes_no_copies(copies_of_all_sizes):
    _, _, got, quoted, quoting = copies_of_all_sizes
    assert got[quoted].n_links == 6 and not got[quoted].kept and len({got[i].class_id for i in quoting}) == 6 and all(got[i].kept for i in quoting)


def test_tuning_reaches_its_recall():
    tuned = minhash.ensemble(0.65, 1.2, 0.95)
    assert len(tuned) == 4 and all(rows * bands <= 64 for rows, bands in tuned)
    for step, (rows, bands) in enumerate(tuned):
        t = 0.65 / (1 + min(1.2 ** (step + 1), 1 / 0.65) - 0.65)
        assert 1 - (1 - t**rows) ** bands >= 0.95


@pytest.fixture(scope="module")
def pairs_of_all_degrees(spark):
    """(sets, near pairs by brute force): texts changed to any degree and cut to any length."""
    rng = random.Random(31)
    texts = []
    for g in range(60):
        base = [f"{g}w{rng.randrange(10**6)}" for _ in range(120)]
        for share in (0.0, 0.02, 0.05, 0.08, 0.1, 0.12):
            t = [f"{g}x{rng.randrange(10**6)}" if rng.random() < share else w for w in base]
            texts.append(t[: rng.choice((120, 120, 100, 85, 40))])
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    sets = minhash.shared_sets(df, 3)
    sized = {r.id: (r.n, set(r.v)) for r in sets.collect()}
    alike = lambda a, b: len(a[1] & b[1]) / min(a[0], b[0])
    near = {(i, k) for i in sized for k in sized if i < k and min(sized[i][0], sized[k][0]) >= 0.65 * max(sized[i][0], sized[k][0]) and alike(sized[i], sized[k]) >= 0.65}
    return sets, near


def test_the_ensemble_finds_most_classes(spark, pairs_of_all_degrees):
    """What the bands alone join, against all near links: by far most; the exact join adds the rest."""
    sets, near = pairs_of_all_degrees
    found = minhash.checked(minhash.ensemble_pairs(sets, 0.65, 1.2, 0.95), sets, 0.65)
    component = {r.id: r.component for r in minhash.components(found).collect()}
    joined = sum(a in component and component.get(a) == component.get(b) for a, b in near)
    assert len(near) > 300 and joined >= 0.9 * len(near)


@pytest.mark.parametrize("recall,block", [(0.95, 512), (0.01, 3)])
def test_classes_equal_brute_force(spark, recall, block):
    """Classes are the components of the near links, whatever the ensemble misses; one row of each class stays, with its own text."""
    rng = random.Random(21)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    boiler = [rng.choice(vocabulary) for _ in range(30)]
    texts = []
    for g in range(14):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((5, 20, 60, 150)))] + (boiler if g % 2 else [])
        for _ in range(rng.choice((1, 4, 12))):
            texts.append([rng.choice(vocabulary) if rng.random() < rng.choice((0.0, 0.03, 0.08)) else w for w in base][: rng.choice((None, None, len(base) * 3 // 4))])
    rows = [(rng.choice((i, i // 2, None)), " ".join(t)) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (7, rows[0][1]), (7, "other words altogether here")]
    df = spark.createDataFrame([(*r, k, 1) for k, r in enumerate(rows)], "doc_id long, text string, k long, n_same int").repartition(3)
    names = [" ".join(re.sub(r"[\W_]+", " ", t.lower()).split()) for _, t in rows]
    sets = {t: words_set(t) for t in names}
    parent = {t: t for t in sets}

    def root(t):
        return t if parent[t] == t else root(parent[t])

    up: dict = {}
    for a in sets:
        for b in sets:
            if a != b and len(sets[a]) <= len(sets[b]) and len(sets[a] & sets[b]) / len(sets[a]) >= 0.65:
                if len(sets[a]) < 0.65 * len(sets[b]):
                    up[a] = max(up.get(a, (0, "")), (len(sets[b]), b))
                else:
                    parent[root(a)] = root(b)
    classes: dict = {}
    for t in sets:
        classes.setdefault(root(t), set()).add(t)
    whole = [c for c in classes.values() if not c <= up.keys()]
    got = minhash.near_duplicates(df, recall=recall, block=block).collect()
    assert len(got) == len(rows) and sum(r.kept for r in got) == len(whole)
    links = Counter(x for a in sets for b in sets if a < b and len(sets[a] & sets[b]) / min(len(sets[a]), len(sets[b])) >= 0.65 for x in (a, b))
    assert sorted(r.n_links for r in got) == sorted(links[t] for t in names)
    kept = minhash.keep_one(df, recall=recall, block=block).collect()
    of = {k: t for k, t in enumerate(names)}
    assert sorted(min(c) for c in whole) == sorted(min(next(c for c in whole if of[r.k] in c)) for r in kept)
    assert all(of[r.k] not in up and (r.doc_id, r.text) == rows[r.k] for r in kept)
    for r in kept:  # the least doc_id of the class's texts that are no fragments
        ids = [i for (i, _), t in zip(rows, names) if t in next(c for c in whole if of[r.k] in c) and t not in up]
        assert r.doc_id == min((i for i in ids if i is not None), default=None)


def test_rows_that_share_a_doc_id_lose_no_text(spark):
    w, z = "a b c d e f g h", "q r s t u v w x"
    df = spark.createDataFrame([(3, w), (5, w), (5, z), (7, z), (1, "one two three"), (1, "one two three"), (9, w + " i"), (9, w + " j")], "doc_id long, text string")
    assert sorted(map(tuple, minhash.keep_one(df).collect())) == [(1, "one two three"), (3, w), (5, z)]


def test_a_line_that_many_texts_quote_makes_no_row_for_each_pair(spark, monkeypatch):
    """keep_one needs to know which texts are fragments, not what all of them lie in."""
    rng = random.Random(41)
    word = lambda: f"w{rng.randrange(10**6)}"
    line = [word() for _ in range(40)]
    whole = [[word() for _ in range(60)] + line + [word() for _ in range(k)] for k in range(50)]
    parts = [line[:38] + [word() for _ in range(k % 7)] for k in range(40)]
    # Texts whose halves name different texts as the largest: the first lies in a third one too, the second in none.
    one, two, three, four = ([word() for _ in range(30)] for _ in range(4))
    halves = [one + two, three + four, *([word() for _ in range(n)] + h for n, h in ((200, one), (210, two), (200, three), (210, four), (90, one + two)))]
    texts = [" ".join(t) for t in [*whole, *parts, *halves]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made, write_table = [], minhash.materialise

    def counted(table, what):
        out = write_table(table, what)
        made.append((what, out.count()))
        return out

    monkeypatch.setattr(minhash, "materialise", counted)
    got = {r.doc_id for r in minhash.keep_one(df).collect()}
    assert max(n for what, n in made if what == "pairs") < 200  # of 40 x 50 far links
    sets = [words_set(t) for t in texts]
    fragments = {i for i, x in enumerate(sets) if any(len(x) < 0.65 * len(y) and len(x & y) / len(x) >= 0.65 for y in sets)}
    near = [(i, k) for i, x in enumerate(sets) for k, y in enumerate(sets) if i != k and 0.65 * len(y) <= len(x) <= len(y) and len(x & y) / len(x) >= 0.65]
    assert fragments == {*range(50, 90), 90} and all(fragments >= {i, k} for i, k in near)
    assert got == set(range(len(texts))) - fragments
    assert [r.kept for r in minhash.near_duplicates(df).orderBy("doc_id").collect()] == [i in got for i in range(len(texts))]


def test_toxicity_learns_and_survives(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(300)]
    bad = ["zzidiot", "zzmoron", "zztrash"]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 6 == 0
        w = [rng.choice(words) for _ in range(60)] + ([rng.choice(bad) for _ in range(4)] if toxic else [])
        rng.shuffle(w)
        rows.append((i, " ".join(w), None))
        if i % 5 < 2:
            labels.append((i, 1, int(toxic)))
    df = spark.createDataFrame([*rows, (None, None, 1), (1000, "", 2), (1001, LONG, 3)], "doc_id long, text string, positive int")
    lab = spark.createDataFrame([*labels, (5, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.score(df, toxicity.learn(df, lab)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 603 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    for i in range(600):
        assert by[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
    assert sum(by[i].predicted == (i % 6 == 0) for i in range(600)) >= 590
    kept = toxicity.score(df, toxicity.learn(df, lab), keep=True)
    assert kept.columns == [*df.columns, "_score"] and kept.count() == 603
    empty = toxicity.learn(df, lab.where("false"))
    assert {r.score for r in toxicity.score(df, empty).collect()} == {0.0}
    assert toxicity.score(none(spark), empty).count() == 0


def small_net(seed, scale=1.0):
    rng = np.random.default_rng(seed)
    net = tuple(np.array(scale * rng.normal(size=shape)) for shape in ((4, 3), (3,), (3,), ()))
    return net, rng.normal(0.5, 1, (7, 4)), rng.normal(0, 1, (11, 4))


def test_risk_gradients_equal_numeric_ones():
    net, positive, unlabelled = small_net(3)
    for which in (0, 1):
        found = toxicity.risk_gradients(net, positive, unlabelled, 0.3)[which]
        for k, part in enumerate(net):
            for at in np.ndindex(part.shape):
                def risk(by, k=k, at=at):
                    moved = [np.array(p) for p in net]
                    moved[k][at] += by
                    return toxicity.risks(tuple(moved), positive, unlabelled, 0.3)[which]

                assert abs((risk(1e-5) - risk(-1e-5)) / 2e-5 - found[k][at]) < 1e-7


def test_a_negative_estimate_is_raised():
    for seed in range(200):
        net, positive, unlabelled = small_net(seed, 3.0)
        one, none = toxicity.risks(net, positive, unlabelled, 0.6)
        moved = tuple(p - 1e-5 * g for p, g in zip(net, toxicity.step_direction(net, positive, unlabelled, 0.6)))
        after = toxicity.risks(moved, positive, unlabelled, 0.6)
        assert after[1] > none if none < 0 else sum(after) <= one + none
    assert any(toxicity.risks(*small_net(s, 3.0), 0.6)[1] < 0 for s in range(200)) and any(toxicity.risks(*small_net(s, 3.0), 0.6)[1] >= 0 for s in range(200))


def test_repeated_rows_score_alike(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.learn(docs, labels)
    twice = docs.unionByName(docs.select("doc_id", F.lit(None).cast("string").alias("text"), "lang", "source", "n_chars")).unionByName(docs)
    got = toxicity.score(twice, model).groupBy("doc_id").agg(F.count("*").alias("n"), F.countDistinct("score").alias("scores")).collect()
    assert all(r.n == 3 and r.scores <= 2 for r in got)
