from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from helpers import NASTY, nasty, none, write
from tokenizers import Tokenizer

from plumbline.llm import packing

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def words_set(text):
    w = re.sub(r"[\W_]+", " ", text.lower()).strip().split(" ")
    return frozenset(tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2)))


def test_stages_survive_nasty_rows_and_none(spark, tmp_path):
    write(spark.createDataFrame([(3, 1, 1), (7, 1, 0)], "doc_id long, quality int, toxic int"), tmp_path, "labels")
    for start, many in ((nasty(spark), len(NASTY)), (none(spark), 0)):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            path = f"{tmp_path}/{many}-{name}"
            stage(spark, docs, str(tmp_path)).write.parquet(path)
            docs = spark.read.parquet(path)
            if name != "best_fit_packing":
                assert docs.columns == columns
        assert docs.count() >= min(many, 1)


def test_each_stage_takes_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    (_, toxic), (_, near), (_, cut), (_, pack) = corpus_pipeline.STAGES
    first = toxic(spark, docs, sf_dir)
    from plumbline.llm import minhash

    rejected = {r.doc_id for r in docs.join(first, "doc_id", "left_anti").collect()}
    assert len(rejected) < docs.count() / 2
    second = near(spark, docs, sf_dir)
    kept = {r.doc_id for r in minhash.near_duplicates(docs).where("kept").collect()}
    assert {r.doc_id for r in second.collect()} == kept and len(kept) < docs.count()
    third = cut(spark, docs, sf_dir)
    assert third.count() == docs.count() and third.selectExpr("sum(length(text))").first()[0] < docs.selectExpr("sum(length(text))").first()[0]
    assert {r.doc_id for r in pack(spark, docs, sf_dir).select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def kept_by_brute_force(rows):
    """One row of each class of near copies: its least doc_id."""
    sets: dict = {}
    for i, t in rows:
        sets.setdefault(words_set(t), []).append(i)
    names = list(sets)
    parent = list(range(len(names)))

    def root(k):
        return k if parent[k] == k else root(parent[k])

    fragments = set()
    for a, x in enumerate(names):
        for b, y in enumerate(names):
            if a != b and len(x) <= len(y) and len(x & y) / len(x) >= 0.65:
                if len(x) < 0.65 * len(y):
                    fragments.add(a)
                else:
                    parent[root(a)] = root(b)
    classes: dict = {}
    for k in range(len(names)):
        if k not in fragments:
            classes.setdefault(root(k), []).extend(sets[names[k]])
    return {min(ids) for ids in classes.values()}


def cut_by_brute_force(texts, width=200):
    """The texts without their repeated windows; characters of which only some bytes are covered stay."""
    raw = [t.encode() for t in texts]
    seen = Counter(r[i : i + width] for r in raw for i in range(len(r) - width + 1))
    out = []
    for text, r in zip(texts, raw):
        gone = bytearray(len(r))
        for i in range(len(r) - width + 1):
            if seen[r[i : i + width]] > 1:
                gone[i : i + width] = b"\x01" * width
        at, kept = 0, []
        for c in text:
            n = len(c.encode())
            if not all(gone[at : at + n]):
                kept.append(c)
            at += n
        out.append("".join(kept))
    return out


def test_run_equals_brute_force(spark, tmp_path):
    rng = random.Random(12)
    vocabulary = ["".join(rng.choice("abcdefghé") for _ in range(rng.randint(3, 7))) for _ in range(400)]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage = some(60)
    texts = [some(rng.randint(60, 150)) for _ in range(40)]
    texts += [[*some(50), *passage, *some(60)] for _ in range(8)]
    texts += [[w if rng.random() > 0.05 else rng.choice(vocabulary) for w in t] for t in texts[:10] for _ in range(2)] + texts[:4]
    texts += [[*some(50), "zzidiot", "zzmoron", "zzidiot"] for _ in range(20)]
    rows = [(k, " ".join(t), "en", "s", 1) for k, t in enumerate(texts)]
    write(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), tmp_path, "documents")
    toxic = {k for k, t in enumerate(texts) if "zzidiot" in t}
    write(spark.createDataFrame([(k, 1, int(k in toxic)) for k in range(len(rows)) if k % 5 < 3], "doc_id long, quality int, toxic int"), tmp_path, "labels")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    clean = {r.doc_id: r.text for r in corpus_pipeline.STAGES[0][1](spark, docs, str(tmp_path)).collect()}
    assert not toxic & set(clean) and len(clean) >= 0.95 * (len(rows) - len(toxic))
    kept = sorted(kept_by_brute_force(list(clean.items())))
    cut = cut_by_brute_force([clean[i] for i in kept])
    assert 40 <= len(kept) <= 48 and sum(map(len, cut)) < sum(len(clean[i]) for i in kept)
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, text in zip(kept, cut):
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 0], "<u4")
        for k, (s, n) in enumerate(packing.cut(len(ids), 2048)):
            want[i, k, s, n, zlib.crc32(ids[s : s + n].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want


def test_rows_that_share_a_doc_id_keep_their_texts(spark, tmp_path):
    rng = random.Random(13)
    some = lambda: " ".join("".join(rng.choice("abcdef") for _ in range(5)) for _ in range(30))
    w, z, alone = some(), some(), some()
    rows = [(3, w), (5, w), (5, z), (7, z), (1, alone), (1, alone), (None, some()), (8, None), (9, "")]
    docs = spark.createDataFrame([(*r, "en", "s", 0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    write(spark.createDataFrame([], "doc_id long, quality int, toxic int"), tmp_path, "labels")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
    assert Counter(r.text or "" for r in docs.collect()) == Counter([w, z, alone, rows[6][1], ""])
