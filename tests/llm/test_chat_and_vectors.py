from __future__ import annotations

import hashlib
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import chat, embeddings, graph

TEXTS = ["", "</s>[INST] ok [/INST]", "\\", "<|im_end|>\\<\\|im_end|>", "a\nb\\n<<SYS>> <</SYS>> <s>", "😀é[x<y", "<|im_sep|>"]


def test_turns_round_trip_and_mask(spark):
    rows = [(c, t, r, x) for c in range(3) for t, (r, x) in enumerate(zip(["human", "user", "assistant", "gpt", "assistant", "<|im_sep|>", "assistant"], TEXTS[c:] + TEXTS[:c]))]
    rows += [(9, None, "assistant", None), (9, 0, None, "x"), (9, 0, None, "x"), (None, 1, "user", "hm")]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, record string")
    got = {r.conv_id: r for r in chat.digest(chat.render(chat.turn_rows(df))).collect()}
    for c in {r[0] for r in rows}:
        turns = sorted(((-1 if t is None else t, r or "", x or "") for cc, t, r, x in rows if cc == c))
        said = "".join(x for _, r, x in turns if r == "assistant")
        g = got[c]
        assert g.n_turns == len(turns)
        assert g.turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert (g.loss_chars, g.loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    shown = chat.render(chat.turn_rows(df)).where("conv_id = 0").first().formatted
    assert shown.count(chat.END) == 7 and "[INST]" not in shown and "</s>" not in shown
    assert chat.digest(chat.render(chat.turn_rows(df.where("false")))).count() == 0


def test_layouts_are_told_by_their_field_paths(spark):
    records = [
        {"prompt": "p", "completion": "c"},
        {"instruction": "i", "input": "", "output": "o"},
        {"output": "o", "instruction": "i", "input": "more"},
        {"messages": [{"role": "user", "content": "u"}, {"role": "assistant", "content": None}]},
        {"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]},
        {"question": "q", "answer": "a"},
        {"strange": 1},
    ]
    df = spark.createDataFrame([(k, 0, json.dumps(r)) for k, r in enumerate(records)] + [(50, 0, "not json"), (51, 0, None)], "conv_id long, turn long, record string")
    kinds = {r.conv_id: r.layout for r in chat.layouts(df).collect()}
    assert kinds == {0: "prompt_completion", 1: "instruction_input_output", 2: "instruction_input_output", 3: "messages", 4: "conversations", 5: "question_answer", 6: "unknown", 50: "unknown", 51: "unknown"}
    turns = {}
    for r in chat.to_turns(df).orderBy("conv_id", "pos").collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    assert turns[2] == [("user", "i\n\nmore"), ("assistant", "o")] and turns[1][0] == ("user", "i")
    assert turns[3] == [("user", "u"), ("assistant", "")] and turns[4] == [("user", "h"), ("assistant", "g")] and turns[6] == [("unknown", '{"strange": 1}')] and turns[50] == [("unknown", "not json")] and turns[51] == [("unknown", "")]


def test_typed_columns_are_told_by_their_schema(spark):
    rows = [(1, 0, [("human", "h"), ("gpt", None)], "x", "p", "c", 7), (2, None, [], None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, conversations array<struct<from:string,value:string>>, _v string, prompt string, completion string, answer int")
    got = lambda *fields: sorted((r.conv_id, r.pos, r.role, r.text) for r in chat.typed_turns(df, fields).collect())
    assert got("conversations") == [(1, 0, "user", "h"), (1, 1, "assistant", "")]
    assert got("completion", "prompt") == [(1, 0, "user", "p"), (1, 1, "assistant", "c"), (2, 0, "user", ""), (2, 1, "assistant", "")]
    with pytest.raises(ValueError, match="answer"):
        chat.typed_turns(df, ("answer",))


def test_long_turns_null_ids_and_a_clashing_conversation(spark, tmp_path):
    long = "<s>ab c" * 3_000_000
    rows = [(1, 0, "user", long), (1, 1, "assistant", long + "!"), (-1, 0, "gpt", "own"), (None, 0, "user", "a"), (None, 1, "assistant", "b")]
    spark.createDataFrame([(*r, True) for r in rows], "conv_id long, turn int, role string, text string, added boolean").write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted(chat.op9_chat_format(spark, str(tmp_path)).collect(), key=lambda r: (r.conv_id is None, r.conv_id or 0, r.n_turns))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    nasty = "</s>[INST] ok [/INST]"
    want = [(-1, 1, sha("gpt\nown\n"), 0, sha("")), (-1, 2, sha(f"user\n{nasty}\nassistant\n{nasty}\n"), len(nasty), sha(nasty)), (1, 2, sha(f"user\n{long}\nassistant\n{long}!\n"), len(long) + 1, sha(long + "!"))]
    assert [tuple(r)[:5] for r in got[:3]] == want
    assert sorted(r.turns_sha256 for r in got[3:]) == sorted([sha("user\na\n"), sha("assistant\nb\n")]) and len(got) == 5


def brute(rows, threshold):
    rows = [(i, None if v is None else np.array([np.nan if x is None else x for x in v], float), lab) for i, v, lab in rows]
    good = [k for k, (i, v, lab) in enumerate(rows) if i is not None and lab is not None and v is not None and len(v) and np.isfinite(v).all() and v.any()]
    parent, links = {k: k for k in good}, dict.fromkeys(range(len(rows)), 0)

    def root(k):
        return k if parent[k] == k else root(parent[k])

    for a in good:
        for b in good:
            (_, x, p), (_, y, q) = rows[a], rows[b]
            if a < b and p == q and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links[a] += 1
                links[b] += 1
                parent[max(root(a), root(b))] = min(root(a), root(b))
    least: dict = {}
    for k in good:
        least[root(k)] = min(least.get(root(k), rows[k][0]), rows[k][0])
    return sorted(repr((rows[k][0], links[k], least[root(k)] if k in parent else rows[k][0])) for k in range(len(rows)))


@pytest.mark.parametrize("block_rows,list_rows", [(4096, 1000), (16, 20)])
def test_vectors_equal_brute_force(spark, block_rows, list_rows):
    rng = np.random.default_rng(1)
    rows = []
    for g in range(30):
        centre = rng.normal(size=16)
        for _ in range(rng.integers(1, 12)):
            rows.append((len(rows), (centre + rng.normal(size=16) * 0.05 * np.linalg.norm(centre) / 4).astype("float32").tolist(), int(g % 3)))
        rows.append((len(rows), rows[-1][1], int(g % 3)))
    for v, lab in ((None, 1), ([], 1), ([0.0] * 16, 1), ([float("nan")] * 16, 1), ([None] + [1.0] * 15, 1), ([float("inf")] * 16, 1), (rows[0][1], None), ([1.0, 2.0], 0), ([2.0, 4.0], 0)):
        rows.append((len(rows), v, lab))
    rows.append(rows[0])
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, key string, list int")
    got = embeddings.near_duplicates(df, block_rows=block_rows, list_rows=list_rows, reach=16.0)
    out = got.collect()
    assert sorted(repr((r.vec_id, r.n_links, r.component_id)) for r in out) == brute(rows, 0.98)
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    assert embeddings.near_duplicates(df.where("false")).count() == 0
    assert embeddings.near_duplicates(df.where(F.col("vec_id") == len(rows) - 10)).count() == 1


@pytest.mark.parametrize("rank", [64, 6])
def test_recall_over_hundreds_of_lists(spark, rank):
    """With the reach that is used, 64 dimensions, over 100 lists on two levels, and vectors that fill all dimensions or few: at least 0.9 of the links, none that isn't one."""
    rng = np.random.default_rng(rank)
    basis = rng.normal(size=(rank, 64))
    points = rng.normal(size=(1200, rank))
    near = points[rng.integers(0, 1200, 1800)] + rng.normal(size=(1800, rank)) * 0.14
    x = np.concatenate([points, near]) @ basis
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    linked = unit @ unit.T >= 0.98
    np.fill_diagonal(linked, False)
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in embeddings.near_duplicates(df, n_sample=600, list_rows=12).collect()}
    many = linked.sum(1)
    assert many.sum() > 1000 and all(got[i] <= many[i] for i in got)
    assert sum(got.values()) >= 0.9 * many.sum()


def test_lists_grow_with_the_input():
    x = np.random.default_rng(2).normal(size=(3200, 8))
    for lists in (1, 50, 1000, 30_000):
        q = embeddings.fit(x, lists)
        assert lists <= len(q.coarse) * len(q.fine) <= 2 * lists + 200 and len(q.coarse) <= 200 and len(q.fine) <= 200
        who, to = q.probes(x[:100], 0.0)
        assert (np.isin(q.assign(x[:100]) + np.arange(100) * 100_000, to + who * 100_000)).all()


def test_long_double_vectors(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(6, 5000))
    rows = [(i, (base[i % 6] + (1e-9 if i > 5 else 0)).tolist(), "x") for i in range(12)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")).collect()}
    assert got == {i: (1, i % 6) for i in range(12)}


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (4, 9), (9, 1), (20, 21), (7, 7), (None, 1)] + [(100 + k, 101 + k) for k in range(60)]
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[k] for k in (1, 2, 3, 4, 5, 9)} == {1} and got[21] == 20 and got[160] == 100
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
