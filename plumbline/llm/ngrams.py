"""Stupid-backoff scores from n-gram count tables that are partitioned by hash.

1. Documents are written to the shared folder in blocks of about block_chars.
2. Each block is exploded to its words, pairs and triples; equal ones are
   counted within the block, and their 64-bit hashes go, sorted and as packed
   differences, to the table partition that their first bits name.
3. A table partition adds the counts of all blocks: that is its part of the
   count table (count_table). What the blocks sent is partitioned alike, so it
   is joined to the table where it is, and each block gets the counts of what it
   sent, in the order sent.
4. Each block is scored token by token from these, and summed per document.

    S(w | u v) = c(u v w) / c(u v)   if c(u v w) >= min_count, else
                 a * S(w | v);  S(w | v) = c(v w) / c(v) if c(v w) >= min_count,
                 else a * c(w) / N
A min_count above 1 prunes the table: what stands in it less often counts as unseen.
The first token of a document is scored as a single word, the second as a pair,
without a penalty. Words: lower case, parted by spaces, tabs and line ends.

The table has as many partitions as the corpus asks for (table_chars for each);
an n-gram costs one entry for each block that holds it, however frequent it is.

Defined results
  null or empty text: no tokens, score 0, mean null; null doc_id: stays null
  repeated rows: counted and scored each; extra columns: ignored; no rows: no rows
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.blocks import load, texts_of, write_blocks
from plumbline.llm.common import ship, table, work_path

SCHEMA = "doc_id long, n_tokens long, log_score double, mean_log_score double"
_SPACE = str.maketrans("\t\n\r", "   ")


def words_of(text: str) -> list[str]:
    return [w for w in text.lower().translate(_SPACE).split(" ") if w]


def split_words(texts: list[str]):
    """All words of the texts, as words_of has them, and the text that each stands in: two Arrow arrays, no object for a word."""
    import pyarrow as pa
    import pyarrow.compute as pc

    parts = pc.split_pattern(pa.array([t.lower().replace("\t", " ").replace("\n", " ").replace("\r", " ") for t in texts], pa.large_string()), " ")
    words = parts.flatten()
    real = pc.not_equal(words, "")
    return words.filter(real), pc.list_parent_indices(parts).filter(real)


def count_tokens(texts: list[str]) -> int:
    return len(split_words(texts)[0])


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def hashes(texts: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Tokens per text; the hashes of the words, pairs and triples that end at each token (triples from a text's third token on, and so on)."""
    import xxhash

    flat, text = split_words(texts)
    count = np.bincount(text.to_numpy(zero_copy_only=False), minlength=len(texts)).astype(np.int64)
    if not len(flat):
        return count, [np.zeros(0, np.uint64)] * 3
    coded = flat.dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    one = np.array([xxhash.xxh3_64_intdigest(w.encode("utf-8")) for w in coded.dictionary.to_pylist()], np.uint64)[code]
    place = np.arange(len(flat)) - np.repeat(np.cumsum(count) - count, count)
    two = mix(one[:-1] * np.uint64(0xD6E8FEB86659FD93) + one[1:])
    three = mix(two[:-1] * np.uint64(0xA0761D6478BD642F) + one[2:])
    return count, [one, two[place[1:] >= 1], three[place[2:] >= 2]]


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted hashes as differences, byte plane by byte plane, of which empty ones take no room."""
    planes = np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    used = bytes(int(p.any()) for p in planes)
    return used + b"".join(planes[k].tobytes() for k in range(8) if used[k])


def unpack_keys(raw: bytes, n: int) -> np.ndarray:
    planes, at = np.zeros((8, n), np.uint8), 8
    for k in range(8):
        if raw[k]:
            planes[k] = np.frombuffer(raw, np.uint8, n, at)
            at += n
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(counts.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpack_counts(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(raw), np.uint8).reshape(8, -1).T).view("<u8").ravel().astype(np.int64)


def sent(path: str, blocks: Iterator, bits: int) -> Iterator:
    """A row (part, ngram, block, n, keys, counts) for each table partition that a block has anything for."""
    import pyarrow as pa

    for batch in blocks:
        for block in batch.column(0).to_pylist():
            rows = []
            for n, found in enumerate(hashes(texts_of(load(path, block)))[1]):
                keys, counts = np.unique(found, return_counts=True)
                parts = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
                edge = np.flatnonzero(np.append(True, parts[1:] != parts[:-1])) if len(keys) else np.zeros(0, np.int64)
                for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(keys)]):
                    rows.append((int(parts[a]), n, block, b - a, pack_keys(keys[a:b]), pack_counts(counts[a:b])))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            for i in range(0, len(rows), 64):
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows[i : i + 64]], kind) for k, kind in enumerate(kinds)], ["part", "ngram", "block", "n", "keys", "counts"])


def entries_of(group) -> tuple[list[int], np.ndarray, np.ndarray]:
    """How many n-grams each block sent to a table partition, their hashes and their counts."""
    sizes = group.column("n").to_pylist()
    keys = np.concatenate([unpack_keys(k.as_py(), n) for k, n in zip(group.column("keys"), sizes)])
    return sizes, keys, np.concatenate([unpack_counts(c.as_py()) for c in group.column("counts")])


def totals(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes with the sums of their counts: a partition of the count table."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    return ranked[first], np.add.reduceat(counts[order], first)


def answered(group):
    """Per block the corpus counts of what it sent to this table partition: its n-grams joined to the count table."""
    import pyarrow as pa

    sizes, keys, counts = entries_of(group)
    distinct, total = totals(keys, counts)
    ends = np.cumsum(sizes).tolist()
    found = [total[np.searchsorted(distinct, keys[a:b])] for a, b in zip([0, *ends], ends)]
    return pa.table({"block": group.column("block"), "ngram": group.column("ngram"), "part": group.column("part"), "counts": pa.array([pack_counts(f) for f in found], pa.binary())})


def tabled(group):
    """A table partition as rows (ngram, hash, n)."""
    import pyarrow as pa

    distinct, total = totals(*entries_of(group)[1:])
    return pa.table({"ngram": pa.array([group.column("ngram")[0].as_py()] * len(distinct), pa.int32()), "hash": pa.array(distinct.view(np.int64)), "n": pa.array(total)})


def scored(path: str, group, total: int, penalty: float, min_count: int):
    """The documents of a block, from its answers."""
    import pyarrow as pa

    block = group.column("block")[0].as_py()
    rows = load(path, block)
    count, found = hashes(texts_of(rows))
    answers: dict[int, dict[int, bytes]] = {0: {}, 1: {}, 2: {}}
    for n, part, raw in zip(group.column("ngram").to_pylist(), group.column("part").to_pylist(), group.column("counts").to_pylist()):
        answers[n][part] = raw
    times = []
    for n, keys in enumerate(found):
        known = [unpack_counts(answers[n][p]) for p in sorted(answers[n])]
        times.append((np.concatenate(known) if known else np.zeros(0, np.int64))[np.unique(keys, return_inverse=True)[1]])
    tokens = int(count.sum())
    place = np.arange(tokens) - np.repeat(np.cumsum(count) - count, count)
    one, two, three = times[0].astype(float), np.zeros(tokens), np.zeros(tokens)
    two[place >= 1], three[place >= 2] = times[1], times[2]
    before = np.append(1.0, one[:-1])
    pair_before = np.append(1.0, two[:-1])
    log_a = math.log(penalty)
    with np.errstate(divide="ignore", invalid="ignore"):
        single = np.log(one / total)
        pair = np.where(two >= min_count, np.log(two / before), log_a + single)
        triple = np.where(three >= min_count, np.log(three / pair_before), log_a + pair)
    s = np.where(place == 0, single, np.where(place == 1, pair, triple))
    score = np.bincount(np.repeat(np.arange(len(count)), count), weights=s, minlength=len(count))
    mean = [round(float(x) / int(n), 4) if n else None for x, n in zip(score, count)]
    return pa.table({"doc_id": rows.column("doc_id"), "n_tokens": pa.array(count, pa.int64()), "log_score": pa.array(np.round(score, 4), pa.float64()), "mean_log_score": pa.array(mean, pa.float64())})


def exploded(docs: DataFrame, block_chars: int, table_chars: int) -> tuple[str, DataFrame, DataFrame | None, int]:
    """(folder, blocks, entries, tokens): docs(doc_id, text) written in blocks, and their n-grams partitioned by hash; no entries without rows."""
    spark = docs.sparkSession
    ship(spark)
    path = work_path(spark, "ngram-blocks")
    blocks = write_blocks(docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text"), path, block_chars, count_tokens)
    n, chars, total = blocks.agg(F.count(F.lit(1)), F.sum("size"), F.sum("measure")).first()
    if not n:
        return path, blocks, None, 0
    bits = max(0, math.ceil(math.log2(max(1, chars / table_chars))))

    def send(batches: Iterator) -> Iterator:
        return sent(path, batches, bits)

    many = int(spark.conf.get("spark.sql.shuffle.partitions"))
    listed = blocks.select("block").repartition(min(n, max(many, n // 2)), "block")
    return path, blocks, listed.mapInArrow(send, "part long, ngram int, block long, n long, keys binary, counts binary"), total


def count_table(docs: DataFrame, block_chars: int = 8_000_000, table_chars: int = 16_000_000) -> DataFrame:
    """(ngram, hash, n): how often each word (0), pair (1) and triple (2) stands in docs, by its hash."""
    _, blocks, entries, _ = exploded(docs, block_chars, table_chars)
    schema = "ngram int, hash long, n long"
    return docs.sparkSession.createDataFrame([], schema) if entries is None else entries.groupBy("ngram", "part").applyInArrow(tabled, schema)


def backoff_scores(docs: DataFrame, penalty: float = 0.4, min_count: int = 1, block_chars: int = 8_000_000, table_chars: int = 16_000_000) -> DataFrame:
    """(doc_id, n_tokens, log_score, mean_log_score) of each row of docs(doc_id, text), by counts over all of docs."""
    path, blocks, entries, total = exploded(docs, block_chars, table_chars)
    if entries is None:
        return docs.sparkSession.createDataFrame([], SCHEMA)

    def score(group):
        return scored(path, group, total, penalty, min_count)

    answers = entries.groupBy("ngram", "part").applyInArrow(answered, "block long, ngram int, part long, counts binary")
    # A block without a token sends nothing and gets no answer: an empty one stands in, so that its documents stay.
    nothing = blocks.where("measure = 0").select("block", F.lit(0).alias("ngram"), F.lit(-1).cast("long").alias("part"), F.lit(pack_counts(np.zeros(0, np.int64))).alias("counts"))
    return answers.unionByName(nothing).groupBy("block").applyInArrow(score, SCHEMA)


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_scores(table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row_no, CAST(doc_id AS BIGINT) AS doc_id, string_split_regex(lower(coalesce(text, '')), '[ \t\n\r]+') AS parts FROM documents),
u AS (SELECT row_no, unnest(parts) AS w, generate_subscripts(parts, 1) AS pos FROM d),
p AS (SELECT row_no, w, row_number() OVER (PARTITION BY row_no ORDER BY pos) AS pos FROM u WHERE w <> ''),
t AS (SELECT row_no, pos, w, lag(w, 1) OVER x AS v, lag(w, 2) OVER x AS z FROM p WINDOW x AS (PARTITION BY row_no ORDER BY pos)),
c1 AS (SELECT w, count(*) AS n FROM t GROUP BY w),
c2 AS (SELECT v, w, count(*) AS n FROM t WHERE v IS NOT NULL GROUP BY v, w),
c3 AS (SELECT z, v, w, count(*) AS n FROM t WHERE z IS NOT NULL GROUP BY z, v, w),
j AS (
  SELECT t.row_no, t.pos, a.n AS n1, b.n AS n1v, c.n AS n2, e.n AS n2zv, f.n AS n3, (SELECT count(*) FROM t) AS total
  FROM t JOIN c1 a ON a.w = t.w LEFT JOIN c1 b ON b.w = t.v LEFT JOIN c2 c ON c.v = t.v AND c.w = t.w
  LEFT JOIN c2 e ON e.v = t.z AND e.w = t.v LEFT JOIN c3 f ON f.z = t.z AND f.v = t.v AND f.w = t.w),
s AS (
  SELECT row_no, CASE
    WHEN pos >= 3 AND n3 >= 1 THEN ln(n3 / n2zv)
    WHEN pos >= 2 AND n2 >= 1 THEN (CASE WHEN pos >= 3 THEN ln(0.4) ELSE 0 END) + ln(n2 / n1v)
    ELSE least(pos - 1, 2) * ln(0.4) + ln(n1 / total) END AS s
  FROM j),
g AS (SELECT row_no, count(*) AS n, sum(s) AS s FROM s GROUP BY row_no)
SELECT doc_id, coalesce(g.n, 0) AS n_tokens, round(coalesce(g.s, 0), 4) AS log_score, round(g.s / g.n, 4) AS mean_log_score
FROM d LEFT JOIN g USING (row_no)
"""
