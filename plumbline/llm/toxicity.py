"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic documents carry a label into training; all other text is
unlabelled, toxic documents among it. From a bounded sample (n_positive,
n_unlabelled) a table of words and word beginnings is learnt, by how much more
often they occur in confirmed toxic documents than in unlabelled ones. Over a
document's strongest words, small numpy networks are then trained with the
class-prior-corrected, non-negative risk
    prior * R(positive as 1) + max(0, R(unlabelled as 0) - prior * R(positive as 0)).
The prior is the toxic share of all labelled documents that are not held out.
The networks are trained crosswise: the words of a sampled document are weighed
by a table made without its fold of the sample.

Scoring reads every whole text once and shuffles nothing. Labels, lang, source
and doc_id are no inputs of a score.

Defined results
  null or empty text: the score of a text without words
  null doc_id: scored, not held out; repeated rows: scored each
  no confirmed toxic document, or no words that tell them: all scores 0
  no rows: no rows
  labels that are null: unlabelled; contradicting labels of a doc_id: toxic
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import chunks, materialise, ship, table

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
FOLDS, PSEUDO, LEAST, STRONG = 4, 4.0, 0.7, 1.5
STRIP = ".,;:!?\"'()[]{}<>*&%$#|-_/\\=+~`«»“”‘’„…"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def parts_of(word: str) -> list[str]:
    """A word as features: itself and its beginnings of four to six letters."""
    return [word, *(f"{word[:k]}-" for k in (4, 5, 6) if len(word) > k)]


def words_of(text: str) -> set[str]:
    return {w for w in (x.strip(STRIP) for x in set(text.lower().split())) if w}


@dataclass
class Weights(dict):
    """word -> the largest log ratio of its features, 0 below LEAST; filled as words come, within a bound."""

    ratio: dict[str, float]
    most: int = 300_000

    def __missing__(self, raw: str) -> float:
        word = raw.strip(STRIP)
        got = max((self.ratio.get(f, 0.0) for f in parts_of(word)), default=0.0) if word else 0.0
        got = got if got >= LEAST else 0.0
        if len(self) >= self.most:
            self.clear()
        self[raw] = got
        return got

    def features(self, text: str) -> list[float]:
        words = set(text.lower().split())
        top = sorted(filter(None, map(self.__getitem__, words)), reverse=True)
        strong = sum(t >= STRONG for t in top)
        five = (top + [0.0] * 5)[:5]
        return [five[0], five[1], five[2], sum(five) / 5, math.log1p(len(top)), math.log1p(strong), 100 * strong / (1 + len(words)), math.log1p(len(words))]


@dataclass
class Model:
    ratio: dict[str, float] = field(default_factory=dict)
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    nets: list[tuple[np.ndarray, ...]] = field(default_factory=list)

    def predict(self, x: np.ndarray) -> np.ndarray:
        if not self.nets:
            return np.zeros(len(x))
        z = (x - self.mean) / self.scale
        return np.mean([1 / (1 + np.exp(-np.clip(forward(net, z)[1], -30, 30))) for net in self.nets], axis=0)


def forward(net: tuple[np.ndarray, ...], z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    w, b, v, c = net
    h = np.tanh(z @ w + b)
    return h, h @ v + c


def gradient(net: tuple[np.ndarray, ...], z: np.ndarray, h: np.ndarray, out: np.ndarray) -> list[np.ndarray]:
    """Of a loss whose derivative by the outputs is `out`."""
    w, b, v, c = net
    inner = np.outer(out, v) * (1 - h**2)
    return [z.T @ inner, inner.sum(0), h.T @ out, np.array(out.sum())]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def risks(net: tuple[np.ndarray, ...], positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[float, float]:
    """By the logistic loss: prior * R(positive as 1), and the estimate R(unlabelled as 0) - prior * R(positive as 0), which can fall below 0."""
    fp, fu = forward(net, positive)[1], forward(net, unlabelled)[1]
    return float(prior * np.logaddexp(0, -fp).mean()), float(np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean())


def risk_gradients(net: tuple[np.ndarray, ...], positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The gradients of the two risks."""
    hp, fp = forward(net, positive)
    hu, fu = forward(net, unlabelled)
    as_one = gradient(net, positive, hp, prior * (sigmoid(fp) - 1) / len(fp))
    as_none = [a - b for a, b in zip(gradient(net, unlabelled, hu, sigmoid(fu) / len(fu)), gradient(net, positive, hp, prior * sigmoid(fp) / len(fp)))]
    return as_one, as_none


def step_direction(net: tuple[np.ndarray, ...], positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> list[np.ndarray]:
    """What a step goes against. Where the estimated risk of negatives is below zero it has overfitted: the step then raises it."""
    as_one, as_none = risk_gradients(net, positive, unlabelled, prior)
    return [a + b for a, b in zip(as_one, as_none)] if risks(net, positive, unlabelled, prior)[1] >= 0 else [-b for b in as_none]


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, seed: int, hidden: int = 8, steps: int = 600, rate: float = 0.02, decay: float = 1e-3) -> tuple[np.ndarray, ...]:
    """A network trained by Adam on the non-negative risk."""
    rng = np.random.default_rng(seed)
    d = positive.shape[1]
    net = (rng.normal(0, 1 / math.sqrt(d), (d, hidden)), np.zeros(hidden), rng.normal(0, 1 / math.sqrt(hidden), hidden), np.array(math.log(prior / (1 - prior))))
    m, s = [np.zeros_like(p) for p in net], [np.zeros_like(p) for p in net]
    for t in range(1, steps + 1):
        new = []
        for k, (p, g) in enumerate(zip(net, step_direction(net, positive, unlabelled, prior))):
            g = g + decay * p
            m[k] = 0.9 * m[k] + 0.1 * g
            s[k] = 0.999 * s[k] + 0.001 * g * g
            new.append(p - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8))
        net = tuple(new)
    return net


def _count(batches: Iterator) -> Iterator:
    """(feature, fold, p, u): in how many confirmed toxic and unlabelled documents of a fold a feature stands."""
    import pyarrow as pa

    counts: dict[tuple[int, bool], Counter] = {(f, p): Counter() for f in range(FOLDS) for p in (True, False)}
    for batch in batches:
        for positive, fold, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            counts[fold, positive].update({f for w in words_of(text.as_py() or "") for f in parts_of(w)})
    features: set[str] = set().union(*(counts[f, True] for f in range(FOLDS)))  # those of unlabelled documents alone have no say
    for fold in range(FOLDS):
        names = [f for f in features if counts[fold, True][f] or counts[fold, False][f]]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([fold] * len(names), pa.int32()), pa.array([counts[fold, True][f] for f in names], pa.int64()), pa.array([counts[fold, False][f] for f in names], pa.int64())], ["feature", "fold", "p", "u"])


def ratios(features: list[str], p: np.ndarray, u: np.ndarray, n_p: int, n_u: int) -> dict[str, float]:
    """Log ratios of at least LEAST. Both sides are given PSEUDO documents with the feature, so that rare ones are held back."""
    r = np.log((p + PSEUDO) / (u * (n_p / max(1, n_u)) + PSEUDO))
    return {features[k]: float(r[k]) for k in np.flatnonzero(r >= LEAST)}


def learn(docs: DataFrame, labels: DataFrame, n_positive: int = 4000, n_unlabelled: int = 8000, default_prior: float = 0.1, ensemble: int = 3) -> Model:
    """Trains on at most n_positive + n_unlabelled documents, picked by a hash of doc_id."""
    spark = docs.sparkSession
    ship(spark)
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")).where(~held_out(F.col("doc_id")))
    n, toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not toxic:
        return Model()
    prior = min(0.9, max(0.001, toxic / n)) if n else default_prior
    order = F.xxhash64("doc_id", F.lit(7))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chosen_p = known.where("toxic = 1").select("doc_id").orderBy(order, "doc_id").limit(n_positive).withColumn("positive", F.lit(True))
    chosen_u = docs.select("doc_id").where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).orderBy(order, "doc_id").limit(n_unlabelled).withColumn("positive", F.lit(False))
    chosen = chosen_p.unionByName(chosen_u).dropDuplicates(["doc_id", "positive"])
    # chosen holds at most n_positive + n_unlabelled ids: broadcasting it has that bound.
    fold = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(FOLDS)).cast("int")
    # Copies would make their rare words look like signs: of sampled texts with the same least run of words, mostly copies, one is taken.
    picked = docs.join(F.broadcast(chosen), "doc_id").withColumn("w", F.split(F.lower(F.coalesce("text", F.lit(""))), " "))
    least = F.array_min(F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - 2, F.lit(1))), lambda i: F.xxhash64(F.slice("w", i, 3))))
    picked = picked.groupBy("positive", least.alias("sketch")).agg(F.min("doc_id").alias("doc_id"), F.min_by("text", F.struct("doc_id", "text")).alias("text"))
    sample = materialise(picked.select("positive", fold.alias("fold"), "text").repartition(8), "toxicity-sample")
    sizes = {(r.fold, r.positive): r["count"] for r in sample.groupBy("fold", "positive").count().collect()}
    n_p, n_u = (np.array([sizes.get((f, p), 0) for f in range(FOLDS)]) for p in (True, False))
    counted = sample.mapInArrow(_count, "feature string, fold int, p long, u long").groupBy("feature").pivot("fold", list(range(FOLDS))).agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
    total = sum((F.coalesce(F.col(f"{f}_p"), F.lit(0)) for f in range(FOLDS)), F.lit(0))
    # Bounded by the sample: each feature stands in two of its confirmed documents at least.
    rows = counted.where(total >= 2).collect()
    features = [r.feature for r in rows]
    p, u = (np.array([[r[f"{f}_{k}"] or 0 for f in range(FOLDS)] for r in rows], np.float64).reshape(-1, FOLDS) for k in "pu")
    found = ratios(features, p.sum(1), u.sum(1), n_p.sum(), n_u.sum())
    if not found:
        return Model()
    crossed = [ratios(features, p.sum(1) - p[:, f], u.sum(1) - u[:, f], n_p.sum() - n_p[f], n_u.sum() - n_u[f]) for f in range(FOLDS)]
    data = np.array([(r.positive, *r.x) for r in _featurise(sample, crossed).collect()], np.float64).reshape(-1, 9)
    positive, unlabelled = data[data[:, 0] == 1, 1:], data[data[:, 0] == 0, 1:]
    if not len(positive) or not len(unlabelled):
        return Model()
    mean, scale = unlabelled.mean(0), unlabelled.std(0) + 1e-6
    zp, zu = (positive - mean) / scale, (unlabelled - mean) / scale
    return Model(found, mean, scale, [fit_nnpu(zp, zu, prior, seed) for seed in range(ensemble)])


def _featurise(sample: DataFrame, tables: list[dict[str, float]]) -> DataFrame:
    """(positive, x) of sample(positive, fold, text), each fold by its own table."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        weights = [Weights(t) for t in tables]
        for batch in batches:
            x = [weights[fold].features(t.as_py() or "") for fold, t in zip(batch.column(1).to_pylist(), batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["positive", "x"])

    return sample.mapInArrow(run, "positive boolean, x array<double>")


def score(docs: DataFrame, model: Model, threshold: float = 0.3, keep: bool = False) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row; keep: with its other columns, as they came."""
    ship(docs.sparkSession)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        weights = Weights(model.ratio)
        for ids, texts in chunks(batches):
            got = model.predict(np.array([weights.features(t) for t in texts]).reshape(-1, 8))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(got, pa.float64())], ["doc_id", "score"])

    def run_rows(batches: Iterator) -> Iterator:
        import pyarrow as pa

        weights = Weights(model.ratio)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            got = model.predict(np.array([weights.features(t.as_py() or "") for t in batch.column(at)]).reshape(-1, 8))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.float64())], [*batch.schema.names, "_score"])

    if keep:
        from pyspark.sql.types import DoubleType, StructType

        return docs.mapInArrow(run_rows, StructType([*docs.schema.fields]).add("_score", DoubleType()))
    scored = docs.selectExpr("cast(doc_id as long) as doc_id", "cast(text as string) as text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, learn(docs, table(spark, sf_dir, "labels")))
