"""Near-duplicate embeddings by product quantisation.

Vectors are compared only within a label. Two levels of centroids and the
codebooks of residual subspaces are fitted on a bounded sample (n_sample);
every vector is then indexed: it lies in the inverted list of its nearest
coarse centroid and of the fine one that is nearest to what is left, with a code
of the rest and the exact error of that code. There are as many fine centroids
as it takes for lists of about list_rows vectors, however many there are: the
number of lists grows with the input, as the product of the two levels. A
vector probes the lists that a neighbour within the threshold may lie in. In a
list, table look-ups give the distance to each code; those within the threshold
plus the code's error go to the exact cosine in double precision.

Sufficient probes: a neighbour of a vector q at distance r lies in the cell of c
only across the plane between c and q's own centroid; q lies
(|q-c|^2 - |q-own|^2) / 2|c-own| from that plane. On the second level the same
holds for what is left of q behind each coarse centroid that it probes. A
difference of length r that spreads over d dimensions reaches r/sqrt(d) along
one direction on average; cells within `reach` times that, but no more than r,
which is exact, are probed. d is measured: vectors that fill few dimensions of
their space have a small one (spread_dimensions).

Equal vectors are merged before, with their number. Lists are split into
blocks, so that a task holds block_rows stored and block_rows probing vectors.
A task returns no pairs, but each vector's number of links and a root among the
vectors that it saw linked; stars over these give the components.

Defined results
  null label or vec_id; null, empty or zero vectors, or with null or non-finite
  parts: a row without links, its own component (a null vec_id: null, not kept)
  vectors of other lengths: compared only with vectors of their own length
  repeated rows: each is a vector; extra columns: ignored; no rows: no rows
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import materialise, ship, table
from plumbline.llm.graph import components

INDEX = "label string, list long, probing boolean, id long, weight long, vector binary, code binary, error float"


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances."""
    return np.maximum((x**2).sum(1)[:, None] - 2 * x @ centres.T + (centres**2).sum(1), 0)


def gaps(centres: np.ndarray) -> np.ndarray:
    """Distances between centroids."""
    return np.sqrt(np.maximum(distances(centres, centres), 1e-12))


@dataclass
class Quantiser:
    coarse: np.ndarray  # coarse centroids x d
    fine: np.ndarray  # fine centroids x d, of what is left behind any coarse one
    books: list[np.ndarray]  # per subspace: codes x its width
    cuts: list[int]

    def __post_init__(self):
        self.gap = gaps(self.coarse), gaps(self.fine)

    def centre(self, at: np.ndarray) -> np.ndarray:
        """What the lists of these numbers lie around."""
        return self.coarse[at // len(self.fine)] + self.fine[at % len(self.fine)]

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The list of each vector."""
        own = distances(x, self.coarse).argmin(1)
        return own * len(self.fine) + distances(x - self.coarse[own], self.fine).argmin(1)

    def probes(self, x: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
        """(vector, list) of each cell that lies within the margin of a vector, its own first among these."""

        def near(y: np.ndarray, centres: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            d = distances(y, centres)
            own = d.argmin(1)
            hit = (d - d[np.arange(len(y)), own][:, None]) / (2 * gap[own]) <= margin
            hit[np.arange(len(y)), own] = True
            return np.nonzero(hit)

        who, to = near(x, self.coarse, self.gap[0])
        at, fine = near(x[who] - self.coarse[to], self.fine, self.gap[1])
        return who[at], to[at] * len(self.fine) + fine

    def encode(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of what is left, and the exact distance between each vector and what its code stands for."""
        rest = x - self.centre(own)
        codes = np.empty((len(x), len(self.books)), np.uint8)
        error = np.zeros(len(x))
        for k, book in enumerate(self.books):
            part = rest[:, self.cuts[k] : self.cuts[k + 1]]
            d = (part**2).sum(1)[:, None] - 2 * part @ book.T + (book**2).sum(1)
            codes[:, k] = d.argmin(1)
            error += ((part - book[codes[:, k]]) ** 2).sum(1)
        return codes, np.sqrt(error)


def kmeans(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    centre = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = np.concatenate([((centre**2).sum(1) - 2 * x[i : i + 8192] @ centre.T).argmin(1) for i in range(0, len(x), 8192)])
        count = np.bincount(own, minlength=len(centre))
        total = np.zeros_like(centre)
        np.add.at(total, own, x)
        centre[count > 0] = total[count > 0] / count[count > 0, None]
    return centre


def fit(sample: np.ndarray, lists: int, subspaces: int = 8, codes: int = 64, seed: int = 0) -> Quantiser:
    """A quantiser with about `lists` lists; each level has no more centroids than a sixteenth of the sample."""
    rng = np.random.default_rng(seed)
    most = max(1, len(sample) // 16)
    coarse = kmeans(sample, min(lists, most), 8, rng)
    rest = sample - coarse[distances(sample, coarse).argmin(1)]
    n_fine = min(math.ceil(lists / len(coarse)), most)
    fine = kmeans(rest, n_fine, 6, rng) if n_fine > 1 else np.zeros((1, sample.shape[1]))
    d = sample.shape[1]
    cuts = [round(k * d / min(subspaces, d)) for k in range(min(subspaces, d) + 1)]
    q = Quantiser(coarse, fine, [], cuts)
    rest = sample - q.centre(q.assign(sample))
    q.books = [kmeans(rest[:, a:b], codes, 6, rng) for a, b in zip(cuts, cuts[1:])]
    return q


def spread_dimensions(rest: np.ndarray) -> float:
    """Over how many dimensions vectors spread: the square of the sum of their variances along the main axes, over the sum of squares."""
    variance = np.linalg.eigvalsh(rest.T @ rest / max(1, len(rest)))
    return max(1.0, float(variance.sum() ** 2 / max((variance**2).sum(), 1e-300)))


def connected(a: np.ndarray, b: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """The forest `parent` with the edges (a, b) added: every node points to the least of its tree."""
    while True:
        while (parent[parent] != parent).any():
            parent = parent[parent]
        x, y = parent[a], parent[b]
        apart = x != y
        if not apart.any():
            return parent
        np.minimum.at(parent, np.maximum(x, y)[apart], np.minimum(x, y)[apart])


def near_pairs(q: Quantiser, at: int, stored: tuple, probing: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(probing vector, stored vector) in stretches: the pairs with a cosine of at least the threshold."""
    vectors, codes, errors = stored
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6
    limit = (reach + errors) ** 2
    rest = probing - q.centre(np.array([at]))
    # Half of each product makes the tables small enough to stay in cache for a block of probes.
    for i in range(0, len(probing), 64):
        estimate = np.zeros((len(rest[i : i + 64]), len(vectors)), np.float32)
        for k, book in enumerate(q.books):
            part = rest[i : i + 64, q.cuts[k] : q.cuts[k + 1]]
            look = ((part**2).sum(1)[:, None] - 2 * part @ book.T + (book**2).sum(1)).astype(np.float32)
            estimate += look[:, codes[:, k]]
        row, found = np.nonzero(estimate <= limit.astype(np.float32) + 1e-4)
        for j in range(0, len(row), 16384):
            r, f = row[j : j + 16384], found[j : j + 16384]
            keep = np.einsum("ij,ij->i", vectors[f], probing[i + r]) >= threshold
            yield i + r[keep], f[keep]


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, n_sample: int = 20_000, list_rows: int = 1000, reach: float = 4.0, block_rows: int = 4096) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of vectors(vec_id, embedding, label)."""
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"), F.col("label").cast("string").alias("label"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    good = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & finite, F.lit(False))
    keyed = rows.select("vec_id", F.when(good, F.sha2(F.concat_ws("|", F.size("v"), "label", F.to_json("v")), 256)).alias("key"), "label", "v")
    merged = keyed.where("key is not null").groupBy("key").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight"), F.first("label").alias("label"), F.first("v").alias("v"))
    merged = materialise(merged.withColumn("dim", F.size("v")), "vectors")
    dims = [(r.dim, r.n) for r in merged.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()]
    linked = None
    for dim, n in dims:
        one = _linked_of(merged.where(F.col("dim") == dim), dim, n, threshold, n_sample, list_rows, reach, block_rows)
        linked = one if linked is None else linked.union(one)
    ids = keyed.select("vec_id", "key")
    if linked is None:
        return ids.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    linked = materialise(linked, "links")
    found = components(linked.select(F.col("id").alias("a"), F.col("root").alias("b")))
    counts = linked.groupBy("id").agg(F.sum("links").alias("links"))
    reps = merged.select("key", "id", "weight").join(counts, "id", "left").join(found, "id", "left")
    reps = reps.select("key", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    out = ids.join(reps, "key", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"), F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(False)).alias("kept"))


def _linked_of(merged: DataFrame, dim: int, n: int, threshold: float, n_sample: int, list_rows: int, reach: float, block_rows: int) -> DataFrame:
    """(id, links, root): vectors of one length; several rows an id."""
    picked = merged.orderBy(F.xxhash64("id", F.lit(3)), "id").limit(n_sample).select("v").toArrow()  # n_sample bounds it
    sample = np.array(picked.column(0).to_pylist(), np.float64).reshape(-1, dim)
    sample /= np.linalg.norm(sample, axis=1)[:, None]
    q = fit(sample, math.ceil(n / list_rows))
    wide = spread_dimensions(sample - q.centre(q.assign(sample)))
    margin = math.sqrt(max(0.0, 2 - 2 * threshold)) * min(1.0, reach / math.sqrt(wide))

    def index(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.float32()]
        names = ["label", "list", "probing", "id", "weight", "vector", "code", "error"]
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                raw = part.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
                x = raw / np.linalg.norm(raw, axis=1)[:, None]
                own = q.assign(x)
                codes, error = q.encode(x, own)
                who, to = q.probes(x, margin)
                # A stored vector carries the lists that it probes itself, a probing one its own list.
                edge = np.searchsorted(who, np.arange(len(x) + 1))
                stored = [codes[i].tobytes() + to[edge[i] : edge[i + 1]].astype("<i8").tobytes() for i in range(len(x))]
                vector = pa.array([v.tobytes() for v in x], pa.binary())
                take = pa.array(np.concatenate([np.arange(len(x)), who]))
                columns = [
                    part.column(0).take(take), pa.array(np.concatenate([own, to])), pa.array(np.arange(len(take)) >= len(x)), part.column(1).take(take), part.column(2).take(take),
                    vector.take(take), pa.array([*stored, *(int(own[i]).to_bytes(8, "little") for i in who.tolist())], pa.binary()), pa.array(np.concatenate([error, np.zeros(len(who))]).astype(np.float32)),
                ]
                yield pa.RecordBatch.from_arrays([c.cast(k) for c, k in zip(columns, kinds)], names)

    indexed = materialise(merged.select("label", "id", "weight", "v").mapInArrow(index, INDEX), "index")
    size = indexed.groupBy("label", "list").agg(F.count_if(~F.col("probing")).alias("ns"), F.count_if("probing").alias("np"))
    blocks = lambda c: F.greatest(F.lit(1), F.ceil(F.col(c) / block_rows)).cast("int")
    sized = indexed.join(size.where("ns > 0 and np > 0").select("label", "list", blocks("ns").alias("bs"), blocks("np").alias("bp")), ["label", "list"])
    # A block of stored vectors meets every block of probing ones once.
    mine = F.pmod(F.xxhash64("id"), F.when(F.col("probing"), F.col("bp")).otherwise(F.col("bs"))).cast("int")
    spread = sized.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("probing"), F.col("bs")).otherwise(F.col("bp")) - 1)))
    keyed = spread.select("label", "list", F.when(F.col("probing"), F.col("other")).otherwise(F.col("mine")).alias("block"), F.when(F.col("probing"), F.col("mine")).otherwise(F.col("other")).alias("part"), "probing", "id", "weight", "vector", "code", "error")

    def link(group):
        import pyarrow as pa

        probing = np.array(group.column("probing").to_pylist(), bool)
        ids = group.column("id").to_numpy()
        weight = group.column("weight").to_numpy()
        x = np.frombuffer(b"".join(group.column("vector").to_pylist()), np.float64).reshape(-1, dim)
        at = int(group.column("list")[0].as_py())
        raw = group.column("code").to_pylist()
        s, p = np.flatnonzero(~probing), np.flatnonzero(probing)
        home = np.array([int.from_bytes(raw[i], "little") for i in p], np.int64)
        codes = np.frombuffer(b"".join(raw[i][: len(q.books)] for i in s), np.uint8).reshape(len(s), -1)
        probed = [np.frombuffer(raw[i], "<i8", offset=len(q.books)) for i in s]
        many = len(q.coarse) * len(q.fine)
        reached = np.sort(np.concatenate([k * many + t for k, t in enumerate(probed)] or [np.zeros(0, np.int64)]))
        errors = group.column("error").to_numpy()[s].astype(np.float64)
        nodes, place = np.unique(np.concatenate([ids[s], ids[p]]), return_inverse=True)
        here, asking = place[: len(s)], place[len(s) :]
        links, parent = np.zeros(len(nodes), np.int64), np.arange(len(nodes))
        # A link counts for the probing vector; for the stored one it counts when that probes, or here if it doesn't reach this list.
        for k, j in near_pairs(q, at, (x[s], codes, errors), x[p], threshold):
            other = here[j] != asking[k]
            k, j = k[other], j[other]
            np.add.at(links, asking[k], weight[s[j]])
            key = j * many + home[k]
            found = np.minimum(np.searchsorted(reached, key), len(reached) - 1)
            alone = (home[k] != at) & (reached[found] != key)
            np.add.at(links, here[j[alone]], weight[p[k[alone]]])
            parent = connected(asking[k], here[j], parent)
        seen = np.flatnonzero((links > 0) | (parent != np.arange(len(nodes))))
        return pa.table({"id": pa.array(nodes[seen]), "links": pa.array(links[seen]), "root": pa.array(nodes[parent[seen]])})

    return keyed.groupBy("label", "list", "block", "part").applyInArrow(link, "id long, links long, root long")


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS k, CAST(vec_id AS BIGINT) AS vec_id, CAST(embedding AS DOUBLE[]) AS e, label FROM embeddings),
g AS MATERIALIZED (SELECT * FROM v WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.k AS a, b.k AS b FROM g a JOIN g b ON a.label = b.label AND len(a.e) = len(b.e) AND a.k <> b.k WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
n AS (SELECT a AS k, count(*) AS n FROM l GROUP BY a),
r AS (SELECT k, k AS other FROM g UNION SELECT r.k, l.b FROM r JOIN l ON l.a = r.other),
c AS (SELECT r.k, min(g.vec_id) AS component_id FROM r JOIN g ON g.k = r.other GROUP BY r.k)
SELECT vec_id, coalesce(n.n, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(vec_id = coalesce(component_id, vec_id), false) AS kept
FROM v LEFT JOIN n USING (k) LEFT JOIN c USING (k)
"""
