"""Similarity of names as columns; only the sequence ratio needs Python, on Arrow batches."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from plumbline.functions.text import normal_name


def indel_ratio(a: str, b: str) -> float:
    """Twice the longest common subsequence over the sum of the lengths, by bit-parallel rows."""
    if not a and not b:
        return 1.0
    where: dict[str, int] = {}
    for k, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << k
    full = row = (1 << len(a)) - 1
    for c in b:
        u = row & where.get(c, 0)
        row = ((row + u) | (row - u)) & full
    return 2 * (len(a) - bin(row).count("1")) / (len(a) + len(b))


def token_set_ratio(a: str | None, b: str | None) -> float:
    x, y = set((a or "").split()), set((b or "").split())
    if not x or not y:
        return 0.0
    both, left, right = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not left or not right):
        return 1.0
    one, two = f"{both} {left}".strip(), f"{both} {right}".strip()
    best = indel_ratio(one, two)
    if both:
        # Of the shared words and the same with more words behind, the shared words are the common subsequence.
        best = max(best, *(2 * len(both) / (len(both) + len(t)) for t in (one, two)))
    return best


@pandas_udf(DoubleType())
def _ratios(a: pd.Series, b: pd.Series) -> pd.Series:
    known: dict[tuple, float] = {}  # of a batch's pairs, each is worked out once
    for pair in zip(a, b):
        if pair not in known:
            known[pair] = token_set_ratio(*pair)
    return pd.Series([known[pair] for pair in zip(a, b)], dtype="float64")


#: Up to so many pairs of distinct names are compared once each and looked up; of more, those are compared that meet.
COMPARED = 250_000


class Lookup:
    """Similarities of the normalised names (columns a_<name>, s_<name>, never null) that records a and s have: {name: column of the similarity}.

    Where the distinct names of both sides make few pairs, a record carries the
    number of its name, and a pair looks its similarity up in a broadcast table.
    Else records carry the names themselves, to be compared in the pairs.
    """

    def __init__(self, a: DataFrame, s: DataFrame, names: dict[str, str]):
        self.names, self.numbers, self.known = names, {}, {}
        spark = a.sparkSession
        for name, out in names.items():
            x, y = ([r[0] for r in df.select(f"{k}_{name}").distinct().limit(COMPARED + 1).collect()] for df, k in ((a, "a"), (s, "s")))
            if not 0 < len(x) * len(y) <= COMPARED:
                continue
            numbered = [spark.createDataFrame(list(enumerate(sorted(v))), f"_no long, {k}_{name} string") for v, k in ((x, "a"), (y, "s"))]
            self.numbers |= {f"a_{name}": numbered[0], f"s_{name}": numbered[1]}
            both = numbered[0].withColumnRenamed("_no", "_a").crossJoin(numbered[1]).repartition(spark.sparkContext.defaultParallelism)
            self.known[name] = len(y), both.select((F.col("_a") * len(y) + F.col("_no")).alias(f"_{out}"), token_set_of(F.col(f"a_{name}"), F.col(f"s_{name}")).alias(out))

    def carried(self, rows: DataFrame) -> DataFrame:
        """Records of one side, with numbers instead of names where these are looked up."""
        for name, number in self.numbers.items():
            if name in rows.columns:
                rows = rows.join(F.broadcast(number), name).drop(name).withColumnRenamed("_no", name)
        return rows

    def added(self, pairs: DataFrame) -> DataFrame:
        """Pairs with the similarities of what they carry."""
        for name, out in self.names.items():
            ends = f"a_{name}", f"s_{name}"
            if name in self.known:
                m, known = self.known[name]
                pairs = pairs.withColumn(f"_{out}", F.col(ends[0]) * m + F.col(ends[1])).join(F.broadcast(known), f"_{out}").drop(f"_{out}", *ends)
            else:
                pairs = pairs.withColumn(out, token_set_of(*map(F.col, ends))).drop(*ends)
        return pairs


def token_set_of(a: Column, b: Column) -> Column:
    """Similarity of two names that are normalised already, 0 to 1; 0 if either has no word."""
    return _ratios(a, b)


def token_set(a: Column, b: Column) -> Column:
    """Similarity of two names, 0 to 1, over their normalised words; 0 if either has none."""
    return token_set_of(normal_name(a), normal_name(b))


def jaccard(a: Column, b: Column) -> Column:
    return F.coalesce(F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))), F.lit(0.0))


def exact(a: Column, b: Column) -> Column:
    return F.coalesce(((F.trim(a) == F.trim(b)) & (F.trim(a) != "")).cast("double"), F.lit(0.0))


def geo_score(distance_m: Column, reach_m: float = 500.0) -> Column:
    return F.coalesce(1 - F.least(distance_m, F.lit(reach_m)) / reach_m, F.lit(0.0))
