"""Connected components by alternating stars; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import discard, materialise


def _edges(df: DataFrame) -> DataFrame:
    """Distinct edges (a, b) with a > b."""
    return df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _state(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first())


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, component) of all nodes of edges(a, b): the least id that links lead to.

    Every round ties each node's larger neighbours, then its smaller ones, to
    its least neighbour, and writes the result to the shared folder. Minima are
    grouped with partial aggregation, so that a node with very many links is no
    task's burden. Null ends are left out.
    """
    now = materialise(_edges(edges.where("a is not null and b is not null")), "components")
    state = _state(now)
    for _ in range(most_rounds):
        if not state[0]:
            break
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select("b", "a"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _edges(both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")))
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        tied = large.join(small, "a")
        following = materialise(_edges(tied.select("b", "m").toDF("a", "b").union(small.select("a", F.col("m").alias("b")))), "components")
        discard(now)
        before, state, now = state, _state(following), following
        if state == before:
            break
    else:
        raise RuntimeError("the components didn't settle")
    roots = now.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots)
