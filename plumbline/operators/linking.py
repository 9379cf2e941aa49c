"""One-to-one links by greedy selection, and the conflicts around them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_FOLDERS: list[tempfile.TemporaryDirectory] = []


def _folder(spark: SparkSession) -> str:
    """A new folder where all executors share it; on one machine without such a setting, in a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if not _FOLDERS:
            _FOLDERS.append(tempfile.TemporaryDirectory(prefix="plumbline-"))
        folder = "file://" + _FOLDERS[0].name
    return f"{folder.rstrip('/')}/links-{uuid.uuid4().hex}"


def link_rank() -> Column:
    """The better of two pairs has the greater rank; pair_id makes the order total."""
    return F.struct("overridden", F.coalesce("score", F.lit(-1.0)).alias("score"), "fast", (-F.coalesce("geo_dist_m", F.lit(float("inf")))).alias("near"), F.coalesce("name_sim", F.lit(-1.0)).alias("name_sim"), "pair_id")


def one_to_one(pairs: DataFrame, k: int = 16, fetch: Callable[[DataFrame | None], DataFrame] | None = None) -> DataFrame:
    """The pairs(a_id, s_id, pair_id, overridden, score, fast, geo_dist_m, name_sim) that greedy selection takes.

    With one order of all pairs the greedy outcome is the one that no two
    records would both leave for each other. So each source offers itself to its
    best anchor that holds no better offer, all at once, until no offer changes:
    anchors only ever improve. For that a source needs no more than the list of
    its k best pairs; one that is refused by all of a full list gets the k best
    of its pairs behind it that their anchors would still take. Only lists and
    held offers are written, never all pairs. The number of rounds grows with
    the chains of records that push each other away, not with the pairs.

    fetch(None): pairs that have the k best of each source at least;
    fetch(ids(s_id)): the pairs of these sources. Without it both come from pairs.
    """
    spark = pairs.sparkSession
    base = _folder(spark)
    fetch = fetch or (lambda ids: pairs if ids is None else pairs.join(ids, "s_id", "left_semi"))

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    def listed(some: DataFrame, number: int) -> DataFrame:
        by_rank = Window.partitionBy("s_id").orderBy(F.desc("_rank"))
        return written(some.withColumn("_no", F.row_number().over(by_rank)).where(F.col("_no") <= k), f"lists/batch={number}")

    ranks = lambda df: df.where("a_id is not null and s_id is not null").withColumn("_rank", link_rank())
    batch = listed(ranks(fetch(None)), 0)
    lists, finished, number, rounds = batch, None, 0, 0
    held = written(lists.select("a_id", "s_id", "_rank").where("false"), "held-0")
    while True:
        while True:
            rounds += 1
            open_ = lists.select("a_id", "s_id", "_rank").join(held.select("a_id", F.col("_rank").alias("least")), "a_id", "left").where("least is null or _rank >= least")
            offers = open_.groupBy("s_id").agg(F.max(F.struct("_rank", "a_id")).alias("x")).select("s_id", "x.*")
            now = written(offers.groupBy("a_id").agg(F.max(F.struct("_rank", "s_id")).alias("x")).select("a_id", "x.s_id", "x._rank"), f"held-{rounds}")
            changed = not now.join(held, ["a_id", "s_id"], "left_anti").isEmpty()
            held = now
            if not changed:
                break
        # A source whose last list was full may have more pairs behind it.
        ends = lists.groupBy("s_id").agg(F.count(F.lit(1)).alias("n"), F.min("_rank").alias("last")).join(held, "s_id", "left_anti")
        wanted = ends.where(F.col("n") % k == 0)
        if finished is not None:
            wanted = wanted.join(finished, "s_id", "left_anti")
        number += 1
        wanted = written(wanted.select("s_id", "last"), f"wanted-{number}")
        if wanted.isEmpty():
            break
        more = ranks(fetch(wanted.select("s_id"))).join(wanted, "s_id").where(F.col("_rank") < F.col("last")).drop("last")
        more = more.join(held.select("a_id", F.col("_rank").alias("least")), "a_id", "left").where("least is null or _rank > least").drop("least")
        batch = listed(more.select(*pairs.columns, "_rank"), number)
        lists = lists.unionByName(batch)
        short = wanted.select("s_id").join(batch.groupBy("s_id").agg(F.count(F.lit(1)).alias("got")), "s_id", "left").where(F.coalesce("got", F.lit(0)) < k)
        last = written(short.select("s_id"), f"done-{number}")
        finished = last if finished is None else finished.unionByName(last)
    return lists.join(held.select("s_id", "_rank.pair_id"), ["s_id", "pair_id"], "left_semi").select(*pairs.columns)


def competing(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(a_id, n_same_a) and (s_id, n_same_s): how many other pairs each pair of a record has on that side; to be carried by the records, so that pairs needn't move."""
    return tuple(pairs.groupBy(f"{k}_id").agg((F.count(F.lit(1)) - 1).alias(f"n_same_{k}")) for k in "as")


def conflicts(pairs: DataFrame) -> DataFrame:
    """pairs that carry n_same_a and n_same_s with the flags that these raise."""
    return pairs.withColumn("conflict_flags", F.array_compact(F.array(F.when(F.col("overridden"), "llm_override"), F.when(F.col("n_same_a") > 0, "multiple_source_matches"), F.when(F.col("n_same_s") > 0, "source_record_matched_multiple"))))


def with_others(selected: DataFrame, existing: DataFrame, sources: list[str]) -> DataFrame:
    """The links selected for some sources, and those that exist for all others."""
    return selected.unionByName(existing.where(~F.col("source").isin(*sources)).select(*selected.columns))
