"""Merges, upserts, anti-joins and samples over keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key, the first by a total order."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_k = 1").drop("_k")


def guarded(df: DataFrame, key: str) -> DataFrame:
    """Without the rows whose key is null or blank."""
    return df.where(F.col(key).isNotNull() & (F.trim(F.col(key).cast("string")) != ""))


def upsert(existing: DataFrame, incoming: DataFrame, key: str, seq: str) -> DataFrame:
    """Existing rows, replaced and joined by the last incoming row of each key."""
    last = first_per_key(guarded(incoming, key), [key], [F.desc(seq)])
    return existing.join(last.select(key), key, "left_anti").unionByName(last)


def protected_upsert(existing: DataFrame, incoming: DataFrame, key: str, seq: str, protected: Column) -> DataFrame:
    """As upsert, but existing rows that `protected` holds for stay as they are."""
    kept = existing.where(protected).select(key)
    return upsert(existing, incoming.join(kept, key, "left_anti"), key, seq)


def stale(destination: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Rows of the destination whose key the source no longer has."""
    return destination.join(source.select(key), key, "left_anti")


def worklist(master: DataFrame, done: DataFrame, key: str, order: str) -> DataFrame:
    """What is left to do, in the master's order."""
    return master.join(done.select(key).distinct(), key, "left_anti").orderBy(order)


def merge_key(url: Column, source_id: Column, name: Column, address: Column) -> Column:
    return F.coalesce(F.concat(F.lit("url:"), F.nullif(F.trim(url), F.lit(""))), F.concat(F.lit("id:"), F.nullif(F.trim(source_id), F.lit(""))), F.concat(F.lit("na:"), F.lower(F.concat_ws("|", name, address))))


def richness(df: DataFrame, columns: list[str]) -> Column:
    return sum(((F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")).cast("int") for c in columns), F.lit(0))


def keyed_lookup(docs: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """(lookup_key, doc columns): a document under each of its keys, the last document of a key winning."""
    spread = docs.withColumn("lookup_key", F.explode(F.array_distinct(F.array_compact(F.array(*[F.col(k).cast("string") for k in keys])))))
    return first_per_key(spread, ["lookup_key"], [F.desc(seq)])


def stratified(df: DataFrame, strata: list[str], key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows: an equal quota for each stratum, at least one, then whatever comes next, all by a hash of the key.

    No stratum can give more than n rows, which Spark uses to leave out most of
    a large one before it is ranked. The hash is one that other engines have.
    """
    h = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    ranked = df.withColumn("_r", F.row_number().over(Window.partitionBy(*strata).orderBy(h, key))).where(F.col("_r") <= n)
    many = df.select(*strata).distinct().count()
    quota = max(1, n // max(1, many))
    return ranked.orderBy(F.greatest(F.col("_r") - quota, F.lit(0)), h, key).limit(n).drop("_r")


def folds(df: DataFrame, key: str, k: int, seed: int = 0) -> DataFrame:
    """A fold number from a hash of the key."""
    return df.withColumn("fold", F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(k)).cast("int"))


def excluding(df: DataFrame, *others: DataFrame, key: str) -> DataFrame:
    """Rows whose key stands in none of the others: a holdout without calibration rows, a sample without labelled ones."""
    for other in others:
        df = df.join(other.select(key), key, "left_anti")
    return df


def keyed_store(existing: DataFrame, incoming: DataFrame, key: str, seq: str, first: list[str], filled: list[str]) -> DataFrame:
    """One row a key: the last version, but columns of `first` as they were set first, and those of `filled` as they were last there.

    All by aggregates that combine before rows move; no key's versions are sorted.
    """
    others = [c for c in existing.columns if c not in (key, seq, *first, *filled)]
    rows = guarded(existing.unionByName(incoming), key)
    there = lambda c: F.when(F.col(c).isNotNull(), F.col(seq))
    kept = [F.max_by(F.col(c), F.col(seq)).alias(c) for c in others] + [F.min_by(F.col(c), there(c)).alias(c) for c in first] + [F.max_by(F.col(c), there(c)).alias(c) for c in filled]
    return rows.groupBy(key).agg(F.max(seq).alias(seq), *kept).select(*existing.columns)


def weighted_richness(columns: dict[str, int]) -> Column:
    """The weights of the columns that hold something."""
    return sum((F.when(F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != ""), w).otherwise(0) for c, w in columns.items()), F.lit(0))


def merged_shards(shards: DataFrame, key: str, shard: str, seq: str, detail: Column, rich: Column) -> DataFrame:
    """The record of each key that stays: one with details before others, then the richest, then the first that came."""
    rank = F.struct(detail.cast("int").alias("detail"), rich.alias("rich"), (-F.col(seq)).alias("first"))
    return shards.groupBy(key).agg(F.max_by(F.struct(*[c for c in shards.columns if c != key]), rank).alias("x"), F.count(F.lit(1)).alias("n_versions"), F.countDistinct(shard).alias("n_shards")).select(key, "x.*", "n_versions", "n_shards")


def merge_audit(shards: DataFrame, merged: DataFrame, key: str, shard: str, detail: Column, rich: Column) -> DataFrame:
    """(shard, records, with_detail, mean_richness, chosen) of each input, and of the output under the empty name."""
    stats = [F.count(F.lit(1)).alias("records"), F.count_if(detail).alias("with_detail"), F.round(F.avg(rich), 6).alias("mean_richness")]
    chosen = merged.groupBy(shard).agg(F.count(F.lit(1)).alias("chosen"))
    inputs = shards.groupBy(shard).agg(*stats).join(chosen, shard, "left").withColumn("chosen", F.coalesce("chosen", F.lit(0)))
    return inputs.unionByName(merged.agg(F.lit("").alias(shard), *stats, F.count(F.lit(1)).alias("chosen")).select(*inputs.columns))


def crawl_state(master: DataFrame, processed: DataFrame, failed: DataFrame, records: DataFrame, key: str) -> DataFrame:
    """(key, state) of all that is known: processed by a checkpoint or a record, failed and not processed since, or to do again."""
    done = processed.select(key).unionByName(records.select(key)).where(F.col(key).isNotNull())
    seen = done.select(key, F.lit(1).alias("p"), F.lit(0).alias("f"), F.lit(0).alias("m")).unionByName(failed.select(key, F.lit(0).alias("p"), F.lit(1).alias("f"), F.lit(0).alias("m"))).unionByName(master.select(key, F.lit(0).alias("p"), F.lit(0).alias("f"), F.lit(1).alias("m")))
    one = seen.groupBy(key).agg(F.max("p").alias("p"), F.max("f").alias("f"), F.max("m").alias("m"))
    return one.select(key, F.when(F.col("p") == 1, "processed").when(F.col("f") == 1, "failed").otherwise("redo").alias("state"), (F.col("m") == 1).alias("in_master"), ((F.col("m") == 1) & (F.col("p") == 0)).alias("redo"))


def filled(record: DataFrame, update: DataFrame, key: str, fields: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Records with the fields of an update where that has something; of the fields in `keep` the record's own value goes first."""
    said = update.select(key, *[F.col(c).alias(f"_new_{c}") for c in fields], F.lit(True).alias("updated"))
    some = lambda c: F.when(F.trim(c.cast("string")) != "", c)
    both = record.join(said, key, "left")
    merged = {c: F.coalesce(some(F.col(c)), some(F.col(f"_new_{c}"))) if c in keep else F.coalesce(some(F.col(f"_new_{c}")), F.col(c)) for c in fields}
    return both.withColumns(merged).withColumn("updated", F.coalesce("updated", F.lit(False))).select(*record.columns, "updated")


def joined_texts(*lists: Column) -> Column:
    """All texts of several lists, each once, in order of appearance, blank ones left out."""
    all_ = F.concat(*[F.coalesce(x, F.array().cast("array<string>")) for x in lists])
    return F.array_distinct(F.filter(F.transform(all_, lambda t: F.trim(t)), lambda t: t != ""))
