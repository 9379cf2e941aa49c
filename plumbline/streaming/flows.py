"""Incremental flows: keyed upserts from files as they come, and an alarm over a sliding window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.operators.maintenance import first_per_key


def sliding_alarm(events: DataFrame, event_id: str, key: str, ts: str, window_s: int, threshold: int, slot_s: int = 60) -> DataFrame:
    """(event_id, distinct_keys, alarm): distinct keys among the events of the window_s seconds up to each event.

    A key counts from its first event until window_s after its last; per key
    such spans are joined, so that distinct keys become open spans. Open spans
    are a running sum, taken within time slots and over the slots' totals; a
    slot is one task's work, and a year has half a million slots of a minute.
    """
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    wide = window_s * 1_000_000
    w = Window.partitionBy("k").orderBy("at")
    keyed = events.where(F.col(ts).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("k"), at.alias("at")).distinct()
    edges = keyed.withColumn("before", F.lag("at").over(w)).withColumn("after", F.lead("at").over(w))
    deltas = edges.select(F.explode(F.array_compact(F.array(F.when(F.col("before").isNull() | (F.col("at") - F.col("before") > wide), F.struct(F.col("at").alias("at"), F.lit(1).alias("d"))), F.when(F.col("after").isNull() | (F.col("after") - F.col("at") > wide), F.struct((F.col("at") + wide + 1).alias("at"), F.lit(-1).alias("d")))))).alias("x")).select("x.*")
    points = deltas.select("at", "d", F.lit(None).cast("long").alias("event")).unionByName(events.where(F.col(ts).isNotNull()).select(at.alias("at"), F.lit(0).alias("d"), F.col(event_id).alias("event")))
    points = points.withColumn("slot", F.floor(F.col("at") / (slot_s * 1_000_000)))
    # One row for each slot of time: a small table whatever the number of events.
    slots = points.groupBy("slot").agg(F.sum("d").alias("sum")).withColumn("open", F.sum("sum").over(Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)))
    inside = F.sum("d").over(Window.partitionBy("slot").orderBy("at").rangeBetween(Window.unboundedPreceding, 0))
    counted = points.withColumn("inside", inside).where("event is not null").join(slots.select("slot", "open"), "slot")
    n = (F.col("inside") + F.coalesce("open", F.lit(0))).cast("long")
    return counted.select(F.col("event").alias(event_id), n.alias("distinct_keys"), (n >= threshold).alias("alarm"))


def deferrals(attempts: DataFrame, key: str, cycle: str, ok: str, most_failures: int, retry_cycles: int) -> DataFrame:
    """(key, failures, last_failed_cycle, deferred_until) of the keys that failed since they last worked; deferred from most_failures on.

    attempts: (key, cycle, ok), a cycle being a number that grows. Two
    aggregates that combine before rows move, and a join of their results.
    """
    worked = attempts.where(ok).groupBy(key).agg(F.max(cycle).alias("_worked"))
    failed = attempts.where(~F.col(ok)).groupBy(key, cycle).agg(F.count(F.lit(1)).alias("_n"))
    since = failed.join(worked, key, "left").where(F.col("_worked").isNull() | (F.col(cycle) > F.col("_worked")))
    out = since.groupBy(key).agg(F.sum("_n").alias("failures"), F.max(cycle).alias("last_failed_cycle"))
    return out.withColumn("deferred_until", F.when(F.col("failures") >= most_failures, F.col("last_failed_cycle") + retry_cycles))


def deferrals_stream(attempts: DataFrame, key: str, cycle: str, ok: str, most_failures: int, retry_cycles: int) -> DataFrame:
    """deferrals over a stream of attempts: a row for each key that a batch changes; the state is two numbers a key."""

    def step(keys, batches, state):
        import pandas as pd

        failures, last = state.get if state.exists else (0, None)
        for batch in batches:
            for c, worked in sorted(zip(batch[cycle].tolist(), batch[ok].tolist())):
                failures, last = (0, None) if worked else (failures + 1, c)
        state.update((failures, last))
        until = last + retry_cycles if failures >= most_failures else None
        yield pd.DataFrame({key: [keys[0]], "failures": [failures], "last_failed_cycle": pd.array([last], dtype="Int64"), "deferred_until": pd.array([until], dtype="Int64")})

    kind = dict(attempts.dtypes)[key]
    schema = f"{key} {kind}, failures long, last_failed_cycle long, deferred_until long"
    return attempts.select(key, cycle, ok).groupBy(key).applyInPandasWithState(step, schema, "failures long, last long", "update", "NoTimeout")


def windowed_alarm(events: DataFrame, key: str, ts: str, window: str, slide: str, threshold: int, late: str = "10 minutes") -> DataFrame:
    """For streams: windows in which approximately `threshold` distinct keys or more appear."""
    counted = events.withWatermark(ts, late).groupBy(F.window(ts, window, slide)).agg(F.approx_count_distinct(key).alias("distinct_keys"))
    return counted.where(F.col("distinct_keys") >= threshold)


BUCKET = "_bucket"


def upsert_stream(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, key: str, seq: str, buckets: int = 64):
    """Brings what is new in a folder of Parquet files into a keyed table and stops; a repeated batch changes nothing.

    The table lies in folders by a hash of the key. A batch writes anew only the
    buckets that its keys fall into, under the batch's number; an older version
    of a bucket goes when a newer one is whole. So a trickle costs its buckets,
    not the table.
    """
    stream = spark.readStream.schema(schema).parquet(source)

    def merge(batch: DataFrame, number: int) -> None:
        batch = batch.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        touched = sorted(r[0] for r in batch.select(BUCKET).distinct().collect())  # no more than `buckets`
        if not touched:
            return
        last = first_per_key(batch, [key], [F.desc(seq)]).drop(BUCKET)
        versions = {b: n for b, n in _versions(spark, target).items() if b in touched}
        before = [f"{target}/{BUCKET}={b}/v{n:08d}" for b, n in versions.items() if n < number]
        merged = last
        if before:
            merged = spark.read.schema(schema).parquet(*before).join(last.select(key), key, "left_anti").unionByName(last)
        merged = merged.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        staged = f"{target}/_staged/v{number:08d}"
        merged.repartition(len(touched), BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(staged)
        fs, path = _filesystem(spark, target)
        for b in touched:
            fs.delete(path(f"{target}/{BUCKET}={b}/v{number:08d}"), True)
            fs.mkdirs(path(f"{target}/{BUCKET}={b}"))
            fs.rename(path(f"{staged}/{BUCKET}={b}"), path(f"{target}/{BUCKET}={b}/v{number:08d}"))
        fs.delete(path(staged), True)
        for old in before:
            fs.delete(path(old), True)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _filesystem(spark: SparkSession, target: str):
    """Hadoop's file system of a path, which renames and deletes where Spark's own API has nothing for it."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(target).getFileSystem(spark._jsc.hadoopConfiguration()), path


def _versions(spark: SparkSession, target: str) -> dict[int, int]:
    """bucket -> the newest version that is whole."""
    fs, path = _filesystem(spark, target)
    found: dict[int, int] = {}
    for s in fs.globStatus(path(f"{target}/{BUCKET}=*/v*")) or []:
        bucket, number = s.getPath().getParent().getName().split("=")[1], s.getPath().getName()[1:]
        found[int(bucket)] = max(found.get(int(bucket), -1), int(number))
    return found


def latest(spark: SparkSession, target: str) -> DataFrame:
    """The table that upsert_stream has written last."""
    return spark.read.parquet(*[f"{target}/{BUCKET}={b}/v{n:08d}" for b, n in sorted(_versions(spark, target).items())])
