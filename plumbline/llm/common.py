"""What the operators of this subpackage share: tables, the shared folder, shipping code."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ONLY: list[tempfile.TemporaryDirectory] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir.

    Only a session without that setting, as in tests on one machine, gets a
    temporary folder, and only where the master is local.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not _LOCAL_ONLY:
        _LOCAL_ONLY.append(tempfile.TemporaryDirectory(prefix="plumbline-"))
    return "file://" + _LOCAL_ONLY[0].name


def work_path(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


#: Spark's setting by which shuffle files go when a query has ended, instead of when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(df: DataFrame, what: str) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back: lineage ends there, a lost executor costs nothing, and what was shuffled for it goes."""
    spark = df.sparkSession
    path = work_path(spark, what)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes materialised tables from the shared folder, once all that was read from them is materialised too."""
    from plumbline.llm.media import filesystem

    for df in tables:
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            fs, base = filesystem(folder)
            fs.delete_dir(base)


def ship(spark: SparkSession) -> None:
    """Gives the Python workers this package, once a session, wherever the driver found it."""
    sc = spark.sparkContext
    if getattr(sc, "_plumbline_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="plumbline-ship-")
    path = os.path.join(folder, "plumbline_shipped.zip")
    with zipfile.ZipFile(path, "w") as z:
        for at, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(at, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._plumbline_shipped = True


def chunks(batches, chars: int = 2_000_000):
    """(ids, texts) of Arrow batches of (id, text), about `chars` characters at once; null texts are empty."""
    for batch in batches:
        ids, texts, n = [], [], 0
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            ids.append(doc_id)
            texts.append(text.as_py() or "")
            n += len(texts[-1])
            if n > chars:
                yield ids, texts
                ids, texts, n = [], [], 0
        if ids:
            yield ids, texts
