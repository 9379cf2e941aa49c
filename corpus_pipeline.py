"""The corpus pipeline: toxicity, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its
predecessor kept; all but the last return the columns of documents.

Defined results: those of each operator; no rows: no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import minhash, packing, suffix, toxicity
from plumbline.llm.common import materialise, table

#: A document is rejected from this score on, as op4 predicts it.
TOXIC = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier, trained on this stage's own input, doesn't predict to be toxic."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep=True).where(F.col("_score") < TOXIC).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class."""
    return minhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, their texts without the passages that start elsewhere too."""
    return suffix.remove_repeats(docs, cut=True)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows, packed into sequences."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("minhash_near_dedup", drop_near_duplicates), ("suffix_dedup", cut_repeats), ("best_fit_packing", pack)]

#: SQL can't express the classifier or the byte-level tokens; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
