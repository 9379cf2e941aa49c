"""Files in and out: JSON lines and arrays, gold labels, CSV, JSON lines, LaTeX, manifests."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

CORRUPT = "_corrupt"


@dataclass(frozen=True)
class SourceSpec:
    name: str
    path: str
    form: str  # "jsonl" or "array"
    key: str


def resolve(specs: dict[str, SourceSpec], selector: str) -> list[SourceSpec]:
    """One source by its name, or all of them."""
    if selector == "all":
        return list(specs.values())
    if selector not in specs:
        raise ValueError(f"unknown source {selector!r}; known: {', '.join(sorted(specs))}")
    return [specs[selector]]


def read_json(spark: SparkSession, path: str, schema: StructType, array: bool = False) -> DataFrame:
    """Records with a declared schema; what can't be parsed stands in the column _corrupt."""
    with_corrupt = StructType([*schema.fields]).add(CORRUPT, StringType())
    reader = spark.read.schema(with_corrupt).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.option("multiLine", array).json(path)


def loaded(records: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(good records with _id and _source_file, a report row read, inserted, malformed, keyless)."""
    k = F.col(key).cast("string")
    bad, keyless = F.col(CORRUPT).isNotNull(), k.isNull() | (F.trim(k) == "")
    report = records.agg(F.count(F.lit(1)).alias("read"), F.count_if(~bad & ~keyless).alias("inserted"), F.count_if(bad).alias("malformed"), F.count_if(~bad & keyless).alias("keyless"))
    good = records.where(~bad & ~keyless).withColumn("_id", k).withColumn("_source_file", F.col("_metadata.file_name")).drop(CORRUPT)
    return good, report


def read_gold(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(id, truth) of gold label files: later files and rows win, only MATCH and NON_MATCH count."""
    from pyspark.sql import Window

    out = None
    for k, path in enumerate(paths):
        df = spark.read.option("header", True).option("encoding", "UTF-8").csv(path)
        df = df.toDF(*[c.lstrip("﻿") for c in df.columns]).withColumn("_f", F.lit(k)).withColumn("_r", F.monotonically_increasing_id())
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    label = F.upper(F.trim("label"))
    last = out.where(label.isin("MATCH", "NON_MATCH")).withColumn("_k", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("_f"), F.desc("_r")))).where("_k = 1")
    return last.select("id", (label == "MATCH").alias("truth"))


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines with their fields in alphabetical order."""
    df.select(*sorted(df.columns)).write.mode("overwrite").json(path)


def write_json_array(df: DataFrame, path: str) -> int:
    """One JSON array in one file on the driver's machine, for consumers that want just that: rows pass through one partition after the other, never all at once. Returns their number."""
    columns = sorted(df.columns)
    n = 0
    with open(path, "w", encoding="utf-8") as out:
        out.write("[")
        for row in df.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("j")).toLocalIterator():
            out.write((",\n" if n else "\n") + row.j)
            n += 1
        out.write("\n]\n")
    return n


def mark_done(keys: DataFrame, key: str, path: str) -> None:
    """Adds keys to the set of those that are done, from which work goes on after a break."""
    keys.select(F.col(key).cast("string").alias(key)).distinct().write.mode("append").parquet(path)


def remaining(spark: SparkSession, work: DataFrame, key: str, path: str) -> DataFrame:
    """What of the work isn't in the set of done keys; all of it where there is no set yet."""
    from pyspark.errors import AnalysisException

    try:
        done = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return work
    return work.join(done.select(F.col(key).alias("_done")).distinct(), F.col(key).cast("string") == F.col("_done"), "left_anti")


def write_csv(df: DataFrame, path: str, one_file: bool = True) -> None:
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, path: str, columns: list[str], order: list[str] | None = None) -> None:
    """Columns in a fixed order, sorted within files by the table's key; replaces what was there."""
    out = df.select(*columns)
    (out.sortWithinPartitions(*order) if order else out).write.mode("overwrite").parquet(path)


_TEX = {"\\": r"\textbackslash{}", "&": r"\&", "%": r"\%", "$": r"\$", "#": r"\#", "_": r"\_", "{": r"\{", "}": r"\}", "~": r"\textasciitilde{}", "^": r"\textasciicircum{}"}


def latex(df: DataFrame) -> str:
    """A small result as a table with rules, all its rows; numbers to the right."""
    rows = df.collect()
    numeric = [t in ("int", "bigint", "double", "float") or t.startswith("decimal") for _, t in df.dtypes]
    tex = lambda v: "" if v is None else "".join(_TEX.get(c, c) for c in str(v))
    body = [" & ".join(map(tex, r)) + r" \\" for r in rows] or [rf"\multicolumn{{{len(df.columns)}}}{{c}}{{(no rows)}} \\"]
    return "\n".join([r"\begin{tabular}{" + "".join("r" if x else "l" for x in numeric) + "}", r"\toprule", " & ".join(map(tex, df.columns)) + r" \\", r"\midrule", *body, r"\bottomrule", r"\end{tabular}"])


def manifest(tables: dict[str, DataFrame]) -> str:
    """Row counts of the exported tables."""
    return json.dumps({name: df.count() for name, df in sorted(tables.items())}, indent=2, sort_keys=True)
