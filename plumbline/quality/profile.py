"""Data quality: field coverage, validity, anomalies, duplicates and scores, each in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.numbers import capped_pct
from plumbline.functions.text import missing

WEIGHTS = {"critical_completeness": 0.25, "validity": 0.20, "spatial_readiness": 0.15, "uniqueness": 0.15, "timeliness": 0.10, "reliability": 0.15}

EMAIL = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
URL = r"^https?://[^\s]+$"


def url(c: Column) -> Column:
    return c.rlike(URL)


def email(c: Column) -> Column:
    return c.rlike(EMAIL)


def phone(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"\D", "")) >= 6


def within(lo: float, hi: float):
    return lambda c: c.cast("string").try_cast("double").between(lo, hi)


def non_negative_int(c: Column) -> Column:
    return c.cast("string").rlike(r"^\d+$")


def timestamp(c: Column) -> Column:
    return F.try_to_timestamp(c.cast("string")).isNotNull()


def one_of(*values: str):
    return lambda c: c.isin(*values)


VALIDATORS = {
    "non_empty": lambda c: ~missing(c), "url": url, "email": email, "phone": phone, "rating": within(0, 5), "rating_10": within(0, 10), "count": non_negative_int,
    "latitude": within(-90, 90), "longitude": within(-180, 180), "timestamp": timestamp, "euro_tier": lambda c: c.rlike("^[€ -]+$"), "euro_amount": lambda c: c.rlike(r"^\d+([.,]\d+)?\s*€$"),
    "discount": lambda c: c.rlike(r"\d{1,3}\s*%"), "bool": lambda c: F.lower(c.cast("string")).isin("true", "false"),
    "business_status": one_of("OPERATIONAL", "CLOSED_TEMPORARILY", "CLOSED_PERMANENTLY"),
    "price_level": one_of("PRICE_LEVEL_FREE", "PRICE_LEVEL_INEXPENSIVE", "PRICE_LEVEL_MODERATE", "PRICE_LEVEL_EXPENSIVE", "PRICE_LEVEL_VERY_EXPENSIVE"),
    "collection_or_text": lambda c: ~missing(c),
}


def field_coverage(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field, present, records, coverage_pct): one aggregation over all fields, then unpivoted."""
    one = df.agg(F.count(F.lit(1)).alias("records"), *[F.count_if(~missing(F.col(f))).alias(f"p_{k}") for k, f in enumerate(fields)])
    rows = one.select("records", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"p_{k}").alias("present")) for k, f in enumerate(fields)])).alias("x"))
    return rows.select("x.field", "x.present", "records", capped_pct(F.col("x.present"), F.col("records")).alias("coverage_pct"))


def always_empty(df: DataFrame, fields: list[str]) -> DataFrame:
    return field_coverage(df, fields).where("present = 0").select("field")


def lowest_coverage(coverage: DataFrame, k: int) -> DataFrame:
    return coverage.orderBy("coverage_pct", "field").limit(k)


def validity(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """(field, checked, valid, validity_pct) of the values that are there, by each field's kind of validator."""
    counts = []
    for k, (f, kind) in enumerate(kinds.items()):
        there = ~missing(F.col(f))
        counts += [F.count_if(there).alias(f"c_{k}"), F.count_if(there & F.coalesce(VALIDATORS[kind](F.col(f)), F.lit(False))).alias(f"v_{k}")]
    one = df.agg(*counts)
    rows = one.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"c_{k}").alias("checked"), F.col(f"v_{k}").alias("valid")) for k, f in enumerate(kinds)])).alias("x"))
    return rows.select("x.*", capped_pct(F.col("x.valid"), F.col("x.checked")).alias("validity_pct"))


def anomalies(df: DataFrame, record_id: str, rules: list[tuple[str, str, Column]]) -> DataFrame:
    """(record_id, issue_type, field, value): a row for each rule (issue, field, condition) that a record meets."""
    found = [F.when(condition, F.struct(F.lit(issue).alias("issue_type"), F.lit(f).alias("field"), F.coalesce(F.col(f).cast("string"), F.lit("")).alias("value"))) for issue, f, condition in rules]
    return df.select(F.col(record_id).alias("record_id"), F.explode(F.array_compact(F.array(*found))).alias("x")).select("record_id", "x.*")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, excess) of keys that more than one row has."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumn("excess", F.col("n") - 1)


def flagged_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumn("is_duplicate", F.count(F.lit(1)).over(Window.partitionBy(*keys)) > 1)


def overall(scores: dict[str, Column]) -> Column:
    return F.round(sum((scores[k] * w for k, w in WEIGHTS.items()), F.lit(0.0)), 2)


def readiness(score: Column) -> Column:
    return F.when(score >= 95, "ready").when(score >= 80, "usable").when(score >= 50, "limited").otherwise("poor")


def top_issues(found: DataFrame, k: int = 4) -> DataFrame:
    return found.groupBy("issue_type").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "issue_type").limit(k)


def invalid_json(records: DataFrame, corrupt: str, key: str, source: str) -> DataFrame:
    """Anomalies of lines that can't be parsed, beside those of anomalies(); they mostly have no key, so the source stands in."""
    return records.where(F.col(corrupt).isNotNull()).select(F.coalesce(F.col(key).cast("string"), F.lit(source)).alias("record_id"), F.lit("invalid_json").alias("issue_type"), F.lit(corrupt).alias("field"), F.substring(corrupt, 1, 200).alias("value"))


def flag_rates(counts: DataFrame, by: str) -> DataFrame:
    """(by, flags, records, flags_per_100) from (by, flags, records)."""
    return counts.withColumn("flags_per_100", F.round(100 * F.coalesce(F.try_divide("flags", "records"), F.lit(0.0)), 2))


def extremes(scores: DataFrame, name: str, measures: dict[str, str]) -> DataFrame:
    """(measure, best, best_value, worst, worst_value); measures: column -> "high" or "low" is best; ties by name."""
    one = scores.agg(*[f(F.struct(F.col(m).alias("v"), (F.col(name)).alias("n"))).alias(f"{m}_{k}") for m in measures for k, f in (("most", F.max), ("least", F.min))])
    rows = []
    for m, good in measures.items():
        best, worst = (f"{m}_most", f"{m}_least") if good == "high" else (f"{m}_least", f"{m}_most")
        rows.append(F.struct(F.lit(m).alias("measure"), F.col(f"{best}.n").alias("best"), F.col(f"{best}.v").cast("double").alias("best_value"), F.col(f"{worst}.n").alias("worst"), F.col(f"{worst}.v").cast("double").alias("worst_value")))
    return one.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


#: (priority, condition on a source's summary, what to do)
ACTIONS = [
    (1, "spatial_readiness < 95", "geocode addresses before spatial joins"),
    (2, "timeliness < 95", "shorten the collection or refresh in steps"),
    (3, "reliability < 80", "weigh ratings by their number of reviews"),
    (4, "duplicates > 0", "look at names and addresses that repeat before integrating"),
]


def actions(summary: DataFrame, source: str) -> DataFrame:
    """(priority, source, action) that a summary calls for, the most urgent first; one row if none is."""
    found = F.array_compact(F.array(*[F.when(F.expr(condition), F.struct(F.lit(p).alias("priority"), F.lit(todo).alias("action"))) for p, condition, todo in ACTIONS]))
    rows = summary.select(F.explode(found).alias("x"), F.col(source).alias("source")).select("x.priority", "source", "x.action")
    none = summary.agg(F.max(F.size(found)).alias("most")).where("coalesce(most, 0) = 0").select(F.lit(1).alias("priority"), F.lit("all").alias("source"), F.lit("keep the present checks and run them after each update").alias("action"))
    return rows.unionByName(none).orderBy("priority", "source")
