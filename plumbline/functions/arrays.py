"""Labels, flags, reviews, votes and JSON as column expressions over arrays and structs."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf
from pyspark.sql.types import IntegerType, StringType, StructType

DIETARY = ("vegetariano", "vegano", "senza glutine", "halal", "kosher", "biologico")


def flags(*named: tuple[str, Column]) -> Column:
    """The names whose condition holds, in the order given."""
    return F.array_compact(F.array(*[F.when(condition, name) for name, condition in named]))


def split_labels(c: Column) -> Column:
    """Comma-separated labels, trimmed; of those that differ in case only the first stays."""
    parts = F.filter(F.transform(F.split(c, ","), lambda x: F.trim(x)), lambda x: x != "")
    fold = F.aggregate(
        parts,
        F.struct(F.array().cast("array<string>").alias("seen"), F.array().cast("array<string>").alias("out")),
        lambda a, x: F.when(F.array_contains(a["seen"], F.lower(x)), a).otherwise(F.struct(F.array_append(a["seen"], F.lower(x)).alias("seen"), F.array_append(a["out"], x).alias("out"))),
    )
    return fold["out"]


def lift_dietary(labels: Column) -> Column:
    """(cuisines, dietary)."""
    diet = lambda x: F.lower(x).isin(*DIETARY)
    return F.struct(F.filter(labels, lambda x: ~diet(x)).alias("cuisines"), F.filter(labels, lambda x: diet(x)).alias("dietary"))


def slim(reviews: Column, most: int, *fields: str) -> Column:
    return F.transform(F.slice(reviews, 1, most), lambda r: F.struct(*[r[f].alias(f) for f in fields]))


def present(c: Column) -> Column:
    return (F.trim(F.coalesce(c, F.lit(""))) != "").cast("int")


def lenient_int(c: Column) -> Column:
    return c.try_cast("double").try_cast("bigint")


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def list_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.array().cast("array<string>"))


def joined(c: Column) -> Column:
    return F.coalesce(F.array_join(c, " / "), F.lit(""))


def price_vote(google: Column, tripadvisor: Column, thefork: Column) -> Column:
    """(levels, source): the level most sources name, all of them if several lead; source is a name, majority or tie."""
    votes = F.array(*[F.struct(F.lit(s).alias("source"), c.alias("level")) for s, c in (("google", google), ("tripadvisor", tripadvisor), ("thefork", thefork))])
    valid = F.filter(votes, lambda v: v["level"].isNotNull())
    levels = F.array_sort(F.array_distinct(F.transform(valid, lambda v: v["level"])))
    times = lambda level: F.size(F.filter(valid, lambda v: v["level"] == level))
    most = F.array_max(F.transform(levels, lambda x: times(x)))
    winners = F.filter(levels, lambda x: times(x) == most)
    first = F.try_element_at(F.filter(valid, lambda v: v["level"] == F.try_element_at(winners, F.lit(1))), F.lit(1))["source"]
    source = F.when(F.size(winners) > 1, "tie").when(most > 1, "majority").when(F.size(winners) == 1, first)
    return F.struct(winners.alias("levels"), source.alias("source"))


def contact_status(a: Column, b: Column) -> Column:
    return F.when(a.isNotNull() & b.isNotNull(), F.when(a == b, "exact_match").otherwise("conflict")).when(a.isNotNull() | b.isNotNull(), "single_source").otherwise("missing")


def website_status(a: Column, b: Column, host_a: Column, host_b: Column) -> Column:
    return F.when(a.isNotNull() & b.isNotNull(), F.when(a == b, "exact_match").when(host_a == host_b, "host_match").otherwise("conflict")).when(a.isNotNull() | b.isNotNull(), "single_source").otherwise("missing")


def merged_labels(sources: list[tuple[str, Column]], specificity: dict[str, int]) -> Column:
    """(tags, primary, primary_source, n_sources, agreement) of label arrays by source, in order of precedence.

    The primary is the most specific label; of equals the one of the first
    source. Sources agree if each one's own most specific label is the same.
    """
    rank_of = F.create_map(*[F.lit(x) for kv in specificity.items() for x in kv])

    def rank(x: Column) -> Column:
        return F.coalesce(F.try_element_at(rank_of, x), F.lit(1))

    def named(source: str, labels: Column) -> Column:
        return F.transform(F.coalesce(labels, F.array().cast("array<string>")), lambda x: F.struct(F.lit(source).alias("source"), x.alias("label")))

    def strongest(labels: Column) -> Column:
        return F.try_element_at(F.filter(labels, lambda x: rank(x) == F.array_max(F.transform(labels, lambda y: rank(y)))), F.lit(1))

    labelled = F.flatten(F.array(*[named(s, c) for s, c in sources]))
    tags = F.array_sort(F.array_distinct(F.transform(labelled, lambda v: v["label"])))
    best = F.array_max(F.transform(tags, lambda x: rank(x)))
    first = F.try_element_at(F.filter(labelled, lambda v: rank(v["label"]) == best), F.lit(1))
    own = F.array_compact(F.array(*[strongest(c) for _, c in sources]))
    agreement = F.when(F.size(own) <= 1, "single").when(F.size(F.array_distinct(own)) == 1, "agree").otherwise("disagree")
    return F.struct(tags.alias("tags"), F.coalesce(first["label"], F.lit("")).alias("primary"), F.coalesce(first["source"], F.lit("")).alias("primary_source"), F.size(own).alias("n_sources"), agreement.alias("agreement"))


def canonical_hash(*fields: Column) -> Column:
    return F.sha2(F.to_json(F.struct(*fields)), 256)


class _Walk:
    """Every scalar of a nested JSON text, depth first, at most 50 000 nodes: lateral, one row each."""

    def eval(self, text: str) -> Iterator[tuple[int, str, str | None]]:
        import json

        try:
            stack = [("$", json.loads(text))] if text else []
        except ValueError:
            return
        seen = 0
        while stack and seen < 50_000:
            path, x = stack.pop()
            seen += 1
            if isinstance(x, dict):
                stack.extend((f"{path}.{k}", v) for k, v in reversed(x.items()))
            elif isinstance(x, list):
                stack.extend((f"{path}[{k}]", v) for k, v in reversed(list(enumerate(x))))
            else:
                yield seen, path, None if x is None else x if isinstance(x, str) else json.dumps(x)


def json_walk(spark, name: str = "json_walk"):
    """Registers the walk as a table function for SQL."""
    found = udtf(_Walk, returnType=StructType().add("node", IntegerType()).add("path", StringType()).add("value", StringType()))
    spark.udtf.register(name, found)
    return found
