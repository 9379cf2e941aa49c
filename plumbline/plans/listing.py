"""The integrated listing: one row per venue with what three platforms say of it.

The benchmark tables stand in for the venues: a venue is an order, a platform is
a line flag, a rating comes from the integer sum of the discounts, so that no
order of summation can change a digit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: platform -> line flag
PLATFORMS = {"google": "A", "tripadvisor": "N", "thefork": "R"}
PAIRS = [("google", "tripadvisor"), ("google", "thefork"), ("tripadvisor", "thefork")]
MIN_PLATFORMS, SPARSE = 2, 20
#: (label, from, below): thin, moderate and established review volumes
TIERS = [("thin (<20)", 0, 20), ("moderate (20-99)", 20, 100), ("established (100+)", 100, None)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: How far a question looks beyond the lines; each step adds a join and columns.
LEVELS = ("lines", "orders", "customer", "nation", "region")


def listing(spark: SparkSession, sf_dir: str, level: str = "region") -> DataFrame:
    """One pass over the lines, grouped by their order; up to `level`, orders join on the same key, all else is a small dimension.

    Only a column that a level brings asks for its join: names and ratings come
    from the lines alone, prices and coordinates from orders, postal codes and
    merged labels from customer, streets from nation, cities from region.
    """
    lines = table(spark, sf_dir, "lineitem")
    aggregates = []
    for p, flag in PLATFORMS.items():
        mine = F.col("l_returnflag") == flag
        aggregates += [
            F.count_if(mine).alias(f"{p}_n"),
            F.sum(F.when(mine, F.round(F.col("l_discount") * 100).cast("int"))).alias(f"{p}_d"),
            F.sum(F.when(mine, F.col("l_quantity").cast("long"))).alias(f"{p}_review_count"),
            F.sum(F.when(mine, F.col("l_linenumber"))).alias(f"{p}_photo_count"),
        ]
    per = lines.groupBy(F.col("l_orderkey").alias("id")).agg(*aggregates)
    for p in PLATFORMS:
        per = per.withColumn(f"has_{p}", (F.col(f"{p}_n") > 0).cast("int"))
        per = per.withColumn(f"{p}_rating_5", F.when((F.col(f"{p}_n") > 0) & (F.col(f"{p}_review_count") % 11 != 0), F.col(f"{p}_d") / (2 * F.col(f"{p}_n"))))
    ratings = [F.col(f"{p}_rating_5") for p in PLATFORMS]
    count = sum((r.isNotNull().cast("int") for r in ratings), F.lit(0))
    total = sum((F.coalesce(r, F.lit(0.0)) for r in ratings), F.lit(0.0))
    per = per.select(
        "*",
        sum((F.col(f"has_{p}") for p in PLATFORMS), F.lit(0)).alias("platform_count"),
        count.alias("rating_platform_count"),
        F.try_divide(total, count).alias("rating_avg_5"),
        (F.greatest(*ratings) - F.least(*ratings)).alias("rating_range_5"),
    )
    far = LEVELS.index(level)
    own = [
        "id", F.concat(F.lit("venue "), F.col("id").cast("string")).alias("name"), *[f"has_{p}" for p in PLATFORMS], *[f"{p}_{c}" for p in PLATFORMS for c in ("rating_5", "review_count", "photo_count")],
        "platform_count", "rating_platform_count", "rating_avg_5", "rating_range_5",
        F.when(F.col("platform_count") < 2, "single").when(F.col("id") % 5 < 3, "agree").otherwise("disagree").alias("cuisine_agreement"),
        F.when(F.col("id") % 4 == 0, "").otherwise(F.concat(F.lit("site"), F.col("id").cast("string"), F.lit(".example"))).alias("website"),
    ]
    if far == 0:
        return per.select(*own)
    price = F.col("o_totalprice")
    of_order = [
        (F.lit(45.35) + F.pmod(F.col("o_custkey") * 7919, F.lit(2300)) / 10000).alias("latitude"), (F.lit(9.0) + F.pmod(F.col("o_custkey") * 104729, F.lit(3500)) / 10000).alias("longitude"),
        F.when(price < 50000, 1).when(price < 120000, 2).when(price < 220000, 3).when(price < 400000, 4).alias("price_tier"),
        F.when(F.col("id") % 3 == 0, "").otherwise(F.col("o_orderpriority")).alias("primary_cuisine"),
    ]
    venues = per.join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey", "o_totalprice", "o_orderpriority"), "id")
    if far == 1:
        return venues.select(*own, *of_order)
    places = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment")
    of_place = [F.col("c_nationkey").cast("string").alias("postal_code"), F.when(F.col("id") % 17 == 0, "Other").when(F.col("id") % 19 == 0, "").otherwise(F.col("c_mktsegment")).alias("cuisine_primary")]
    if far >= 3:
        nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("int").alias("c_nationkey"), "n_regionkey", F.col("n_name").alias("street"))
        places, of_place = places.join(nations, "c_nationkey"), [*of_place, "street"]
    if far == 4:
        places, of_place = places.join(table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("city")), "n_regionkey"), [*of_place, "city"]
    return venues.join(places, "o_custkey").select(*own, *of_order, *of_place)


def long_form(venues: DataFrame, *columns: str) -> DataFrame:
    """A row per venue and platform: one scan, instead of one for each platform."""
    return venues.select(
        *columns,
        F.explode(F.array(*[F.struct(F.lit(p).alias("platform"), F.col(f"has_{p}").alias("listed"), F.col(f"{p}_rating_5").alias("rating"), F.col(f"{p}_review_count").alias("reviews"), F.col(f"{p}_photo_count").alias("photos")) for p in PLATFORMS])).alias("x"),
    ).select(*columns, "x.*")


def pair_form(venues: DataFrame) -> DataFrame:
    """A row (pair, a, b) per venue and pair of platforms that both rate it."""
    structs = [F.struct(F.lit(f"{a} vs {b}").alias("pair"), F.col(f"{a}_rating_5").alias("a"), F.col(f"{b}_rating_5").alias("b")) for a, b in PAIRS]
    return venues.select(F.explode(F.array(*structs)).alias("x")).select("x.*").where("a is not null and b is not null")


def guarded_corr(x: Column, y: Column) -> Column:
    """corr over the rows where both are there; null, not an error, where either is constant."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    return F.try_divide(F.covar_pop(a, b), F.sqrt(F.var_pop(a)) * F.sqrt(F.var_pop(b)))


SQL_CORR = "CASE WHEN var_pop({x}) FILTER ({x} IS NOT NULL AND {y} IS NOT NULL) = 0 OR var_pop({y}) FILTER ({x} IS NOT NULL AND {y} IS NOT NULL) = 0 THEN NULL ELSE corr({x}, {y}) FILTER ({x} IS NOT NULL AND {y} IS NOT NULL) END"

_PER = ", ".join(
    f"count(*) FILTER (l_returnflag = '{f}') AS {p}_n, sum(CAST(round(l_discount * 100) AS INTEGER)) FILTER (l_returnflag = '{f}') AS {p}_d, "
    f"CAST(sum(CAST(l_quantity AS BIGINT)) FILTER (l_returnflag = '{f}') AS BIGINT) AS {p}_review_count, CAST(sum(l_linenumber) FILTER (l_returnflag = '{f}') AS BIGINT) AS {p}_photo_count"
    for p, f in PLATFORMS.items()
)
_RATED = ", ".join(f"CAST({p}_n > 0 AS INTEGER) AS has_{p}, CASE WHEN {p}_n > 0 AND {p}_review_count % 11 <> 0 THEN CAST({p}_d AS DOUBLE) / (2 * {p}_n) END AS {p}_rating_5" for p in PLATFORMS)
_R = [f"{p}_rating_5" for p in PLATFORMS]
#: The same listing for the oracle, as leading common table expressions.
SQL = f"""
WITH per AS (SELECT l_orderkey AS id, {_PER} FROM lineitem GROUP BY l_orderkey),
rated AS (SELECT *, {_RATED} FROM per),
counted AS (SELECT *, CAST({' + '.join(f'has_{p}' for p in PLATFORMS)} AS INTEGER) AS platform_count, CAST({' + '.join(f'({r} IS NOT NULL)::INTEGER' for r in _R)} AS INTEGER) AS rating_platform_count FROM rated),
listing AS (
  SELECT counted.*, 'venue ' || id AS name, n_name AS street, r_name AS city, CAST(c_nationkey AS VARCHAR) AS postal_code,
    45.35 + ((o_custkey * 7919) % 2300) / 10000.0::DOUBLE AS latitude, 9.0 + ((o_custkey * 104729) % 3500) / 10000.0::DOUBLE AS longitude,
    CASE WHEN rating_platform_count > 0 THEN ({' + '.join(f'coalesce({r}, 0)' for r in _R)}) / rating_platform_count END AS rating_avg_5,
    greatest({', '.join(_R)}) - least({', '.join(_R)}) AS rating_range_5,
    CASE WHEN o_totalprice < 50000 THEN 1 WHEN o_totalprice < 120000 THEN 2 WHEN o_totalprice < 220000 THEN 3 WHEN o_totalprice < 400000 THEN 4 END AS price_tier,
    CASE WHEN id % 3 = 0 THEN '' ELSE o_orderpriority END AS primary_cuisine,
    CASE WHEN id % 17 = 0 THEN 'Other' WHEN id % 19 = 0 THEN '' ELSE c_mktsegment END AS cuisine_primary,
    CASE WHEN platform_count < 2 THEN 'single' WHEN id % 5 < 3 THEN 'agree' ELSE 'disagree' END AS cuisine_agreement,
    CASE WHEN id % 4 = 0 THEN '' ELSE 'site' || id || '.example' END AS website
  FROM counted JOIN orders ON o_orderkey = id JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
long AS ({' UNION ALL '.join(f"SELECT id, price_tier, rating_avg_5, rating_platform_count, '{p}' AS platform, has_{p} AS listed, {p}_rating_5 AS rating, {p}_review_count AS reviews, {p}_photo_count AS photos FROM listing" for p in PLATFORMS)}),
pairs AS ({' UNION ALL '.join(f"SELECT '{a} vs {b}' AS pair, {a}_rating_5 AS a, {b}_rating_5 AS b FROM listing WHERE {a}_rating_5 IS NOT NULL AND {b}_rating_5 IS NOT NULL" for a, b in PAIRS)})
"""
