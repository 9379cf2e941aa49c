"""The analytic questions over the integrated listing, each with the SQL it is held against.

Counts are long, shares in percent, figures rounded to six places. The null
key of a rollup's total is the empty string. Every top-k has a total order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.geo import haversine_m
from plumbline.plans.listing import MIN_PLATFORMS, PLATFORMS, SPARSE, SQL, SQL_CORR, TIERS, guarded_corr, listing, long_form, pair_form, table

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def r6(c: Column) -> Column:
    return F.round(c, 6)


def share(p: Column) -> Column:
    return r6(F.avg(p.cast("int")) * 100)


def n() -> Column:
    return F.count(F.lit(1))


def rated() -> Column:
    return (F.col("rating_platform_count") >= MIN_PLATFORMS) & F.col("rating_range_5").isNotNull()


RATED = f"rating_platform_count >= {MIN_PLATFORMS} AND rating_range_5 IS NOT NULL"
def least_reviews() -> Column:
    return F.least(*[F.col(f"{p}_review_count") for p in PLATFORMS])


LEAST = "least(google_review_count, tripadvisor_review_count, thefork_review_count)"
def total_reviews() -> Column:
    return sum((F.coalesce(F.col(f"{p}_review_count"), F.lit(0)) for p in PLATFORMS), F.lit(0))


TOTAL = "(coalesce(google_review_count, 0) + coalesce(tripadvisor_review_count, 0) + coalesce(thefork_review_count, 0))"
def coverage() -> Column:
    return F.col("rating_platform_count").cast("string")


def volume_bucket(c: Column) -> Column:
    return F.when(c < SPARSE, "0_sparse(<20)").when(c < 100, "1_low(20-99)").when(c < 500, "2_mid(100-499)").when(c < 2000, "3_high(500-1999)").otherwise("4_very_high(2000+)")


def volume_sql(c: str) -> str:
    return f"CASE WHEN {c} < {SPARSE} THEN '0_sparse(<20)' WHEN {c} < 100 THEN '1_low(20-99)' WHEN {c} < 500 THEN '2_mid(100-499)' WHEN {c} < 2000 THEN '3_high(500-1999)' ELSE '4_very_high(2000+)' END"


@query(SQL + "SELECT has_google, has_tripadvisor, has_thefork, count(*) AS restaurants FROM listing GROUP BY 1, 2, 3")
def q0_coverage(spark, sf_dir):
    return listing(spark, sf_dir, "lines").groupBy("has_google", "has_tripadvisor", "has_thefork").agg(n().alias("restaurants"))


@query(SQL + f"""SELECT coalesce(coverage, '') AS coverage, count(*) AS restaurants, round(avg(rating_range_5), 6) AS mean_range, round(stddev_samp(rating_range_5), 6) AS sd_range,
round(quantile_cont(rating_range_5, 0.9), 6) AS p90_range, round(max(rating_range_5), 6) AS max_range, round(100 * avg((rating_range_5 <= 0.5)::INTEGER), 6) AS pct_within_0_5, round(100 * avg((rating_range_5 <= 1.0)::INTEGER), 6) AS pct_within_1_0
FROM (SELECT CAST(rating_platform_count AS VARCHAR) AS coverage, rating_range_5 FROM listing WHERE {RATED}) GROUP BY ROLLUP (coverage)""")
def q1_summary(spark, sf_dir):
    x = F.col("rating_range_5")
    return (
        listing(spark, sf_dir, "lines").where(rated()).select(coverage().alias("coverage"), "rating_range_5").rollup("coverage")
        .agg(n().alias("restaurants"), r6(F.avg(x)).alias("mean_range"), r6(F.stddev_samp(x)).alias("sd_range"), r6(F.percentile(x, F.lit(0.9))).alias("p90_range"), r6(F.max(x)).alias("max_range"), share(x <= 0.5).alias("pct_within_0_5"), share(x <= 1.0).alias("pct_within_1_0"))
        .withColumn("coverage", F.coalesce("coverage", F.lit("")))
    )


@query(SQL + f"SELECT floor(rating_range_5 / 0.25) * 0.25 AS bin_start, count(*) AS restaurants FROM listing WHERE {RATED} GROUP BY 1")
def q1_histogram(spark, sf_dir):
    return listing(spark, sf_dir, "lines").where(rated()).groupBy((F.floor(F.col("rating_range_5") / 0.25) * F.lit(0.25).cast("double")).alias("bin_start")).agg(n().alias("restaurants"))


BANDS = (0.25, 0.5, 0.75, 1.0, 1.5, 2.0)


@query(SQL + "SELECT count(*) AS restaurants, " + ", ".join(f"round(100 * avg((rating_range_5 <= {b})::INTEGER), 6) AS within_{str(b).replace('.', '_')}" for b in BANDS) + f" FROM listing WHERE {RATED}")
def q1_tolerance_bands(spark, sf_dir):
    return listing(spark, sf_dir, "lines").where(rated()).agg(n().alias("restaurants"), *[share(F.col("rating_range_5") <= b).alias(f"within_{str(b).replace('.', '_')}") for b in BANDS])


@query(SQL + "SELECT pair, count(*) AS venues, round(avg(abs(a - b)), 6) AS mean_abs_diff, round(median(abs(a - b)), 6) AS median_abs_diff, round(100 * avg((abs(a - b) <= 0.5)::INTEGER), 6) AS pct_within_0_5, round(100 * avg((abs(a - b) <= 1.0)::INTEGER), 6) AS pct_within_1_0 FROM pairs GROUP BY pair")
def q1_pairwise_agreement(spark, sf_dir):
    d = F.abs(F.col("a") - F.col("b"))
    return pair_form(listing(spark, sf_dir, "lines")).groupBy("pair").agg(n().alias("venues"), r6(F.avg(d)).alias("mean_abs_diff"), r6(F.median(d)).alias("median_abs_diff"), share(d <= 0.5).alias("pct_within_0_5"), share(d <= 1.0).alias("pct_within_1_0"))


def top_pair(venues: DataFrame, a: str, b: str, min_diff: float, min_a: int, min_b: int, top_n: int) -> DataFrame:
    """The top_n venues on which two platforms differ by more than min_diff, of those with enough reviews."""
    x, y = F.col(f"{a}_rating_5"), F.col(f"{b}_rating_5")
    enough = (F.coalesce(F.col(f"{a}_review_count"), F.lit(0)) >= min_a) & (F.coalesce(F.col(f"{b}_review_count"), F.lit(0)) >= min_b)
    rows = venues.where(x.isNotNull() & y.isNotNull() & (F.abs(x - y) > min_diff) & enough)
    return rows.select("id", "name", "street", x.alias(f"{a}_rating"), y.alias(f"{b}_rating"), r6(F.abs(x - y)).alias("abs_diff"), f"{a}_review_count", f"{b}_review_count").orderBy(F.desc("abs_diff"), "id").limit(top_n)


def top_pair_sql(a: str, b: str, min_diff: float, min_a: int, min_b: int, top_n: int) -> str:
    return SQL + f"""SELECT id, name, street, {a}_rating_5 AS {a}_rating, {b}_rating_5 AS {b}_rating, round(abs({a}_rating_5 - {b}_rating_5), 6) AS abs_diff, {a}_review_count, {b}_review_count FROM listing
WHERE {a}_rating_5 IS NOT NULL AND {b}_rating_5 IS NOT NULL AND abs({a}_rating_5 - {b}_rating_5) > {min_diff} AND coalesce({a}_review_count, 0) >= {min_a} AND coalesce({b}_review_count, 0) >= {min_b} ORDER BY abs_diff DESC, id LIMIT {top_n}"""


@query(top_pair_sql("google", "tripadvisor", 1.0, 0, 0, 20))
def q2_top_pair(spark, sf_dir):
    return top_pair(listing(spark, sf_dir, "nation"), "google", "tripadvisor", 1.0, 0, 0, 20)


@query(top_pair_sql("google", "thefork", 1.0, SPARSE, SPARSE, 20))
def q2_top_pair_robust(spark, sf_dir):
    return top_pair(listing(spark, sf_dir, "nation"), "google", "thefork", 1.0, SPARSE, SPARSE, 20)


@query(SQL + "SELECT id, name, street, google_rating_5, tripadvisor_rating_5, thefork_rating_5, round(rating_range_5, 6) AS rating_range_5 FROM listing WHERE platform_count = 3 AND rating_range_5 IS NOT NULL ORDER BY 7 DESC, id LIMIT 20")
def q2_top_all_three(spark, sf_dir):
    return listing(spark, sf_dir, "nation").where("platform_count = 3 and rating_range_5 is not null").select("id", "name", "street", *[f"{p}_rating_5" for p in PLATFORMS], r6(F.col("rating_range_5")).alias("rating_range_5")).orderBy(F.desc("rating_range_5"), "id").limit(20)


def spread(spark, sf_dir):
    return listing(spark, sf_dir, "lines").where(rated()).select("id", coverage().alias("coverage"), "rating_range_5", least_reviews().alias("least_reviews"), total_reviews().alias("total_reviews")).where("least_reviews is not null")


SPREAD = f"(SELECT id, CAST(rating_platform_count AS VARCHAR) AS coverage, rating_range_5, {LEAST} AS least_reviews, {TOTAL} AS total_reviews FROM listing WHERE {RATED} AND {LEAST} IS NOT NULL)"


@query(SQL + f"SELECT coalesce(coverage, '') AS coverage, count(*) AS restaurants, round({SQL_CORR.format(x='rating_range_5', y='least_reviews')}, 6) AS corr_least, round({SQL_CORR.format(x='rating_range_5', y='total_reviews')}, 6) AS corr_total FROM {SPREAD} GROUP BY ROLLUP (coverage)")
def q3_correlations(spark, sf_dir):
    x = F.col("rating_range_5")
    out = spread(spark, sf_dir).rollup("coverage").agg(n().alias("restaurants"), r6(guarded_corr(x, F.col("least_reviews"))).alias("corr_least"), r6(guarded_corr(x, F.col("total_reviews"))).alias("corr_total"))
    return out.withColumn("coverage", F.coalesce("coverage", F.lit("")))


@query(SQL + f"SELECT coverage, {volume_sql('least_reviews')} AS bucket, count(*) AS restaurants, round(avg(rating_range_5), 6) AS mean_range FROM {SPREAD} GROUP BY 1, 2")
def q3_binned(spark, sf_dir):
    return spread(spark, sf_dir).groupBy("coverage", volume_bucket(F.col("least_reviews")).alias("bucket")).agg(n().alias("restaurants"), r6(F.avg("rating_range_5")).alias("mean_range"))


@query(SQL + f"SELECT id, coverage, round(rating_range_5, 6) AS rating_range_5, least_reviews FROM {SPREAD} WHERE least_reviews > 0")
def q3_scatter_rows(spark, sf_dir):
    return spread(spark, sf_dir).where("least_reviews > 0").select("id", "coverage", r6(F.col("rating_range_5")).alias("rating_range_5"), "least_reviews")


def rated_long(spark, sf_dir):
    return long_form(listing(spark, sf_dir, "lines"), "id", "rating_avg_5", "rating_platform_count").where("rating is not null and reviews is not null")


LONG = "long WHERE rating IS NOT NULL AND reviews IS NOT NULL"
def sparse_bucket() -> Column:
    return F.when(F.col("reviews") < SPARSE, "sparse (<20)").otherwise("well-reviewed (>=20)")


SPARSE_BUCKET = f"CASE WHEN reviews < {SPARSE} THEN 'sparse (<20)' ELSE 'well-reviewed (>=20)' END"
def tier() -> Column:
    return F.when(F.col("reviews") < 20, TIERS[0][0]).when(F.col("reviews") < 100, TIERS[1][0]).otherwise(TIERS[2][0])


TIER = f"CASE WHEN reviews < 20 THEN '{TIERS[0][0]}' WHEN reviews < 100 THEN '{TIERS[1][0]}' ELSE '{TIERS[2][0]}' END"
GRADIENT = (5, 10, 20, 50, 100, 200)
def gradient() -> Column:
    return sum(((F.col("reviews") >= g).cast("int") for g in GRADIENT), F.lit(0))


GRADIENT_SQL = "CAST(" + " + ".join(f"(reviews >= {g})::INTEGER" for g in GRADIENT) + " AS INTEGER)"


@query(SQL + f"SELECT platform, {SPARSE_BUCKET} AS bucket, count(*) AS restaurants, round(avg(rating), 6) AS mean_rating, round(stddev_samp(rating), 6) AS sd_rating FROM {LONG} GROUP BY 1, 2")
def q4_sparse_summary(spark, sf_dir):
    return rated_long(spark, sf_dir).groupBy("platform", sparse_bucket().alias("bucket")).agg(n().alias("restaurants"), r6(F.avg("rating")).alias("mean_rating"), r6(F.stddev_samp("rating")).alias("sd_rating"))


@query(SQL + f"SELECT id, platform, rating, {SPARSE_BUCKET} AS bucket FROM {LONG}")
def q4_rating_rows(spark, sf_dir):
    return rated_long(spark, sf_dir).select("id", "platform", "rating", sparse_bucket().alias("bucket"))


@query(SQL + f"SELECT id, platform, rating, reviews FROM {LONG}")
def q4_rating_volume_rows(spark, sf_dir):
    return rated_long(spark, sf_dir).select("id", "platform", "rating", "reviews")


@query(SQL + f"SELECT platform, {TIER} AS tier, count(*) AS restaurants, round(avg(rating), 6) AS mean_rating, round(stddev_samp(rating), 6) AS sd_rating, round(100 * avg((rating >= 4.8)::INTEGER), 6) AS pct_top FROM {LONG} GROUP BY 1, 2")
def q4_volatility_tiers(spark, sf_dir):
    return rated_long(spark, sf_dir).groupBy("platform", tier().alias("tier")).agg(n().alias("restaurants"), r6(F.avg("rating")).alias("mean_rating"), r6(F.stddev_samp("rating")).alias("sd_rating"), share(F.col("rating") >= 4.8).alias("pct_top"))


@query(SQL + f"SELECT platform, {GRADIENT_SQL} AS bin, count(*) AS restaurants, round(stddev_samp(rating), 6) AS sd_rating FROM {LONG} GROUP BY 1, 2")
def q4_volatility_gradient(spark, sf_dir):
    return rated_long(spark, sf_dir).groupBy("platform", gradient().alias("bin")).agg(n().alias("restaurants"), r6(F.stddev_samp("rating")).alias("sd_rating"))


@query(SQL + f"""
, g AS (SELECT platform, {SPARSE_BUCKET} AS bucket, rating FROM {LONG}),
m AS (SELECT platform, bucket, count(*) AS n, avg(rating) AS mean, var_samp(rating) AS v, median(rating) AS med FROM g GROUP BY 1, 2),
z AS (SELECT platform, bucket, abs(rating - med) AS z FROM g JOIN m USING (platform, bucket)),
zs AS (SELECT platform, bucket, count(*) AS n, avg(z) AS zm, sum(z) AS s, sum(z * z) AS ss FROM z GROUP BY 1, 2),
za AS (SELECT platform, sum(n) AS n, sum(s) / sum(n) AS zm, sum(ss - n * zm * zm) AS within_, count(*) AS k FROM zs GROUP BY 1),
zb AS (SELECT zs.platform, sum(zs.n * (zs.zm - za.zm) * (zs.zm - za.zm)) AS between_ FROM zs JOIN za USING (platform) GROUP BY 1)
SELECT a.platform, round((a.mean - b.mean) / sqrt(a.v / a.n + b.v / b.n), 4) AS welch_t,
  round(power(a.v / a.n + b.v / b.n, 2) / (power(a.v / a.n, 2) / (a.n - 1) + power(b.v / b.n, 2) / (b.n - 1)), 4) AS welch_df,
  round(((za.n - za.k) * between_) / ((za.k - 1) * within_), 4) AS levene_w
FROM m a JOIN m b ON a.platform = b.platform AND a.bucket LIKE 'sparse%' AND b.bucket LIKE 'well%' JOIN za ON za.platform = a.platform JOIN zb ON zb.platform = a.platform""")
def q4_welch_levene(spark, sf_dir):
    """Welch's t with its degrees of freedom, and Levene's W around the medians, sparse against well reviewed."""
    g = rated_long(spark, sf_dir).select("platform", sparse_bucket().alias("bucket"), "rating")
    m = g.groupBy("platform", "bucket").agg(n().alias("n"), F.avg("rating").alias("mean"), F.var_samp("rating").alias("v"), F.median("rating").alias("med"))
    z = g.join(m.select("platform", "bucket", "med"), ["platform", "bucket"]).withColumn("z", F.abs(F.col("rating") - F.col("med")))
    zs = z.groupBy("platform", "bucket").agg(n().alias("n"), F.avg("z").alias("zm"), F.sum("z").alias("s"), F.sum(F.col("z") * F.col("z")).alias("ss"))
    all_ = zs.groupBy("platform").agg(F.sum("n").alias("zn"), (F.sum("s") / F.sum("n")).alias("zall"), F.sum(F.expr("ss - n * zm * zm")).alias("within_"), F.count(F.lit(1)).alias("k"))
    between = zs.join(all_, "platform").groupBy("platform").agg(F.sum(F.expr("n * (zm - zall) * (zm - zall)")).alias("between_"))
    sides = [m.where(F.col("bucket").startswith(s)).select("platform", *[F.col(c).alias(f"{c}_{k}") for c in ("n", "mean", "v")]) for s, k in (("sparse", "a"), ("well", "b"))]
    return sides[0].join(sides[1], "platform").join(all_, "platform").join(between, "platform").select(
        "platform",
        F.round(F.expr("(mean_a - mean_b) / sqrt(v_a / n_a + v_b / n_b)"), 4).alias("welch_t"),
        F.round(F.expr("power(v_a / n_a + v_b / n_b, 2) / (power(v_a / n_a, 2) / (n_a - 1) + power(v_b / n_b, 2) / (n_b - 1))"), 4).alias("welch_df"),
        F.round(F.expr("((zn - k) * between_) / ((k - 1) * within_)"), 4).alias("levene_w"),
    )


@query(SQL + f"SELECT id, google_rating_5, tripadvisor_rating_5, thefork_rating_5, round(rating_avg_5, 6) AS rating_avg_5, rating_platform_count FROM listing WHERE rating_platform_count >= {MIN_PLATFORMS}")
def q5_platform_rows(spark, sf_dir):
    return listing(spark, sf_dir, "lines").where(F.col("rating_platform_count") >= MIN_PLATFORMS).select("id", *[f"{p}_rating_5" for p in PLATFORMS], r6(F.col("rating_avg_5")).alias("rating_avg_5"), "rating_platform_count")


@query(SQL + "SELECT pair, count(*) AS venues, round(avg(a - b), 6) AS mean_diff FROM pairs GROUP BY pair")
def q5_pairwise_differences(spark, sf_dir):
    return pair_form(listing(spark, sf_dir, "lines")).groupBy("pair").agg(n().alias("venues"), r6(F.avg(F.col("a") - F.col("b"))).alias("mean_diff"))


@query(SQL + f"SELECT platform, count(*) AS venues, round(avg(rating), 6) AS raw_mean, round(avg(rating - (rating_avg_5 * rating_platform_count - rating) / (rating_platform_count - 1)), 6) AS loo_bias, round(avg(rating - rating_avg_5), 6) AS consensus_dev FROM long WHERE rating IS NOT NULL AND rating_platform_count >= {MIN_PLATFORMS} GROUP BY platform")
def q5_platform_bias(spark, sf_dir):
    """A platform's mean, its mean distance from the mean of the others, and from the consensus."""
    rows = long_form(listing(spark, sf_dir, "lines"), "rating_avg_5", "rating_platform_count").where(F.col("rating").isNotNull() & (F.col("rating_platform_count") >= MIN_PLATFORMS))
    others = F.expr("(rating_avg_5 * rating_platform_count - rating) / (rating_platform_count - 1)")
    return rows.groupBy("platform").agg(n().alias("venues"), r6(F.avg("rating")).alias("raw_mean"), r6(F.avg(F.col("rating") - others)).alias("loo_bias"), r6(F.avg(F.col("rating") - F.col("rating_avg_5"))).alias("consensus_dev"))


@query(SQL + f"SELECT {volume_sql('google_review_count')} AS popularity_bin, count(*) AS restaurants, round(avg(rating_range_5), 6) AS mean_range, round(stddev_samp(rating_range_5), 6) AS sd_range, round(stddev_samp(rating_range_5) / sqrt(count(*)), 6) AS sem_range FROM listing WHERE {RATED} AND google_review_count IS NOT NULL GROUP BY 1")
def q6_popularity_bins(spark, sf_dir):
    rows = listing(spark, sf_dir, "lines").where(rated() & F.col("google_review_count").isNotNull())
    return rows.groupBy(volume_bucket(F.col("google_review_count")).alias("popularity_bin")).agg(n().alias("restaurants"), r6(F.avg("rating_range_5")).alias("mean_range"), r6(F.stddev_samp("rating_range_5")).alias("sd_range"), r6(F.stddev_samp("rating_range_5") / F.sqrt(n())).alias("sem_range"))


CITY, MIN_AREA = "EUROPE", 30
Q7 = ["id", "name", "city", "postal_code", "platform_count", "has_google", "has_tripadvisor", "has_thefork", "website", "primary_cuisine", "google_photo_count", "tripadvisor_photo_count", "thefork_photo_count", "google_review_count", "tripadvisor_review_count", "thefork_review_count", "google_rating_5", "tripadvisor_rating_5", "thefork_rating_5"]


@query(SQL + f"SELECT {', '.join(Q7)}, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, round(rating_avg_5, 6) AS rating_avg_5, round(rating_range_5, 6) AS rating_range_5 FROM listing WHERE city = '{CITY}'")
def q7_rows(spark, sf_dir):
    return listing(spark, sf_dir).where(F.col("city") == CITY).select(*Q7, *[r6(F.col(c)).alias(c) for c in ("latitude", "longitude", "rating_avg_5", "rating_range_5")])


def completeness() -> list[Column]:
    return [n().alias("restaurants"), r6(F.avg("platform_count")).alias("mean_platform_count"), share(F.col("has_tripadvisor") == 1).alias("pct_on_tripadvisor"), share(F.col("has_thefork") == 1).alias("pct_on_thefork"), share(F.col("website") != "").alias("pct_has_website"), share(F.col("primary_cuisine") != "").alias("pct_has_cuisine"), r6(F.median("google_review_count")).alias("median_google_reviews")]


COMPLETE = "count(*) AS restaurants, round(avg(platform_count), 6) AS mean_platform_count, round(100 * avg(has_tripadvisor), 6) AS pct_on_tripadvisor, round(100 * avg(has_thefork), 6) AS pct_on_thefork, round(100 * avg((website <> '')::INTEGER), 6) AS pct_has_website, round(100 * avg((primary_cuisine <> '')::INTEGER), 6) AS pct_has_cuisine, round(median(google_review_count), 6) AS median_google_reviews"


@query(SQL + f"SELECT postal_code, {COMPLETE} FROM listing WHERE city = '{CITY}' AND postal_code <> '' GROUP BY postal_code HAVING count(*) >= {MIN_AREA}")
def q7_area_completeness(spark, sf_dir):
    return listing(spark, sf_dir).where((F.col("city") == CITY) & (F.col("postal_code") != "")).groupBy("postal_code").agg(*completeness()).where(F.col("restaurants") >= MIN_AREA)


CENTRE, CENTRE_KM = (45.4642, 9.19), 2.0
#: name, latitude, longitude, radius in metres
NEIGHBOURHOODS = [("duomo", 45.4642, 9.19, 1200.0), ("navigli", 45.45, 9.175, 1500.0), ("brera", 45.4722, 9.1878, 900.0), ("isola", 45.487, 9.19, 1300.0), ("lambrate", 45.483, 9.242, 1800.0), ("bovisa", 45.504, 9.165, 2000.0), ("bicocca", 45.515, 9.212, 2200.0), ("citylife", 45.478, 9.156, 1400.0)]
DISTANCE_SQL = "2 * 6371008.8 * atan2(sqrt(least(1, power(sin(radians({a} - {c}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * power(sin(radians({b} - {d}) / 2), 2))), sqrt(greatest(0, 1 - (power(sin(radians({a} - {c}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * power(sin(radians({b} - {d}) / 2), 2)))))"


@query(SQL + f"SELECT CASE WHEN {DISTANCE_SQL.format(a='latitude', b='longitude', c=CENTRE[0], d=CENTRE[1])} <= {CENTRE_KM * 1000} THEN 'center' ELSE 'periphery' END AS zone, {COMPLETE} FROM listing GROUP BY 1")
def q7_zone(spark, sf_dir):
    zone = F.when(haversine_m(F.col("latitude"), F.col("longitude"), F.lit(CENTRE[0]), F.lit(CENTRE[1])) <= CENTRE_KM * 1000, "center").otherwise("periphery")
    return listing(spark, sf_dir, "orders").groupBy(zone.alias("zone")).agg(*completeness())


@query(SQL + f""", hoods(hood, la, lo, radius) AS (VALUES {', '.join(str(h) for h in NEIGHBOURHOODS)}),
near AS (SELECT id, arg_min(hood, ROW(d, hood)) AS hood FROM (SELECT id, hood, radius, {DISTANCE_SQL.format(a='latitude', b='longitude', c='la', d='lo')} AS d FROM listing, hoods) WHERE d <= radius GROUP BY id)
SELECT coalesce(hood, 'other') AS neighbourhood, {COMPLETE} FROM listing LEFT JOIN near USING (id) GROUP BY 1""")
def q7_neighbourhood(spark, sf_dir):
    """The nearest neighbourhood whose own radius holds the venue: over literals, no join."""
    options = [F.struct(haversine_m(F.col("latitude"), F.col("longitude"), F.lit(la), F.lit(lo)).alias("d"), F.lit(h).alias("hood"), F.lit(r).alias("r")) for h, la, lo, r in NEIGHBOURHOODS]
    nearest = F.array_min(F.filter(F.array(*options), lambda o: o["d"] <= o["r"]))
    return listing(spark, sf_dir, "orders").groupBy(F.coalesce(nearest["hood"], F.lit("other")).alias("neighbourhood")).agg(*completeness())


def labelled() -> Column:
    return ~F.col("cuisine_primary").isin("", "Other")




@query(SQL + "SELECT count(*) AS total, count(*) FILTER (primary_cuisine <> '') AS old_labelled, count(*) FILTER (cuisine_primary NOT IN ('', 'Other')) AS canonical_labelled, round(100.0 * count(*) FILTER (primary_cuisine <> '') / count(*), 6) AS pct_old, round(100.0 * count(*) FILTER (cuisine_primary NOT IN ('', 'Other')) / count(*), 6) AS pct_canonical, count(DISTINCT primary_cuisine) AS old_distinct_labels, count(DISTINCT cuisine_primary) FILTER (cuisine_primary NOT IN ('', 'Other')) AS canonical_buckets FROM listing")
def q8_coverage(spark, sf_dir):
    old = F.count_if(F.col("primary_cuisine") != "")
    return listing(spark, sf_dir, "customer").agg(n().alias("total"), old.alias("old_labelled"), F.count_if(labelled()).alias("canonical_labelled"), r6(100 * old / n()).alias("pct_old"), r6(100 * F.count_if(labelled()) / n()).alias("pct_canonical"), F.countDistinct("primary_cuisine").alias("old_distinct_labels"), F.countDistinct(F.when(labelled(), F.col("cuisine_primary"))).alias("canonical_buckets"))


@query(SQL + f"""SELECT cuisine_primary AS category, count(*) AS restaurants, round(avg(rating_avg_5), 6) AS mean_rating, count(*) FILTER (rating_platform_count >= 2) AS multi_platform, round(avg(rating_range_5) FILTER ({RATED}), 6) AS mean_range, round(median(rating_range_5) FILTER ({RATED}), 6) AS median_range,
round(median({TOTAL}), 6) AS median_reviews, round(avg({TOTAL}), 6) AS mean_reviews, round(avg(price_tier), 6) AS mean_price_tier FROM listing WHERE cuisine_primary NOT IN ('', 'Other') GROUP BY 1 HAVING count(*) >= 30 ORDER BY 2 DESC, 1 LIMIT 20""")
def q8_category(spark, sf_dir):
    ranged = F.when(rated(), F.col("rating_range_5"))
    out = listing(spark, sf_dir, "customer").where(labelled()).groupBy(F.col("cuisine_primary").alias("category")).agg(n().alias("restaurants"), r6(F.avg("rating_avg_5")).alias("mean_rating"), F.count_if(F.col("rating_platform_count") >= 2).alias("multi_platform"), r6(F.avg(ranged)).alias("mean_range"), r6(F.median(ranged)).alias("median_range"), r6(F.median(total_reviews())).alias("median_reviews"), r6(F.avg(total_reviews())).alias("mean_reviews"), r6(F.avg("price_tier")).alias("mean_price_tier"))
    return out.where("restaurants >= 30").orderBy(F.desc("restaurants"), "category").limit(20)


@query(SQL + "SELECT cuisine_primary AS category, count(*) FILTER (platform_count >= 2) AS multi_source, round(100.0 * count(*) FILTER (cuisine_agreement = 'agree') / count(*) FILTER (platform_count >= 2), 6) AS pct_agree FROM listing WHERE cuisine_primary NOT IN ('', 'Other') GROUP BY 1 HAVING count(*) FILTER (platform_count >= 2) >= 30 ORDER BY 3 DESC, 1 LIMIT 20")
def q8_category_agreement(spark, sf_dir):
    multi = F.count_if(F.col("platform_count") >= 2)
    out = listing(spark, sf_dir, "customer").where(labelled()).groupBy(F.col("cuisine_primary").alias("category")).agg(multi.alias("multi_source"), r6(F.try_divide(100 * F.count_if(F.col("cuisine_agreement") == "agree"), multi)).alias("pct_agree"))
    return out.where("multi_source >= 30").orderBy(F.desc("pct_agree"), "category").limit(20)


@query(SQL + "SELECT id, price_tier, round(rating_avg_5, 6) AS rating FROM listing WHERE price_tier IS NOT NULL AND rating_avg_5 IS NOT NULL")
def q8_price_rows(spark, sf_dir):
    return listing(spark, sf_dir, "orders").where("price_tier is not null and rating_avg_5 is not null").select("id", "price_tier", r6(F.col("rating_avg_5")).alias("rating"))


@query(SQL + "SELECT price_tier, count(*) AS restaurants, round(quantile_cont(rating_avg_5, 0.25), 6) AS q25, round(median(rating_avg_5), 6) AS q50, round(quantile_cont(rating_avg_5, 0.75), 6) AS q75 FROM listing WHERE price_tier IS NOT NULL AND rating_avg_5 IS NOT NULL GROUP BY 1")
def q8_price_quartiles(spark, sf_dir):
    out = listing(spark, sf_dir, "orders").where("price_tier is not null and rating_avg_5 is not null").groupBy("price_tier").agg(n().alias("restaurants"), F.percentile("rating_avg_5", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"))
    return out.select("price_tier", "restaurants", *[r6(F.col("q")[k]).alias(c) for k, c in enumerate(("q25", "q50", "q75"))])


MIX = [("low", 0.0, 2.0), ("mid", 2.0, 3.0), ("high", 3.0, 99.0)]


@query(SQL + "SELECT price_tier, count(*) AS restaurants, " + ", ".join(f"round(100 * avg((rating_avg_5 >= {a} AND rating_avg_5 < {b})::INTEGER), 6) AS pct_{k}" for k, a, b in MIX) + " FROM listing WHERE price_tier IS NOT NULL AND rating_avg_5 IS NOT NULL GROUP BY 1")
def q8_price_bands(spark, sf_dir):
    x = F.col("rating_avg_5")
    return listing(spark, sf_dir, "orders").where("price_tier is not null and rating_avg_5 is not null").groupBy("price_tier").agg(n().alias("restaurants"), *[share((x >= a) & (x < b)).alias(f"pct_{k}") for k, a, b in MIX])


@query(SQL + f"SELECT price_tier, count(*) AS restaurants, round(avg(google_rating_5), 6) AS google_rating, round(avg(tripadvisor_rating_5), 6) AS tripadvisor_rating, round(avg(thefork_rating_5), 6) AS thefork_rating, round(avg(rating_avg_5), 6) AS mean_rating, round(avg(rating_range_5) FILTER ({RATED}), 6) AS mean_range FROM listing WHERE price_tier IS NOT NULL GROUP BY 1")
def q9_price_tier(spark, sf_dir):
    return listing(spark, sf_dir, "orders").where("price_tier is not null").groupBy("price_tier").agg(n().alias("restaurants"), *[r6(F.avg(f"{p}_rating_5")).alias(f"{p}_rating") for p in PLATFORMS], r6(F.avg("rating_avg_5")).alias("mean_rating"), r6(F.avg(F.when(rated(), F.col("rating_range_5")))).alias("mean_range"))


@query(SQL + "SELECT price_tier, platform, round(avg(rating), 6) AS rating FROM long WHERE price_tier IS NOT NULL GROUP BY 1, 2")
def q9_melt(spark, sf_dir):
    """The tier table with its platform columns turned into rows."""
    wide = q9_price_tier(spark, sf_dir).select("price_tier", *[F.col(f"{p}_rating").alias(p) for p in PLATFORMS])
    return wide.unpivot("price_tier", list(PLATFORMS), "platform", "rating")


@query(SQL + "SELECT CAST(platform_count AS VARCHAR) AS platform_count, count(*) AS restaurants, round(avg(google_rating_5), 6) AS mean_google_rating, round(median(google_review_count), 6) AS median_google_reviews FROM listing WHERE has_google = 1 GROUP BY 1")
def q10_by_coverage(spark, sf_dir):
    return listing(spark, sf_dir, "lines").where("has_google = 1").groupBy(F.col("platform_count").cast("string").alias("platform_count")).agg(n().alias("restaurants"), r6(F.avg("google_rating_5")).alias("mean_google_rating"), r6(F.median("google_review_count")).alias("median_google_reviews"))


@query(SQL + "SELECT other_platform, bucket, count(*) AS restaurants, round(avg(google_rating_5), 6) AS mean_google_rating, round(median(google_review_count), 6) AS median_google_reviews FROM (" + " UNION ALL ".join(f"SELECT '{p}' AS other_platform, CASE WHEN has_{p} = 1 THEN 'also listed' ELSE 'not listed' END AS bucket, google_rating_5, google_review_count FROM listing WHERE has_google = 1" for p in ("tripadvisor", "thefork")) + ") GROUP BY 1, 2")
def q10_by_presence(spark, sf_dir):
    rows = listing(spark, sf_dir, "lines").where("has_google = 1").select("google_rating_5", "google_review_count", F.explode(F.array(*[F.struct(F.lit(p).alias("other_platform"), F.when(F.col(f"has_{p}") == 1, "also listed").otherwise("not listed").alias("bucket")) for p in ("tripadvisor", "thefork")])).alias("x"))
    return rows.groupBy("x.other_platform", "x.bucket").agg(n().alias("restaurants"), r6(F.avg("google_rating_5")).alias("mean_google_rating"), r6(F.median("google_review_count")).alias("median_google_reviews"))


@query(SQL + f"SELECT platform, count(photos) AS venues, round({SQL_CORR.format(x='photos', y='reviews')}, 6) AS corr_photos_reviews, round({SQL_CORR.format(x='photos', y='rating')}, 6) AS corr_photos_rating FROM long GROUP BY 1")
def q11_correlations(spark, sf_dir):
    return long_form(listing(spark, sf_dir, "lines")).groupBy("platform").agg(F.count("photos").alias("venues"), r6(guarded_corr(F.col("photos"), F.col("reviews"))).alias("corr_photos_reviews"), r6(guarded_corr(F.col("photos"), F.col("rating"))).alias("corr_photos_rating"))


@query(SQL + "SELECT id, thefork_photo_count AS photos, thefork_review_count AS reviews, thefork_rating_5 AS rating FROM listing WHERE thefork_photo_count > 0 AND thefork_review_count > 0")
def q11_rows(spark, sf_dir, platform: str = "thefork"):
    return listing(spark, sf_dir, "lines").where(f"{platform}_photo_count > 0 and {platform}_review_count > 0").select("id", F.col(f"{platform}_photo_count").alias("photos"), F.col(f"{platform}_review_count").alias("reviews"), F.col(f"{platform}_rating_5").alias("rating"))


@query(SQL + "SELECT id, name, google_rating_5, tripadvisor_rating_5, thefork_rating_5, round(rating_range_5, 6) AS rating_range_5 FROM listing WHERE rating_range_5 > 1")
def m_diff_gt_1(spark, sf_dir):
    return listing(spark, sf_dir, "lines").where("rating_range_5 > 1").select("id", "name", *[f"{p}_rating_5" for p in PLATFORMS], r6(F.col("rating_range_5")).alias("rating_range_5")).orderBy(F.desc("rating_range_5"), "id")


@query(SQL + "SELECT postal_code, count(*) AS restaurants, round(avg(google_rating_5), 6) AS google_rating, round(avg(tripadvisor_rating_5), 6) AS tripadvisor_rating, round(avg(thefork_rating_5), 6) AS thefork_rating FROM listing WHERE postal_code <> '' GROUP BY 1")
def m_avg_by_area(spark, sf_dir):
    return listing(spark, sf_dir, "customer").where("postal_code <> ''").groupBy("postal_code").agg(n().alias("restaurants"), *[r6(F.avg(f"{p}_rating_5")).alias(f"{p}_rating") for p in PLATFORMS]).orderBy("postal_code")


@query(SQL + f"SELECT id, google_review_count, tripadvisor_review_count, thefork_review_count, round(rating_range_5, 6) AS rating_range_5 FROM listing WHERE {RATED}")
def m_variance_rows(spark, sf_dir):
    return listing(spark, sf_dir, "lines").where(rated()).select("id", *[f"{p}_review_count" for p in PLATFORMS], r6(F.col("rating_range_5")).alias("rating_range_5")).orderBy(F.desc("rating_range_5"), "id")


@query(SQL + "SELECT listing.id, name, o_orderstatus AS status, o_totalprice AS price, round(rating_range_5, 6) AS rating_range_5 FROM listing LEFT JOIN orders ON o_orderkey = listing.id AND o_orderstatus = 'F' WHERE rating_range_5 > 1 ORDER BY 5 DESC, 1 LIMIT 20")
def m_left_join_drilldown(spark, sf_dir):
    detail = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    return listing(spark, sf_dir, "lines").where("rating_range_5 > 1").join(detail, "id", "left").select("id", "name", "status", "price", r6(F.col("rating_range_5")).alias("rating_range_5")).orderBy(F.desc("rating_range_5"), "id").limit(20)
