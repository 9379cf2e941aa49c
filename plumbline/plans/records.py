"""Queries of functions, record linkage, integration, quality and maintenance, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import arrays, geo, numbers, pages, similarity, text
from plumbline.operators import blocking, cleaning, linking, maintenance, scoring
from plumbline.plans.analytics import DISTANCE_SQL
from plumbline.plans.listing import PLATFORMS, SQL, listing, table
from plumbline.quality import assess, profile
from plumbline.streaming import flows

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# functions


def part(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")


@query(r"""SELECT p_partkey, trim(regexp_replace(regexp_replace(regexp_replace(lower('RIST.  ' || p_name || '!! P.ZA ' || p_brand), '\brist\.', 'ristorante ', 'g'), '\bp\.za', 'piazza ', 'g'), '[[:punct:]\s]+', ' ', 'g')) AS name FROM part""")
def fn_normalize_text(spark, sf_dir):
    return part(spark, sf_dir).select("p_partkey", text.normal_name(F.concat(F.lit("RIST.  "), "p_name", F.lit("!! P.ZA "), "p_brand")).alias("name"))


@query(r"""SELECT p_partkey, list_sort(list_distinct(list_filter(string_split(trim(regexp_replace(lower(p_name || ' ' || p_type), '[[:punct:]\s]+', ' ', 'g')), ' '), lambda t: length(t) >= 4))) AS tokens FROM part""")
def fn_tokens(spark, sf_dir):
    return part(spark, sf_dir).select("p_partkey", F.array_sort(text.tokens(F.concat_ws(" ", "p_name", "p_type"))).alias("tokens"))


@query("SELECT p_partkey, CAST(p_size * 1000 + 234 AS DOUBLE) AS thousands, p_size + 0.5::DOUBLE AS decimals, CAST(1234000 + p_size AS DOUBLE) + 0.25 AS both FROM part")
def fn_number_parse(spark, sf_dir):
    size = F.col("p_size").cast("string")
    return part(spark, sf_dir).select("p_partkey", numbers.number(F.concat(F.lit("("), size, F.lit(".234 recensioni)"))).alias("thousands"), numbers.number(F.concat(size, F.lit(",5"))).alias("decimals"), numbers.number(F.concat(F.lit("1.234."), F.lpad(size, 3, "0"), F.lit(",25 €"))).alias("both"))


@query("SELECT p_partkey, '+3902' || p_size || '123456' AS phone, CASE WHEN p_size % 7 = 0 THEN NULL ELSE 'site' || p_partkey || '.it/menu' END AS website, CASE WHEN p_size % 7 = 0 THEN NULL ELSE 'site' || p_partkey || '.it' END AS host FROM part")
def fn_contact_normalize(spark, sf_dir):
    url = F.when(F.col("p_size") % 7 == 0, "  ").otherwise(F.concat(F.lit(" HTTPS://WWW.Site"), F.col("p_partkey").cast("string"), F.lit(".IT/menu/ ")))
    return part(spark, sf_dir).select("p_partkey", text.phone(F.concat(F.lit("02 "), F.col("p_size").cast("string"), F.lit(".12-34 (56)"))).alias("phone"), text.website(url).alias("website"), text.host(url).alias("host"))


@query(r"SELECT page_id, regexp_extract(lower(url), '^[a-z]+://(?:www\.)?([^/?#]+)', 1) AS host FROM pages")
def fn_url_host(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.host(F.col("url")).alias("host"))


#: primary types and other types that parts stand for, by their size
KINDS = ["pizza_restaurant", "cafe", "hotel", "", "meal_takeaway", "museum"]


@query(f"""WITH k AS (SELECT p_partkey, list_extract({KINDS}, 1 + p_size % 6) AS a, list_extract({KINDS}, 1 + CAST(p_partkey % 6 AS INTEGER)) AS b FROM part),
t AS (SELECT *, CASE WHEN a IN ('pizza_restaurant', 'meal_takeaway') THEN 'restaurant' WHEN a = 'cafe' THEN 'cafe_bar_bakery' WHEN a IN ('hotel', 'museum') THEN 'non_dining' END AS ta, CASE WHEN b IN ('pizza_restaurant', 'meal_takeaway') THEN 'restaurant' WHEN b = 'cafe' THEN 'cafe_bar_bakery' WHEN b IN ('hotel', 'museum') THEN 'non_dining' END AS tb FROM k)
SELECT p_partkey, coalesce(ta, tb, 'unknown') AS tier FROM t""")
def fn_category_tier(spark, sf_dir):
    kinds = F.array(*[F.lit(k) for k in KINDS])
    pick = lambda c: F.element_at(kinds, (c % 6 + 1).cast("int"))
    return part(spark, sf_dir).select("p_partkey", cleaning.category_tier(pick(F.col("p_size")), F.array(pick(F.col("p_partkey")))).alias("tier"))


@query("SELECT p_partkey, array_to_string(list_filter([CASE WHEN p_size < 10 THEN 'small' END, CASE WHEN p_retailprice > 1500 THEN 'dear' END, CASE WHEN p_size % 2 = 0 THEN 'even' END], lambda x: x IS NOT NULL), ',') AS flags FROM part")
def fn_flags_array(spark, sf_dir):
    return part(spark, sf_dir).select("p_partkey", F.array_join(arrays.flags(("small", F.col("p_size") < 10), ("dear", F.col("p_retailprice") > 1500), ("even", F.col("p_size") % 2 == 0)), ",").alias("flags"))


@query("SELECT p_partkey, p_brand || '|' || p_name AS labels FROM part")
def fn_array_dedup(spark, sf_dir):
    return part(spark, sf_dir).select("p_partkey", F.array_join(arrays.split_labels(F.concat_ws(",", "p_brand", F.lower("p_brand"), F.concat(F.lit(" "), "p_name"), F.lit(" "), F.upper("p_name"))), "|").alias("labels"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def fn_date_parse(spark, sf_dir):
    months = F.array(*[F.lit(m) for m in numbers.MONTHS])
    written = F.concat_ws(" ", F.dayofmonth("o_orderdate").cast("string"), F.element_at(months, F.month("o_orderdate")), F.year("o_orderdate").cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", numbers.italian_date(written).alias("day"))


@query("SELECT p_partkey, lpad(CAST(((p_size * 37) % 1440) // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST((p_size * 37) % 60 AS VARCHAR), 2, '0') AS clock, p_size * 37 >= 1440 AS next_day FROM part")
def fn_hours_fold(spark, sf_dir):
    return part(spark, sf_dir).select("p_partkey", numbers.fold_hours(F.col("p_size") * 37).alias("x")).select("p_partkey", "x.clock", "x.next_day")


POINT = "45.35 + ((c_custkey * 7919) % 2300) / 10000.0::DOUBLE", "9.0 + ((c_custkey * 104729) % 3500) / 10000.0::DOUBLE"


@query(f"SELECT c_custkey, round({DISTANCE_SQL.format(a=f'({POINT[0]})', b=f'({POINT[1]})', c=45.4642, d=9.19)}, 4) AS metres FROM customer")
def fn_haversine(spark, sf_dir):
    return anchors(spark, sf_dir, plain=True).select(F.col("id").alias("c_custkey"), F.round(geo.haversine_m(F.col("latitude"), F.col("longitude"), F.lit(45.4642), F.lit(9.19)), 4).alias("metres"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def fn_json_fields(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query("SELECT page_id, count(*) AS links FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]+)\"', 1)) AS u FROM pages) GROUP BY page_id")
def fn_page_links(spark, sf_dir):
    links = F.regexp_extract_all("html", F.lit('href="([^"]+)"'), 1)
    return table(spark, sf_dir, "pages").select("page_id", F.size(links).cast("long").alias("links")).where("links > 0")


@query(r"""SELECT page_id, nullif(regexp_extract(html, '([A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]*[A-Za-z])', 1), '') AS email, nullif(trim(regexp_extract(html, '(\+\d{2}[\d ]{6,14}\d)', 1)), '') AS phone FROM pages""")
def fn_page_contacts(spark, sf_dir):
    html = F.col("html")
    return table(spark, sf_dir, "pages").select("page_id", pages.email_of(html).alias("email"), pages.phone_of(html).alias("phone"))


# record linkage


def anchors(spark, sf_dir, plain: bool = False):
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(k.alias("id"), F.col("c_nationkey").cast("string").alias("place"), (F.lit(45.35) + F.pmod(k * 7919, F.lit(2300)) / 10000).alias("latitude"), (F.lit(9.0) + F.pmod(k * 104729, F.lit(3500)) / 10000).alias("longitude"), (k % 37).alias("phone"), (k % 41).alias("website"), (k % 10 == 0).alias("is_chain"))
    return rows if plain else rows.join(part(spark, sf_dir).select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("street")), "id")


def sources(spark, sf_dir):
    k = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(k.alias("id"), (k * 3).alias("p_partkey"), F.col("s_nationkey").cast("string").alias("place"), (F.lit(45.35) + F.pmod(k * 6007, F.lit(2300)) / 10000).alias("latitude"), (F.lit(9.0) + F.pmod(k * 50021, F.lit(3500)) / 10000).alias("longitude"), (k % 37).alias("phone"), (k % 41).alias("website"), F.when(k % 2 == 0, "tripadvisor").otherwise("thefork").alias("source"))
    return rows.join(part(spark, sf_dir).select("p_partkey", F.col("p_name").alias("name"), F.col("p_brand").alias("street")), "p_partkey")


r = lambda digits, c: numbers.rounded(F.col(c), digits).alias(c)

RADIUS = 1500.0
BASE = f"""
WITH anchors AS (SELECT c_custkey AS id, CAST(c_nationkey AS VARCHAR) AS place, {POINT[0]} AS latitude, {POINT[1]} AS longitude, c_custkey % 37 AS phone, c_custkey % 41 AS website, c_custkey % 10 = 0 AS is_chain, p_name AS name, p_brand AS street FROM customer JOIN part ON p_partkey = c_custkey),
sources AS (SELECT s_suppkey AS id, CAST(s_nationkey AS VARCHAR) AS place, 45.35 + ((s_suppkey * 6007) % 2300) / 10000.0::DOUBLE AS latitude, 9.0 + ((s_suppkey * 50021) % 3500) / 10000.0::DOUBLE AS longitude, s_suppkey % 37 AS phone, s_suppkey % 41 AS website, CASE WHEN s_suppkey % 2 = 0 THEN 'tripadvisor' ELSE 'thefork' END AS source, p_name AS name, p_brand AS street FROM supplier JOIN part ON p_partkey = s_suppkey * 3),
pairs AS (SELECT a.id AS a_id, s.id AS s_id, {DISTANCE_SQL.format(a='a.latitude', b='a.longitude', c='s.latitude', d='s.longitude')} AS geo_dist_m FROM anchors a, sources s WHERE {DISTANCE_SQL.format(a='a.latitude', b='a.longitude', c='s.latitude', d='s.longitude')} <= {RADIUS}),
compared AS (SELECT DISTINCT a.x, s.y FROM (SELECT DISTINCT name AS x FROM anchors) a, (SELECT DISTINCT name AS y FROM sources) s UNION SELECT a.x, s.y FROM (SELECT DISTINCT street AS x FROM anchors) a, (SELECT DISTINCT street AS y FROM sources) s),
worded AS (SELECT x, y, list_sort(list_distinct(string_split(trim(regexp_replace(lower(x), '[[:punct:]\\s]+', ' ', 'g')), ' '))) AS p, list_sort(list_distinct(string_split(trim(regexp_replace(lower(y), '[[:punct:]\\s]+', ' ', 'g')), ' '))) AS q FROM compared),
parted AS (SELECT x, y, array_to_string(list_sort(list_intersect(p, q)), ' ') AS shared_w, array_to_string(list_filter(p, lambda w: NOT list_contains(q, w)), ' ') AS l, array_to_string(list_filter(q, lambda w: NOT list_contains(p, w)), ' ') AS r FROM worded),
joined AS (SELECT *, trim(shared_w || ' ' || l) AS one, trim(shared_w || ' ' || r) AS two FROM parted),
longest AS (SELECT *, list_reduce(list_transform(string_split(two, ''), lambda c: [ord(c)]), lambda line, c: list_reduce(list_transform(range(1, length(one) + 1), lambda j: [CAST(j AS INTEGER)]), lambda built, j: list_append(built, CASE WHEN ord(one[j[1]]) = c[1] THEN line[j[1]] + 1 ELSE greatest(line[j[1] + 1], built[-1]) END), [0]), list_transform(range(0, length(one) + 1), lambda j: 0))[-1] AS common FROM joined),
sims AS (SELECT x, y, CASE WHEN shared_w <> '' AND (l = '' OR r = '') THEN 1.0::DOUBLE WHEN shared_w <> '' THEN greatest(2.0::DOUBLE * common / (length(one) + length(two)), 2.0::DOUBLE * length(shared_w) / (length(shared_w) + length(one)), 2.0::DOUBLE * length(shared_w) / (length(shared_w) + length(two))) ELSE 2.0::DOUBLE * common / (length(one) + length(two)) END AS sim FROM longest),
features AS (SELECT a_id, s_id, source, geo_dist_m, n.sim AS name_sim,
  1 - least(geo_dist_m, 500) / 500 AS geo_score, t.sim AS street_sim, CAST(a.phone = s.phone AS DOUBLE) AS phone_match, CAST(a.website = s.website AS DOUBLE) AS website_match, a.is_chain, a.name AS a_name, s.name AS s_name
  FROM pairs JOIN anchors a ON a.id = a_id JOIN sources s ON s.id = s_id JOIN sims n ON n.x = a.name AND n.y = s.name JOIN sims t ON t.x = a.street AND t.y = s.street),
scored AS (SELECT *, CASE source WHEN 'tripadvisor' THEN .40 * name_sim + .25 * geo_score + .10 * street_sim + .15 * phone_match + .10 * website_match ELSE .50 * name_sim + .35 * geo_score + .15 * street_sim END AS score FROM features),
labelled AS (SELECT *, CASE WHEN score >= .6 THEN 'MATCH' WHEN score <= .2 THEN 'NON_MATCH' ELSE 'UNCERTAIN' END AS raw FROM scored),
hardened AS (SELECT *, CASE WHEN is_chain AND phone_match = 0 AND raw <> 'NON_MATCH' AND geo_dist_m > 75 THEN 'UNCERTAIN' ELSE raw END AS label, CASE WHEN is_chain AND phone_match = 0 AND raw <> 'NON_MATCH' AND geo_dist_m > 75 THEN 'chain_distance_gt_auto_match_radius' ELSE '' END AS hardening FROM labelled)
"""
THRESHOLDS = scoring.Thresholds(default=(0.2, 0.6))


#: What records are described by; columns beyond these are carried to their pairs.
KNOWN = ("id", "place", "latitude", "longitude", "phone", "website", "p_partkey", "name", "street")


def described(rows, k: str):
    """A side of the pairs, and the columns that a pair is judged by; names are normalised here, once a record."""
    more = [c for c in rows.columns if c not in KNOWN]
    out = rows.select("id", "latitude", "longitude", text.normal_name(F.col("name")).alias(f"{k}_words"), text.normal_name(F.col("street")).alias(f"{k}_street"), F.col("phone").alias(f"{k}_phone"), F.col("website").alias(f"{k}_website"), *more)
    return out, tuple(out.columns[3:])


def compared(spark, sf_dir):
    """The similarities of the names and of the streets of all records."""
    return similarity.Lookup(described(anchors(spark, sf_dir), "a")[0], described(sources(spark, sf_dir), "s")[0], {"words": "name_sim", "street": "street_sim"})


def features(spark, sf_dir, a=None, s=None, radius=RADIUS, names=None):
    """The pairs of anchors a and sources s (all, if not given) with their features and what else their records carry."""
    names = names or compared(spark, sf_dir)
    (a, of_a), (s, of_s) = described(anchors(spark, sf_dir) if a is None else a, "a"), described(sources(spark, sf_dir) if s is None else s, "s")
    both = names.added(blocking.geo_pairs(names.carried(a), names.carried(s), radius, of_a, of_s))
    both = both.withColumn("geo_score", similarity.geo_score(F.col("geo_dist_m")))
    equal = {c: F.col(f"a_{c}") == F.col(f"s_{c}") for c in ("phone", "website")}
    both = both.withColumns({f"{c}_equal": e for c, e in equal.items()} | {f"{c}_match": e.cast("double") for c, e in equal.items()})
    return both.drop(*[f"{k}_{c}" for k in "as" for c in equal])


def candidates(spark, sf_dir, a=None, s=None, radius=RADIUS, names=None):
    return scoring.labelled(features(spark, sf_dir, a, s, radius, names), THRESHOLDS)


def best_candidates(spark, sf_dir, k: int = 5):
    """The k best candidates of each source; only pairs that reach a score which k candidates close by have are ranked."""
    names = compared(spark, sf_dir)
    least = scoring.least_scores(candidates(spark, sf_dir, radius=RADIUS / 3, names=names), k)
    some = sources(spark, sf_dir).join(least.withColumnRenamed("s_id", "id"), ["source", "id"], "left")
    return scoring.top_candidates(scoring.reaching(candidates(spark, sf_dir, s=some, names=names)), k)


@query(BASE + "SELECT a_id, s_id, round(geo_dist_m, 3) AS geo_dist_m FROM pairs")
def er_geo_block(spark, sf_dir):
    return blocking.geo_pairs(anchors(spark, sf_dir), sources(spark, sf_dir), RADIUS).select("a_id", "s_id", r(3, "geo_dist_m"))


@query(BASE + "SELECT DISTINCT a.id AS a_id, s.id AS s_id FROM (SELECT id, place, unnest(string_split(lower(name), ' ')) AS w FROM anchors) a JOIN (SELECT id, place, unnest(string_split(lower(name), ' ')) AS w FROM sources) s ON a.place = s.place AND a.w = s.w AND length(a.w) >= 4")
def er_token_block(spark, sf_dir):
    return blocking.token_pairs(anchors(spark, sf_dir), sources(spark, sf_dir))


@query(BASE + "SELECT a_id, s_id, round(name_sim, 6) AS name_sim, round(geo_score, 6) AS geo_score, round(street_sim, 6) AS street_sim, phone_match, website_match FROM features")
def er_features(spark, sf_dir):
    return features(spark, sf_dir).select("a_id", "s_id", r(6, "name_sim"), r(6, "geo_score"), r(6, "street_sim"), "phone_match", "website_match")


@query(BASE + "SELECT DISTINCT a_name, s_name, round(name_sim, 6) AS name_sim FROM features")
def er_name_similarity(spark, sf_dir):
    """The token-set ratio of each distinct pair of names that meet."""
    met = blocking.geo_kinds(anchors(spark, sf_dir), sources(spark, sf_dir), RADIUS, "name")
    return met.select("a_name", "s_name", F.round(similarity.token_set(F.col("a_name"), F.col("s_name")), 6).alias("name_sim"))


@query(BASE + """, located AS (SELECT * REPLACE (CASE WHEN id % 3 = 0 THEN NULL ELSE latitude END AS latitude, CASE WHEN id % 2 = 0 THEN '' ELSE place END AS place) FROM sources)
SELECT a_id, s_id, 'geo' AS block_source FROM pairs WHERE s_id % 3 <> 0
UNION ALL SELECT DISTINCT a.id, s.id, 'postal_code' FROM (SELECT id, place, unnest(string_split(lower(name), ' ')) AS w FROM anchors) a JOIN (SELECT id, place, unnest(string_split(lower(name), ' ')) AS w FROM located WHERE latitude IS NULL AND place <> '') s ON a.place = s.place AND a.w = s.w AND length(a.w) >= 4
UNION ALL SELECT NULL, id, 'unblockable' FROM located WHERE latitude IS NULL AND place = ''""")
def er_blocks(spark, sf_dir):
    """All candidates by the block that they come from; sources without coordinates and place stay as rows of their own."""
    some = sources(spark, sf_dir).withColumn("latitude", F.when(F.col("id") % 3 != 0, F.col("latitude"))).withColumn("place", F.when(F.col("id") % 2 == 0, "").otherwise(F.col("place")))
    return blocking.blocked(anchors(spark, sf_dir), some, RADIUS).select("a_id", "s_id", "block_source")


BRANDS = ["red", "blue", "small"]


@query(BASE + """, branded AS (SELECT a_id, s_id, """ + ", ".join(f"CASE {' '.join(f"WHEN {k}_name = '{b}' OR {k}_name LIKE '{b} %' THEN '{b}'" for b in BRANDS)} END AS {k}_brand" for k in "as") + """ FROM features)
SELECT a_id, s_id, CASE WHEN a_brand IS NULL OR s_brand IS NULL OR a_brand = s_brand THEN coalesce(a_brand, s_brand) ELSE least(a_brand, s_brand) || '|' || greatest(a_brand, s_brand) END AS brand FROM branded WHERE coalesce(a_brand, s_brand) IS NOT NULL""")
def er_chain_brands(spark, sf_dir):
    """The brand of each pair of which a side belongs to a chain."""
    branded = lambda rows, k: rows.withColumn(f"{k}_brand", text.chain_brand(F.col("name"), BRANDS))
    pairs = blocking.geo_pairs(branded(anchors(spark, sf_dir), "a"), branded(sources(spark, sf_dir), "s"), RADIUS, ("a_brand",), ("s_brand",))
    return pairs.select("a_id", "s_id", text.pair_brand(F.col("a_brand"), F.col("s_brand")).alias("brand")).where("brand is not null")


@query(BASE + "SELECT a_id, s_id, round(score, 6) AS score, raw AS label FROM labelled")
def er_score_label(spark, sf_dir):
    scored = features(spark, sf_dir).withColumn("score", scoring.score(F.col("source")))
    return scored.select("a_id", "s_id", r(6, "score"), scoring.label(F.col("score"), F.lit(0.2), F.lit(0.6)).alias("label"))


@query(BASE + "SELECT a_id, s_id, label, hardening FROM hardened WHERE is_chain")
def er_chain_rules(spark, sf_dir):
    return candidates(spark, sf_dir, a=anchors(spark, sf_dir).where("is_chain")).select("a_id", "s_id", "label", F.array_join("chain_hardening", ",").alias("hardening"))


@query(BASE + "SELECT source, label, count(*) AS n FROM hardened GROUP BY 1, 2")
def er_label_counts(spark, sf_dir):
    return candidates(spark, sf_dir).groupBy("source", "label").agg(F.count(F.lit(1)).alias("n"))


def matches(spark, sf_dir, a=None, s=None, radius=RADIUS, names=None):
    return candidates(spark, sf_dir, a, s, radius, names).where("label <> 'NON_MATCH'")


def ranked_matches(matched):
    """What greedy selection asks of matches. They move first: ranks are built for few, outside the loop over all pairs."""
    c = matched.select("a_id", "s_id", "score", "fast_path", "geo_dist_m", "name_sim").repartition("s_id")
    return c.select("a_id", "s_id", F.concat_ws(":", "a_id", "s_id").alias("pair_id"), F.lit(False).alias("overridden"), "score", F.col("fast_path").isNotNull().alias("fast"), "geo_dist_m", "name_sim")


#: Greedy selection as it is defined: pair by pair, the best first, unless one of its sides is taken.
GREEDY = BASE.replace("WITH anchors", "WITH RECURSIVE anchors") + """, ordered AS MATERIALIZED (SELECT row_number() OVER (ORDER BY score DESC, geo_dist_m, name_sim DESC, a_id || ':' || s_id DESC) AS k, a_id, s_id, score FROM hardened WHERE label <> 'NON_MATCH'),
taken AS (SELECT 0::BIGINT AS k, 0::BIGINT AS a_id, 0::BIGINT AS s_id, 0::DOUBLE AS score, []::BIGINT[] AS used_a, []::BIGINT[] AS used_s, false AS ok
  UNION ALL SELECT o.k, o.a_id, o.s_id, o.score, CASE WHEN t.ok THEN list_append(t.used_a, t.a_id) ELSE t.used_a END, CASE WHEN t.ok THEN list_append(t.used_s, t.s_id) ELSE t.used_s END,
    NOT list_contains(CASE WHEN t.ok THEN list_append(t.used_a, t.a_id) ELSE t.used_a END, o.a_id) AND NOT list_contains(CASE WHEN t.ok THEN list_append(t.used_s, t.s_id) ELSE t.used_s END, o.s_id)
  FROM taken t JOIN ordered o ON o.k = t.k + 1)
SELECT a_id, s_id, round(score, 6) AS score FROM taken WHERE ok"""


#: So many pairs of a source are ranked before it is known which of them its anchors take.
LISTED = 16


@query(GREEDY)
def er_one_to_one_links(spark, sf_dir):
    names = compared(spark, sf_dir)

    def fetch(ids):
        some = sources(spark, sf_dir)
        if ids is not None:
            return ranked_matches(matches(spark, sf_dir, s=some.join(ids.withColumnRenamed("s_id", "id"), "id", "left_semi"), names=names))
        least = scoring.least_scores(matches(spark, sf_dir, radius=RADIUS / 3, names=names), LISTED)
        some = some.join(least.withColumnRenamed("s_id", "id"), ["source", "id"], "left")
        return ranked_matches(scoring.reaching(matches(spark, sf_dir, s=some, names=names)))

    return linking.one_to_one(fetch(None), LISTED, fetch).select("a_id", "s_id", r(6, "score"))


@query(BASE + "SELECT a_id, s_id, count(*) OVER (PARTITION BY a_id) - 1 AS n_same_a, count(*) OVER (PARTITION BY s_id) - 1 AS n_same_s FROM hardened WHERE label <> 'NON_MATCH'")
def er_competitors(spark, sf_dir):
    names = compared(spark, sf_dir)
    per_a, per_s = linking.competing(matches(spark, sf_dir, names=names))
    a, s = anchors(spark, sf_dir).join(per_a.withColumnRenamed("a_id", "id"), "id"), sources(spark, sf_dir).join(per_s.withColumnRenamed("s_id", "id"), "id")
    return matches(spark, sf_dir, a, s, names=names).select("a_id", "s_id", "n_same_a", "n_same_s")


TOP = ", topped AS (SELECT *, row_number() OVER (PARTITION BY source, s_id ORDER BY score DESC, geo_dist_m, name_sim DESC, a_id) AS rank_no FROM hardened)"


@query(BASE + TOP + "SELECT source, s_id, a_id, CAST(rank_no AS INTEGER) AS rank_no FROM topped WHERE rank_no <= 5")
def er_topk_groups(spark, sf_dir):
    return best_candidates(spark, sf_dir).select("source", "s_id", "a_id", "rank_no")


@query(BASE + TOP + """, g AS (SELECT b.source, b.s_id, b.a_id, b.geo_dist_m AS d, b.name_sim AS name, b.street_sim AS street, b.phone_match + b.website_match > 0 AS contact, s.name_sim AS name2, s.geo_dist_m AS d2 FROM topped b LEFT JOIN topped s ON s.source = b.source AND s.s_id = b.s_id AND s.rank_no = 2 WHERE b.rank_no = 1),
h AS (SELECT *, CASE WHEN coalesce(name2 >= .75 AND d2 <= 100 AND name >= .75, false) THEN 'UNCERTAIN' WHEN contact AND d <= 1000 THEN 'MATCH' WHEN d <= 50 AND (name >= .75 OR street >= .8) THEN 'MATCH' WHEN d > 300 THEN 'NON_MATCH' ELSE 'UNCERTAIN' END AS decision FROM g)
SELECT source, s_id, a_id, decision, CASE WHEN decision = 'MATCH' AND (d > 1000 OR (d > 150 AND NOT contact)) THEN 'UNCERTAIN' ELSE decision END AS final_decision FROM h""")
def er_policy(spark, sf_dir):
    decided = scoring.policy(scoring.decide(best_candidates(spark, sf_dir)))
    return decided.select("source", "s_id", "a_id", "decision", "final_decision")


# integration


@query("""SELECT c_custkey AS id, n_name AS nation, count(o_orderkey) AS n_docs, c_mktsegment = 'BUILDING' AS has_link, c_mktsegment = 'BUILDING' AND count(o_orderkey) = 0 AS missing_source_doc
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN orders ON o_custkey = c_custkey AND c_mktsegment = 'BUILDING' GROUP BY c_custkey, c_mktsegment, n_name""")
def int_star_join(spark, sf_dir):
    """Seeds with all that is linked to them; a link whose document is missing raises a flag."""
    seeds = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_nationkey", (F.col("c_mktsegment") == "BUILDING").alias("has_link"))
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("int").alias("c_nationkey"), F.col("n_name").alias("nation"))
    docs = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    out = seeds.join(nations, "c_nationkey", "left").join(docs, "id", "left")
    n = F.when(F.col("has_link"), F.coalesce("n", F.lit(0))).otherwise(0)
    return out.select("id", "nation", n.alias("n_docs"), "has_link", (F.col("has_link") & (n == 0)).alias("missing_source_doc"))


VOTES = "CASE WHEN p_size % 4 > 0 THEN list_extract(['INEXPENSIVE', 'MODERATE', 'EXPENSIVE'], p_size % 4) END AS a, CASE WHEN p_size % 3 > 0 THEN list_extract(['INEXPENSIVE', 'MODERATE'], p_size % 3) END AS b, CASE WHEN p_retailprice <= 1000 THEN 'INEXPENSIVE' WHEN p_retailprice <= 1400 THEN 'MODERATE' WHEN p_retailprice <= 1800 THEN 'EXPENSIVE' END AS c"


@query(f"""WITH v AS (SELECT p_partkey, {VOTES} FROM part), u AS (SELECT p_partkey, 1 AS k, 'google' AS source, a AS level FROM v UNION ALL SELECT p_partkey, 2, 'tripadvisor', b FROM v UNION ALL SELECT p_partkey, 3, 'thefork', c FROM v),
n AS (SELECT p_partkey, level, count(*) AS n, arg_min(source, k) AS source FROM u WHERE level IS NOT NULL GROUP BY 1, 2), m AS (SELECT p_partkey, max(n) AS most FROM n GROUP BY 1),
w AS (SELECT p_partkey, string_agg(level, ' / ' ORDER BY level) AS price_level, CASE WHEN count(*) > 1 THEN 'tie' WHEN any_value(most) > 1 THEN 'majority' ELSE any_value(source) END AS price_level_source FROM n JOIN m USING (p_partkey) WHERE n = most GROUP BY 1)
SELECT p_partkey, coalesce(price_level, '') AS price_level, price_level_source FROM part LEFT JOIN w USING (p_partkey)""")
def int_price_vote(spark, sf_dir):
    price = F.col("p_retailprice")
    rows = part(spark, sf_dir).select(
        "p_partkey",
        F.when(F.col("p_size") % 4 > 0, F.element_at(F.array(F.lit("INEXPENSIVE"), F.lit("MODERATE"), F.lit("EXPENSIVE")), F.nullif((F.col("p_size") % 4).cast("int"), F.lit(0)))).alias("a"),
        F.when(F.col("p_size") % 3 > 0, F.element_at(F.array(F.lit("INEXPENSIVE"), F.lit("MODERATE")), F.nullif((F.col("p_size") % 3).cast("int"), F.lit(0)))).alias("b"),
        F.when(price <= 1000, "INEXPENSIVE").when(price <= 1400, "MODERATE").when(price <= 1800, "EXPENSIVE").alias("c"),
    )
    return rows.select("p_partkey", arrays.price_vote(F.col("a"), F.col("b"), F.col("c")).alias("v")).select("p_partkey", arrays.joined(F.col("v.levels")).alias("price_level"), F.col("v.source").alias("price_level_source"))


@query("""WITH v AS (SELECT p_partkey, CASE WHEN p_size % 5 > 0 THEN 'https://www.s' || p_size || '.it/' || (p_partkey % 2) END AS a, CASE WHEN p_size % 7 > 0 THEN 'https://s' || (p_size - p_size % 2) || '.it/' || (p_partkey % 3) END AS b FROM part),
h AS (SELECT *, regexp_replace(regexp_replace(a, '^https://(www\\.)?', ''), '/.*$', '') AS ha, regexp_replace(regexp_replace(b, '^https://(www\\.)?', ''), '/.*$', '') AS hb, replace(replace(a, 'https://', ''), 'www.', '') AS wa, replace(replace(b, 'https://', ''), 'www.', '') AS wb FROM v)
SELECT p_partkey, CASE WHEN a IS NULL AND b IS NULL THEN 'missing' WHEN a IS NULL OR b IS NULL THEN 'single_source' WHEN wa = wb THEN 'exact_match' WHEN ha = hb THEN 'host_match' ELSE 'conflict' END AS website_status FROM h""".replace("\\\\", "\\"))
def int_contact_status(spark, sf_dir):
    size, key = F.col("p_size"), F.col("p_partkey")
    a = F.when(size % 5 > 0, F.concat(F.lit("https://www.s"), size.cast("string"), F.lit(".it/"), (key % 2).cast("string")))
    b = F.when(size % 7 > 0, F.concat(F.lit("https://s"), (size - size % 2).cast("string"), F.lit(".it/"), (key % 3).cast("string")))
    return part(spark, sf_dir).select("p_partkey", arrays.website_status(text.website(a), text.website(b), text.host(a), text.host(b)).alias("website_status"))


#: label -> how specific it is: umbrella names below what they cover
SPECIFICITY = {"Italian": 1, "Asian": 1, "Pizza": 3, "Chinese": 2, "Sushi": 3}
_L = list(SPECIFICITY)


@query(f"""WITH v AS (SELECT p_partkey, list_extract({_L}, 1 + p_size % 5) AS a, list_extract({_L}, 1 + CAST(p_partkey % 5 AS INTEGER)) AS b, CASE WHEN p_size % 3 = 0 THEN list_extract({_L}, 1 + (p_size // 3) % 5) END AS c FROM part),
u AS (SELECT p_partkey, 1 AS k, 'tripadvisor' AS source, a AS label FROM v UNION ALL SELECT p_partkey, 2, 'thefork', b FROM v UNION ALL SELECT p_partkey, 3, 'google', c FROM v),
r AS (SELECT *, CASE label WHEN 'Pizza' THEN 3 WHEN 'Sushi' THEN 3 WHEN 'Chinese' THEN 2 ELSE 1 END AS s FROM u WHERE label IS NOT NULL)
SELECT p_partkey, string_agg(DISTINCT label, '|' ORDER BY label) AS tags, arg_max(label, s * 10 - k) AS primary_label, arg_max(source, s * 10 - k) AS primary_source, CAST(count(*) AS INTEGER) AS n_sources, CASE WHEN count(*) = 1 THEN 'single' WHEN count(DISTINCT label) = 1 THEN 'agree' ELSE 'disagree' END AS agreement FROM r GROUP BY 1""")
def int_cuisine_merge(spark, sf_dir):
    names = F.array(*[F.lit(x) for x in _L])
    pick = lambda k: F.array(F.element_at(names, (k + 1).cast("int")))
    merged = arrays.merged_labels([("tripadvisor", pick(F.col("p_size") % 5)), ("thefork", pick(F.col("p_partkey") % 5)), ("google", F.when(F.col("p_size") % 3 == 0, pick(F.floor(F.col("p_size") / 3) % 5)))], SPECIFICITY)
    return part(spark, sf_dir).select("p_partkey", merged.alias("m")).select("p_partkey", F.array_join("m.tags", "|").alias("tags"), F.col("m.primary").alias("primary_label"), "m.primary_source", "m.n_sources", "m.agreement")


@query(SQL + "SELECT id, rating_platform_count, round(rating_avg_5, 3) AS rating_avg_5, round(rating_range_5, 3) AS rating_range_5 FROM listing")
def int_rating_metrics(spark, sf_dir):
    return listing(spark, sf_dir, "lines").select("id", "rating_platform_count", F.round("rating_avg_5", 3).alias("rating_avg_5"), F.round("rating_range_5", 3).alias("rating_range_5"))


@query(SQL + "SELECT id, name, coalesce(primary_cuisine, '') AS primary_cuisine, CAST(website <> '' AS INTEGER) AS has_website, has_google, has_tripadvisor, has_thefork, coalesce(CAST(price_tier AS VARCHAR), '') AS price_level, coalesce(google_review_count, 0) AS google_review_count FROM listing")
def flat_projection(spark, sf_dir):
    return listing(spark, sf_dir, "orders").select("id", "name", arrays.text_or_empty(F.col("primary_cuisine")).alias("primary_cuisine"), arrays.present(F.col("website")).alias("has_website"), *[f"has_{p}" for p in PLATFORMS], arrays.text_or_empty(F.col("price_tier")).alias("price_level"), F.coalesce("google_review_count", F.lit(0)).alias("google_review_count"))


# quality and assessment

FIELDS = ["name", "primary_cuisine", "website", "google_rating_5", "tripadvisor_rating_5", "thefork_rating_5", "price_tier"]


def pct(a: str, b: str) -> str:
    return f"coalesce(CASE WHEN {a} < {b} AND round({a} * 100.0 / nullif({b}, 0), 2) = 100 THEN 99.99 ELSE round({a} * 100.0 / nullif({b}, 0), 2) END, 0)"


@query(SQL + "SELECT field, present, records, " + pct("present", "records") + " AS coverage_pct FROM (" + " UNION ALL ".join(f"SELECT '{f}' AS field, count(*) FILTER ({f} IS NOT NULL AND CAST({f} AS VARCHAR) <> '') AS present, count(*) AS records FROM listing" for f in FIELDS) + ")")
def dq_field_coverage(spark, sf_dir):
    return profile.field_coverage(listing(spark, sf_dir, "orders"), FIELDS)


@query(r"""WITH r AS (SELECT page_id, url, regexp_extract(html, '[A-Za-z0-9._]+@[A-Za-z0-9.]+') AS mail, CAST(page_id % 7 - 1 AS VARCHAR) AS rating FROM pages)
SELECT field, checked, valid, """ + pct("valid", "checked") + r""" AS validity_pct FROM (
SELECT 'url' AS field, count(*) FILTER (url <> '') AS checked, count(*) FILTER (regexp_matches(url, '^https?://[^\s]+$')) AS valid FROM r
UNION ALL SELECT 'mail', count(*) FILTER (mail <> ''), count(*) FILTER (regexp_matches(mail, '^[^@\s]+@[^@\s]+\.[^@\s]+$')) FROM r
UNION ALL SELECT 'rating', count(*), count(*) FILTER (CAST(rating AS DOUBLE) BETWEEN 0 AND 5) FROM r)""")
def dq_validity(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", "url", F.regexp_extract("html", "[A-Za-z0-9._]+@[A-Za-z0-9.]+", 0).alias("mail"), (F.col("page_id") % 7 - 1).cast("string").alias("rating"))
    return profile.validity(rows, {"url": "url", "mail": "email", "rating": "rating"})


@query(SQL + """SELECT id AS record_id, issue_type, field, value FROM (
SELECT id, 'missing_critical_field' AS issue_type, 'website' AS field, website AS value FROM listing WHERE website = ''
UNION ALL SELECT id, 'low_review_count', 'google_review_count', CAST(google_review_count AS VARCHAR) FROM listing WHERE google_review_count > 0 AND google_review_count < 20
UNION ALL SELECT id, 'invalid_rating', 'rating_range_5', '' FROM listing WHERE rating_range_5 IS NULL)""")
def dq_anomalies(spark, sf_dir):
    reviews = F.col("google_review_count")
    rules = [("missing_critical_field", "website", F.col("website") == ""), ("low_review_count", "google_review_count", (reviews > 0) & (reviews < 20)), ("invalid_rating", "rating_range_5", F.col("rating_range_5").isNull())]
    return profile.anomalies(listing(spark, sf_dir, "lines"), "id", rules)


@query("SELECT p_name, p_brand, count(*) AS n, count(*) - 1 AS excess FROM part GROUP BY 1, 2 HAVING count(*) > 1")
def dq_duplicates(spark, sf_dir):
    return profile.duplicates(part(spark, sf_dir), ["p_name", "p_brand"])


@query(SQL + """, s AS (SELECT city, count(*) AS n, count(*) FILTER (website <> '') AS w, count(*) FILTER (rating_avg_5 IS NOT NULL) AS v, count(*) FILTER (google_review_count >= 20) AS r FROM listing GROUP BY city),
x AS (SELECT city, """ + f"{pct('w', 'n')} AS critical_completeness, {pct('v', 'n')} AS validity, {pct('r', 'n')} AS reliability FROM s)" + """
SELECT city, critical_completeness, validity, reliability, round(.25 * critical_completeness + .20 * validity + .15 * 100 + .15 * 100 + .10 * 50 + .15 * reliability, 2) AS overall FROM x""")
def dq_scores(spark, sf_dir):
    counted = listing(spark, sf_dir).groupBy("city").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("website") != "").alias("w"), F.count_if(F.col("rating_avg_5").isNotNull()).alias("v"), F.count_if(F.col("google_review_count") >= 20).alias("r"))
    parts = {"critical_completeness": numbers.capped_pct(F.col("w"), F.col("n")), "validity": numbers.capped_pct(F.col("v"), F.col("n")), "reliability": numbers.capped_pct(F.col("r"), F.col("n"))}
    fixed = {"spatial_readiness": F.lit(100.0), "uniqueness": F.lit(100.0), "timeliness": numbers.refreshability(F.lit(12.0), 24.0)}
    return counted.select("city", *[c.alias(k) for k, c in parts.items()], profile.overall(parts | fixed).alias("overall"))


GOLD = "SELECT labels.doc_id, lang, quality = 1 AS truth, least(n_chars, 4000) / 4000.0::DOUBLE AS score, CASE WHEN n_chars >= 2000 THEN 'MATCH' WHEN n_chars < 500 THEN 'NON_MATCH' ELSE 'UNCERTAIN' END AS label FROM labels JOIN documents USING (doc_id)"


def gold(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    chars = F.col("n_chars")
    return table(spark, sf_dir, "labels").join(docs, "doc_id").select("doc_id", "lang", (F.col("quality") == 1).alias("truth"), (F.least(chars, F.lit(4000)) / 4000).alias("score"), F.when(chars >= 2000, "MATCH").when(chars < 500, "NON_MATCH").otherwise("UNCERTAIN").alias("label"))


@query(f"""WITH g AS ({GOLD}), c AS (SELECT coalesce(lang, 'all') AS lang, count(*) FILTER (truth AND label = 'MATCH') AS tp, count(*) FILTER (NOT truth AND label = 'MATCH') AS fp, count(*) FILTER (truth AND label = 'NON_MATCH') AS fn, count(*) FILTER (NOT truth AND label = 'NON_MATCH') AS tn, count(*) FILTER (truth AND label = 'UNCERTAIN') AS up, count(*) FILTER (NOT truth AND label = 'UNCERTAIN') AS un FROM g GROUP BY ROLLUP (lang)),
r AS (SELECT *, tp / nullif(tp + fp, 0) AS p, tp / nullif(tp + fn + up, 0) AS r FROM c)
SELECT lang, tp, fp, fn, tn, up, un, round(p, 6) AS precision, round(r, 6) AS strict_recall, round((tp + up) / nullif(tp + fn + up, 0), 6) AS kept_recall, round(2 * p * r / nullif(p + r, 0), 6) AS f1, round((tp + tn) / (tp + fp + fn + tn + up + un), 6) AS accuracy, round((up + un) / (tp + fp + fn + tn + up + un), 6) AS uncertain_rate FROM r""")
def as_confusion(spark, sf_dir):
    return assess.confusion(gold(spark, sf_dir), "lang")


GRID = f"""WITH g AS ({GOLD}), t AS (SELECT CAST(a.i AS INTEGER) AS lo, CAST(b.i AS INTEGER) AS hi FROM range(21) a(i), range(21) b(i) WHERE a.i < b.i)
SELECT lo, hi, count(*) FILTER (truth AND floor(round(score * 20, 9)) >= hi) AS tp, count(*) FILTER (NOT truth AND floor(round(score * 20, 9)) >= hi) AS fp, count(*) FILTER (truth AND ceil(round(score * 20, 9)) <= lo) AS fn, count(*) FILTER (floor(round(score * 20, 9)) < hi AND ceil(round(score * 20, 9)) > lo) AS uncertain FROM g, t GROUP BY 1, 2"""


@query(GRID)
def as_threshold_grid(spark, sf_dir):
    return assess.threshold_grid(gold(spark, sf_dir), 20).select("lo", "hi", "tp", "fp", "fn", "uncertain")


@query(f"WITH g AS ({GOLD}), f AS (SELECT doc_id % 5 AS fold, count(*) FILTER (truth AND label = 'MATCH') / nullif(count(*) FILTER (label = 'MATCH'), 0) AS p FROM g GROUP BY 1) SELECT count(*) AS folds, round(avg(p), 6) AS mean, round(stddev_pop(p), 6) AS sd FROM f")
def as_kfold(spark, sf_dir):
    per = gold(spark, sf_dir).groupBy((F.col("doc_id") % 5).alias("fold")).agg(F.try_divide(F.count_if(F.col("truth") & (F.col("label") == "MATCH")), F.count_if(F.col("label") == "MATCH")).alias("p"))
    return assess.fold_summary(per, "p")


@query("""SELECT count(*) AS confirmed, count(*) FILTER (o_custkey IS NOT NULL) AS linked, count(*) FILTER (linked_lines > 0) AS integrated, round(100.0 * count(*) FILTER (linked_lines > 0) / count(*), 6) AS survival_pct
FROM (SELECT c_custkey, o_custkey, linked_lines FROM customer LEFT JOIN (SELECT o_custkey, count(l_orderkey) AS linked_lines FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45) ON l_orderkey = o_orderkey GROUP BY 1) ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING')""")
def as_survival(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R' and l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("hit", F.lit(1))
    links = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(lines, "o_orderkey", "left").groupBy("o_custkey").agg(F.count("hit").alias("hits"))
    traced = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("id")).join(links.withColumnRenamed("o_custkey", "id").withColumn("linked", F.lit(True)), "id", "left")
    kept = F.count_if(F.coalesce(F.col("hits"), F.lit(0)) > 0)
    return traced.agg(F.count(F.lit(1)).alias("confirmed"), F.count_if(F.col("linked").isNotNull()).alias("linked"), kept.alias("integrated"), F.round(100 * kept / F.count(F.lit(1)), 6).alias("survival_pct"))


@query(BASE + ", e AS (SELECT source, list_sort(list(round(geo_dist_m, 3))) AS d FROM pairs JOIN sources ON id = s_id GROUP BY 1) SELECT source, len(d) AS n, list_extract(d, 1 + CAST(round_even((len(d) - 1) * 0.5, 0) AS INTEGER)) AS p50, list_extract(d, 1 + CAST(round_even((len(d) - 1) * 0.9, 0) AS INTEGER)) AS p90, d[-1] AS worst FROM e")
def as_geo_error(spark, sf_dir):
    places = blocking.geo_places(anchors(spark, sf_dir), sources(spark, sf_dir), RADIUS, of_s=("source",))
    counted = places.groupBy("source", r(3, "geo_dist_m")).agg(F.sum(F.size("members").cast("long")).alias("times"))
    return assess.ranked(counted, ["source"], "geo_dist_m", {"p50": 0.5, "p90": 0.9}).select("source", "n", "p50", "p90", "worst")


@query(f"""WITH g AS ({GOLD}), r AS (SELECT *, md5(doc_id || ':0') AS h, row_number() OVER (PARTITION BY lang, label ORDER BY md5(doc_id || ':0'), doc_id) AS r FROM g),
q AS (SELECT greatest(1, 60 // count(*)) AS quota FROM (SELECT DISTINCT lang, label FROM g)) SELECT doc_id, lang, label FROM r, q ORDER BY greatest(r - quota, 0), h, doc_id LIMIT 60""")
def as_stratified_sample(spark, sf_dir):
    return maintenance.stratified(gold(spark, sf_dir), ["lang", "label"], "doc_id", 60).select("doc_id", "lang", "label")


# maintenance and streams


@query("SELECT p_name, p_partkey, p_size FROM (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY (p_size > 10)::INTEGER + (p_retailprice > 1200)::INTEGER DESC, p_partkey) AS k FROM part) WHERE k = 1")
def mt_dedup_richest(spark, sf_dir):
    rich = (F.col("p_size") > 10).cast("int") + (F.col("p_retailprice") > 1200).cast("int")
    return maintenance.first_per_key(part(spark, sf_dir), ["p_name"], [F.desc(rich), F.asc("p_partkey")]).select("p_name", "p_partkey", "p_size")


UPSERT = "WITH old AS (SELECT c_custkey AS k, 0 AS seq, c_mktsegment AS v FROM customer WHERE c_acctbal > 0), new AS (SELECT o_custkey AS k, o_orderkey AS seq, o_orderpriority AS v FROM orders), last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY seq DESC) AS r FROM new) WHERE r = 1)"


def both_versions(spark, sf_dir):
    old = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k"), F.lit(0).cast("long").alias("seq"), F.col("c_mktsegment").alias("v"))
    new = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("seq"), F.col("o_orderpriority").alias("v"))
    return old, new


@query(UPSERT + "SELECT k, seq, v FROM last UNION ALL SELECT k, seq, v FROM old WHERE k NOT IN (SELECT k FROM last)")
def mt_upsert_last_wins(spark, sf_dir):
    return maintenance.upsert(*both_versions(spark, sf_dir), "k", "seq")


@query(UPSERT + "SELECT k, seq, v FROM last WHERE k NOT IN (SELECT k FROM old WHERE v = 'BUILDING') UNION ALL SELECT k, seq, v FROM old WHERE v = 'BUILDING' OR k NOT IN (SELECT k FROM last)")
def mt_protected_upsert(spark, sf_dir):
    return maintenance.protected_upsert(*both_versions(spark, sf_dir), "k", "seq", F.col("v") == "BUILDING")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def mt_stale_antijoin(spark, sf_dir):
    return maintenance.stale(table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 10)")
def mt_worklist(spark, sf_dir):
    done = table(spark, sf_dir, "lineitem").where("l_quantity > 10").select(F.col("l_orderkey").alias("o_orderkey"))
    return maintenance.worklist(table(spark, sf_dir, "orders").select("o_orderkey"), done, "o_orderkey", "o_orderkey")


@query("SELECT CAST(a.i AS INTEGER) AS row, CAST(b.i AS INTEGER) AS col, round(45.4642 + a.i * 500 / 111320.0::DOUBLE, 8) AS latitude, round(9.19 + b.i * 500 / (111320.0::DOUBLE * cos(radians(45.4642))), 8) AS longitude FROM range(-10, 11) a(i), range(-10, 11) b(i) WHERE sqrt(a.i * a.i + b.i * b.i) * 500 <= 5000")
def geo_tile_grid(spark, sf_dir):
    return geo.tile_grid(spark, 45.4642, 9.19, 5000, 500).select("row", "col", F.round("latitude", 8).alias("latitude"), F.round("longitude", 8).alias("longitude"))


@query("WITH e AS (SELECT event_id, user_id, epoch_us(ts) AS t FROM events WHERE event_type = 'error') SELECT a.event_id, count(DISTINCT b.user_id) AS distinct_keys, count(DISTINCT b.user_id) >= 3 AS alarm FROM e a JOIN e b ON b.t <= a.t AND b.t >= a.t - 3600000000 GROUP BY 1")
def st_sliding_alarm(spark, sf_dir):
    return flows.sliding_alarm(table(spark, sf_dir, "events").where("event_type = 'error'"), "event_id", "user_id", "ts", 3600, 3)
