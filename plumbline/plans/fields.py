"""Queries of field functions: texts are composed of columns, so that the SQL can say what has to come out without taking them apart."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import arrays, geo, numbers, pages, text
from plumbline.operators import blocking, cleaning, maintenance
from plumbline.plans.listing import table
from plumbline.plans.records import part

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return add


def columns():
    """Key, size, name, brand and type of a part."""
    return [F.col(c) for c in ("p_partkey", "p_size", "p_name", "p_brand", "p_type")]


def as_text(c):
    return c.cast("string")


def code(key):
    return F.lpad(as_text(key % 1000), 5, "20")


lit, CODE = F.lit, "lpad(CAST(p_partkey % 1000 AS VARCHAR), 5, '20')"


def fields(spark, sf_dir, **columns):
    return part(spark, sf_dir).select("p_partkey", *[c.alias(k) for k, c in columns.items()])


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'D''Amare ' || upper(left(p_brand, 1)) || lower(substring(p_brand, 2)) ELSE 'D''amare ' || p_brand END AS shown, p_name || ' & ' || p_brand AS squeezed FROM part")
def fn_display_name(spark, sf_dir):
    _, size, name, brand, _ = columns()
    shouted = F.when(size % 2 == 0, F.upper(F.concat(lit("d'amare  "), brand))).otherwise(F.concat(lit(" D'amare "), brand, lit("\t")))
    return fields(spark, sf_dir, shown=text.display_name(shouted), squeezed=text.squeeze(F.concat(lit("  "), name, lit(" \n&  "), brand)))


@query(f"""SELECT p_partkey, 'Via Roma, ' || p_size || ', ' || {CODE} || ' Milano, Italia' AS address, 'Via Roma, ' || p_size AS street, {CODE} AS postal_code, 'Milano' AS city FROM part""")
def fn_address_parts(spark, sf_dir):
    key, size, _, _, _ = columns()
    address = text.normal_address(F.concat(lit(" Via Roma ,"), as_text(size), lit(" ,  "), F.when(size % 2 == 0, "I-").otherwise(""), code(key), F.when(size % 3 == 0, " Milan").otherwise("  Milano"), F.when(size % 5 == 0, " , Italy ,").otherwise(", Italia")))
    return fields(spark, sf_dir, address=address, parts=text.address_parts(address)).select("p_partkey", "address", "parts.*")


@query(f"SELECT p_partkey, 'Corso ' || p_brand AS street, CAST(p_size AS VARCHAR) AS number, {CODE} AS code, CASE WHEN p_size > 10 THEN 'Italia' END AS country FROM part")
def fn_address_components(spark, sf_dir):
    key, size, _, brand, _ = columns()
    piece = lambda kind_, value: F.struct(value.alias("longText"), F.array(lit("political"), lit(kind_)).alias("types"))
    parts = F.array(piece("route", F.concat(lit("Corso "), brand)), piece("street_number", as_text(size)), piece("postal_code", code(key)), piece("country", F.when(size > 10, "Italia")))
    return fields(spark, sf_dir, **{alias: text.address_component(parts, k) for k, alias in (("route", "street"), ("street_number", "number"), ("postal_code", "code"), ("country", "country"))})


@query("SELECT p_partkey, list_extract(['Milano', 'Milano', 'Milano', 'Sesto San Giovanni', NULL], 1 + p_size % 5) AS city, p_size % 5 = 3 AS outside, p_size % 4 = 0 OR p_size % 4 = 1 AS geographic FROM part")
def fn_places(spark, sf_dir):
    _, size, _, _, _ = columns()
    pick = lambda values, n: F.element_at(F.array(*[lit(v).cast("string") for v in values]), (size % n + 1).cast("int"))
    city = pick(["milan", " MILANO", "Mi", "sesto san giovanni ", " "], 5)
    return fields(spark, sf_dir, city=text.canonical_city(city), outside=text.out_of_area(city), geographic=text.geographic_name(pick([" Milan ", "20121", "20121 Milano", "Milano Bar"], 4)))


@query("SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS id, CAST(p_size AS VARCHAR) AS slug_id, 'https://www.site.example/r/' || p_size AS url FROM part")
def fn_url_ids(spark, sf_dir):
    key, size, _, brand, _ = columns()
    page = F.concat(lit("https://t.example/Restaurant_Review-g187849-d"), as_text(key), lit("-Reviews-"), brand)
    slug = F.concat(lit("https://f.example/ristorante/a-r"), as_text(size))
    return fields(spark, sf_dir, id=text.id_from_url(page), slug_id=text.id_from_url(slug), url=text.normal_url(F.concat(lit("HTTPS://WWW.Site.example/r/"), as_text(size), F.when(size % 2 == 0, "/?ref=x").otherwise("#top"))))


@query("SELECT p_partkey, p_name AS review, CASE WHEN p_size % 3 > 0 THEN p_brand END AS some, p_size % 4 < 2 AS absent FROM part")
def fn_optional_text(spark, sf_dir):
    _, size, name, brand, _ = columns()
    more = F.concat(name, F.when(size % 2 == 0, "  Leggi tutto").otherwise(" Scopri di più "))
    gone = F.when(size % 4 == 0, " n/a ").when(size % 4 == 1, lit(None)).otherwise(brand)
    return fields(spark, sf_dir, review=text.strip_more(more), some=text.optional(F.when(size % 3 > 0, F.concat(lit(" "), brand, lit(" "))).otherwise("  ")), absent=text.missing(gone))


@query("SELECT p_partkey, (p_size % 5) + 0.5::DOUBLE AS five, CAST(p_size * 1000 AS BIGINT) AS reviews, CASE WHEN p_size % 3 > 0 THEN p_size % 3 END AS tier, CASE WHEN p_size < 30 THEN p_size END AS percent FROM part")
def fn_numbers(spark, sf_dir):
    _, size, _, _, _ = columns()
    rating = F.concat(as_text(size % 5), lit(",5 su 5"))
    reviews = F.concat(lit("("), as_text(size), lit(".000 recensioni)"))
    tier = F.when(size % 3 > 0, F.concat(F.repeat(lit("€"), size % 3), lit(" - €€€€"))).otherwise("circa 20")
    percent = F.when(size < 30, F.concat(lit("Sconto -"), as_text(size), lit("%"))).otherwise("-20% e -30%")
    return fields(spark, sf_dir, five=numbers.italian_rating(rating), reviews=numbers.whole(reviews), tier=numbers.euro_tier(tier).cast("int"), percent=numbers.discount(percent))


@query("SELECT p_partkey, p_size || CASE WHEN p_size % 2 = 0 THEN ' €' ELSE '.50 USD' END AS amount, p_size || ' €' AS price, CASE p_size % 3 WHEN 0 THEN 'INEXPENSIVE' WHEN 1 THEN 'MODERATE' ELSE 'VERY_EXPENSIVE' END AS level FROM part")
def fn_money(spark, sf_dir):
    _, size, _, _, _ = columns()
    minor = size * 100 + F.when(size % 2 == 0, 0).otherwise(50)
    shown = F.concat(lit("prezzo medio "), F.when(size % 2 == 0, F.concat(as_text(size), lit(" EUR"))).otherwise(F.concat(lit("€ "), as_text(size))))
    level = numbers.integrated_level(F.when(size % 3 == 0, 20).when(size % 3 == 1, 21).otherwise(71))
    return fields(spark, sf_dir, amount=numbers.money(minor, lit(2), F.when(size % 2 == 0, "EUR").otherwise("USD")), price=pages.price_text(shown), level=level)


@query("SELECT p_partkey, 'Monday 12:' || lpad(CAST(p_size AS VARCHAR), 2, '0') || '-15:00 false|Monday 19:00-01:30 true|Sunday 09:00-23:00 false' AS hours, lpad(CAST(p_size // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(p_size % 60 AS VARCHAR), 2, '0') AS clock FROM part")
def fn_weekly_hours(spark, sf_dir):
    _, size, _, _, _ = columns()
    said = F.concat(lit("Lun 12:"), F.lpad(as_text(size), 2, "0"), lit(" - 15:00 19:00 - 01:30 Dom 9:00 - 23:00"))
    shown = F.transform(numbers.weekly_hours(said), lambda h: F.concat(h["day"], lit(" "), h["opens"], lit("-"), h["closes"], lit(" "), as_text(h["closes_next_day"])))
    return fields(spark, sf_dir, hours=F.array_join(shown, "|"), clock=numbers.minutes_text(size))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || ' 23:30:00' AS utc FROM orders")
def fn_timestamps(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"))
    return rows.select("o_orderkey", F.date_format(numbers.utc_timestamp(F.concat("d", lit("T23:30:00Z"))), "yyyy-MM-dd HH:mm:ss").alias("utc"))


@query("SELECT p_partkey, p_brand || '|Pizza' AS cuisines, 'Vegano|Halal' AS dietary, CASE WHEN p_size % 2 = 0 THEN 'Italian|Pizza' ELSE 'Pizza|Sushi' END AS buckets FROM part")
def fn_cuisines(spark, sf_dir):
    _, size, _, brand, _ = columns()
    labels = arrays.split_labels(F.concat(brand, lit(" , Vegano,PIZZA ,Halal, "), F.lower(brand)))
    split = arrays.lift_dietary(F.transform(labels, lambda x: F.when(x == "PIZZA", "Pizza").otherwise(x)))
    buckets = cleaning.buckets_of(F.when(size % 2 == 0, F.array(lit("Milanese"), lit("unknown"), lit(" pizzeria "), lit("italiana"))).otherwise(F.array(lit("PIZZA"), lit("sushi"), lit("Pizzeria"))))
    return fields(spark, sf_dir, s=split, buckets=F.array_join(buckets, "|")).select("p_partkey", F.array_join("s.cuisines", "|").alias("cuisines"), F.array_join("s.dietary", "|").alias("dietary"), "buckets")


@query("SELECT p_partkey, CAST(least(p_size, 3) AS INTEGER) AS kept, round((p_size + 4.0::DOUBLE) / 2, 2) AS average, CASE WHEN p_size % 2 = 0 THEN p_size / 2.0::DOUBLE ELSE p_size * 5.0::DOUBLE / 20 END AS comparable FROM part")
def fn_reviews(spark, sf_dir):
    _, size, _, _, _ = columns()
    reviews = F.transform(F.sequence(lit(1), size), lambda i: F.struct(as_text(i).alias("text"), lit("x").alias("author"), lit(1).alias("other")))
    return fields(spark, sf_dir, kept=F.size(arrays.slim(reviews, 3, "text", "author")), average=numbers.sample_average(F.array(size.cast("double"), lit(None), lit(4.0))), comparable=numbers.comparable_rating(size.cast("double"), F.when(size % 2 == 0, 10).otherwise(20)))


@query("SELECT p_partkey, 'Bar ' || p_brand AS name, 4.5::DOUBLE AS rating, CAST(p_size AS BIGINT) AS reviews, p_size || ' €' AS price, CASE WHEN p_size % 2 = 0 THEN '-20%' END AS discount, 'Via Po 1, 20121 Milano' AS address FROM part")
def fn_listing_card(spark, sf_dir):
    _, size, _, brand, _ = columns()
    shown = F.concat(lit("\n Bar  "), brand, lit("\n4,5\n"), as_text(size), lit(" recensioni\nPrezzo medio "), as_text(size), lit(" €\n"), F.when(size % 2 == 0, "fino a -20%\n").otherwise("\n"), lit("Via Po 1, 20121 Milano\n"))
    return fields(spark, sf_dir, c=pages.card(shown)).select("p_partkey", "c.*")


@query("SELECT p_partkey, p_name AS name, CASE WHEN p_size % 2 = 0 THEN '02 1' ELSE '+39 02 123456' END AS phone, p_size || '@x.example' AS email, 'https://own.example/' || p_size AS website, CASE WHEN p_size % 2 = 0 THEN 'Via Po 1, 20121, IT' END AS address, CASE WHEN p_size % 2 = 0 THEN 45.5::DOUBLE ELSE 45.464::DOUBLE END AS latitude, CASE WHEN p_size % 2 = 0 THEN 9.25::DOUBLE ELSE 9.191::DOUBLE END AS longitude FROM part")
def fn_page_detail(spark, sf_dir):
    """Structured data first, then links and text."""
    _, size, name, _, _ = columns()
    ld = F.when(size % 2 == 0, F.concat(lit('{"name": "'), name, lit('", "telephone": "02 1", "address": {"streetAddress": "Via Po 1", "postalCode": "20121", "addressCountry": "IT"}, "geo": {"latitude": 45.5, "longitude": 9.25}}'))).otherwise(F.concat(lit('{"name": "'), name, lit('"}')))
    html = F.concat(lit('<html><script type="application/ld+json">'), ld, lit('</script><a href="https://www.facebook.com/x">f</a><a href="https://page.thefork.example/a">own</a><a href="mailto:'), as_text(size), lit('@x.example?subject=a">m</a><a href="tel:+39 02 123456">t</a><a href="https://own.example/'), as_text(size), lit('">w</a><a href="https://maps.example/@45.464,9.191">map</a></html>'))
    shown = blocking.spread(fields(spark, sf_dir, html=html), "p_partkey")
    return shown.select("p_partkey", pages.detail(F.col("html"), "thefork.example").alias("d")).select("p_partkey", *[f"d.{c}" for c in ("name", "phone", "email", "website", "address", "latitude", "longitude")])


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'Via Po ' || p_size END AS street, CASE WHEN p_size % 3 = 0 THEN p_brand END AS city, CASE WHEN p_size % 3 > 0 THEN p_name END AS text, p_size % 3 = 0 AS structured FROM part")
def fn_geocode_query(spark, sf_dir):
    _, size, name, brand, _ = columns()
    known = size % 3 == 0
    q = pages.geocode_query(F.when(known, "Via Po").otherwise(" "), F.when(known, as_text(size)), lit(None).cast("string"), brand, name)
    return fields(spark, sf_dir, q=q).select("p_partkey", "q.street", "q.city", "q.text", "q.structured")


@query("SELECT p_partkey, p_size % 5 > 1 AS valid, p_size % 5 IN (2, 3) AS inside FROM part")
def fn_coordinates(spark, sf_dir):
    _, size, _, _, _ = columns()
    la = F.when(size % 5 == 0, lit(None)).when(size % 5 == 1, 0.0).when(size % 5 == 4, 44.0).otherwise(45.4 + size / 1000)
    lo = F.when(size % 5 == 1, 0.0).otherwise(9.1 + size / 1000)
    return fields(spark, sf_dir, valid=geo.valid_coordinate(la, lo), inside=geo.in_box(la, lo))


@query("SELECT p_type AS name, round(avg(p_size), 6) AS latitude, round(avg(p_retailprice), 6) AS longitude, CAST(max(p_size) AS BIGINT) AS radius FROM part GROUP BY 1")
def geo_collapse_anchors(spark, sf_dir):
    key, size, _, _, kind = columns()
    rows = part(spark, sf_dir).select(F.concat(kind, lit("_"), as_text(key)).alias("name"), size.alias("latitude"), F.col("p_retailprice").alias("longitude"), size.cast("long").alias("radius"))
    return geo.collapse_anchors(rows).select("name", F.round("latitude", 6).alias("latitude"), F.round("longitude", 6).alias("longitude"), "radius")


@query("WITH t AS (SELECT c_custkey AS seq, 45.35 + ((c_custkey * 7919) % 2300) / 10000.0::DOUBLE AS la, 9.0 + ((c_custkey * 104729) % 3500) / 10000.0::DOUBLE AS lo FROM customer) SELECT seq FROM (SELECT seq, row_number() OVER (PARTITION BY floor(la / (500 / 111320.0::DOUBLE)), floor(lo / (500 / 111320.0::DOUBLE)) ORDER BY seq) AS k FROM t) WHERE k = 1")
def geo_tile_union(spark, sf_dir):
    k = F.col("c_custkey")
    tiles = table(spark, sf_dir, "customer").select(k.alias("seq"), (lit(45.35) + F.pmod(k * 7919, lit(2300)) / 10000).alias("latitude"), (lit(9.0) + F.pmod(k * 104729, lit(3500)) / 10000).alias("longitude"))
    return geo.tile_union(tiles, 500).select("seq")


@query("SELECT k AS lookup_key, arg_max(p_partkey, p_partkey) AS p_partkey FROM (SELECT DISTINCT p_partkey, unnest([p_name, p_brand, CASE WHEN p_size > 10 THEN CAST(p_size AS VARCHAR) END]) AS k FROM part) WHERE k IS NOT NULL GROUP BY 1")
def int_keyed_lookup(spark, sf_dir):
    """Documents under any of their keys, the last one of a key winning."""
    _, size, name, brand, _ = columns()
    docs = fields(spark, sf_dir, a=name, b=brand, c=F.when(size > 10, as_text(size)))
    return maintenance.keyed_lookup(docs, ["a", "b", "c"], "p_partkey").select("lookup_key", "p_partkey")


@query("SELECT p_partkey, coalesce('url:' || CASE WHEN p_size % 3 = 0 THEN p_name END, 'id:' || CASE WHEN p_size % 2 = 0 THEN p_brand END, 'na:' || lower(p_name || '|' || p_type)) AS merge_key FROM part")
def fn_merge_key(spark, sf_dir):
    _, size, name, brand, kind = columns()
    return fields(spark, sf_dir, merge_key=maintenance.merge_key(F.when(size % 3 == 0, F.concat(name, lit(" "))).otherwise(" "), F.when(size % 2 == 0, brand), name, kind))


@query("SELECT p_partkey, count(*) OVER (PARTITION BY p_name, p_brand) > 1 AS is_duplicate FROM part")
def dq_flagged_duplicates(spark, sf_dir):
    from plumbline.quality import profile

    return profile.flagged_duplicates(part(spark, sf_dir), ["p_name", "p_brand"]).select("p_partkey", "is_duplicate")


@query("SELECT p_partkey, sha256('{\"a\":\"' || p_name || '\",\"b\":' || p_size || '}') AS hash FROM part")
def fn_canonical_hash(spark, sf_dir):
    _, size, name, _, _ = columns()
    return fields(spark, sf_dir, hash=arrays.canonical_hash(name.alias("a"), size.alias("b")))


@query("WITH u AS (SELECT * FROM (VALUES ('facebook'), ('x'), ('instagram')) t(p)) SELECT p_partkey, string_agg(p || '=https://www.' || p || '.com/' || p_size, '|' ORDER BY p) AS links FROM part, u WHERE p <> 'x' OR p_size % 2 = 0 GROUP BY p_partkey")
def fn_social_links(spark, sf_dir):
    _, size, _, _, _ = columns()
    url = lambda p: F.concat(lit(f"https://www.{p}.com/"), as_text(size))
    urls = F.array(url("instagram"), url("facebook"), F.concat(url("facebook"), lit("b")), F.when(size % 2 == 0, url("x")).otherwise("https://box.com/a"))
    shown = blocking.spread(fields(spark, sf_dir, urls=urls), "p_partkey")
    return shown.select("p_partkey", F.array_join(F.array_sort(F.transform(F.map_entries(text.social_links(F.col("urls"))), lambda e: F.concat(e["key"], lit("="), e["value"]))), "|").alias("links"))
