"""Raw records of the three sources to clean ones, and clean ones to the flat, integrated row.

Each is one projection over a declared schema: no rows move. Records without
their key are dropped before; everything doubtful is flagged, not dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import arrays, numbers, text

GOOGLE = """place_id string, name string, formatted_address string, city string, latitude double, longitude double, types array<string>, primary_type string,
rating double, user_rating_count long, details struct<rating:double, userRatingCount:long, businessStatus:string, addressComponents:array<struct<longText:string, shortText:string, types:array<string>>>,
photos:array<struct<name:string>>, priceLevel:string, priceRange:struct<startPrice:struct<units:string, currencyCode:string>, endPrice:struct<units:string, currencyCode:string>>,
websiteUri:string, internationalPhoneNumber:string, nationalPhoneNumber:string, reviews:array<struct<rating:double, text:struct<text:string, languageCode:string>, publishTime:string>>,
delivery:boolean, dineIn:boolean, takeout:boolean, reservable:boolean, outdoorSeating:boolean, servesVegetarianFood:boolean, goodForChildren:boolean>"""
TRIPADVISOR = """source_url string, restaurant_name string, rating string, total_review string, cuisine_type string, price_range string, number_photo_uploaded string, address string,
website string, phone_number string, email string, working_days_hours string, review array<struct<author:struct<nickname:string>, title:string, text:string, date_of_publication:string>>"""
THEFORK = """source string, source_id string, restaurant_name string, address string, city string, latitude double, longitude double, rating double, review_count long, cuisine_type string, price_range string,
discount string, photo_count long, restaurant_url string, working_hours_structured array<struct<opens:string, closes:string, dayOfWeek:array<string>>>, working_days_hours string,
review_snippets array<string>, reviews array<struct<author_name:string, rating:double, title:string, text:string, date:string>>, scraped_at string"""

AMENITIES = {"delivery": "delivery", "dineIn": "dine_in", "takeout": "takeout", "reservable": "reservable", "outdoorSeating": "outdoor_seating", "servesVegetarianFood": "serves_vegetarian_food", "goodForChildren": "good_for_children"}
CAFES = ("cafe", "coffee_shop", "bar", "wine_bar", "pub", "bakery", "ice_cream_shop", "pastry_shop", "tea_house", "dessert_shop")
DINING = ("restaurant", "meal_takeaway", "meal_delivery", "food_court", "pizzeria", "steak_house", "deli", "diner")
ELSEWHERE = ("lodging", "hotel", "supermarket", "store", "gym", "museum", "school", "hospital", "bank", "park")
_HOURS = "array<struct<opens:string,closes:string,dayOfWeek:array<string>>>"


def category_tier(primary: Column, types: Column) -> Column:
    """restaurant, cafe_bar_bakery, non_dining or unknown: by the primary type, then by any type."""
    def tier(matches) -> Column:
        return F.when(matches(lambda t: t.endswith("_restaurant") | t.isin(*DINING)), "restaurant").when(matches(lambda t: t.isin(*CAFES)), "cafe_bar_bakery").when(matches(lambda t: t.isin(*ELSEWHERE)), "non_dining")

    known = F.coalesce(types, F.array().cast("array<string>"))
    return F.coalesce(tier(lambda p: F.coalesce(p(primary), F.lit(False))), tier(lambda p: F.exists(known, lambda t: F.coalesce(p(t), F.lit(False)))), F.lit("unknown"))


def clean_google(raw: DataFrame, low: int = 10) -> DataFrame:
    d = F.col("details")
    parts = d["addressComponents"]
    component = lambda kind: text.address_component(parts, kind)
    rating = F.coalesce(d["rating"], F.col("rating"))
    rating = F.when(rating.between(0, 5), rating)
    count = F.coalesce(d["userRatingCount"], F.col("user_rating_count"))
    count = F.when(count >= 0, count)
    status = d["businessStatus"]
    tier = category_tier(F.col("primary_type"), F.col("types"))
    geographic = text.geographic_name(F.col("name"))
    site, phone = text.website(d["websiteUri"]), text.phone(F.coalesce(text.optional(d["internationalPhoneNumber"]), d["nationalPhoneNumber"]))
    city = text.canonical_city(F.coalesce(component("locality"), F.col("city")))
    is_low = F.coalesce(count < low, F.lit(False))
    flags = arrays.flags(("no_rating", rating.isNull()), ("low_review", is_low), ("non_dining", ~tier.isin("restaurant", "cafe_bar_bakery")), ("not_operational", F.coalesce(status != "OPERATIONAL", F.lit(False))), ("geographic_name", geographic), ("city_out_of_area", F.coalesce(city != "Milano", F.lit(False))))
    price = d["priceRange"]
    return raw.where(F.trim(F.coalesce("place_id", F.lit(""))) != "").select(
        "place_id", text.display_name(F.col("name")).alias("name"), "latitude", "longitude", text.normal_address(F.col("formatted_address")).alias("address"),
        component("route").alias("street"), component("street_number").alias("house_number"), component("postal_code").alias("postal_code"), component("country").alias("country"), city.alias("city"),
        rating.alias("rating"), count.alias("review_count"), rating.isNotNull().alias("has_rating"), is_low.alias("low_review"), "primary_type", arrays.list_or_empty(F.col("types")).alias("types"),
        tier.alias("category_tier"), tier.isin("restaurant", "cafe_bar_bakery").alias("is_dining"), status.alias("business_status"), F.coalesce(status == "OPERATIONAL", F.lit(True)).alias("is_operational"), geographic.alias("name_is_geographic"), flags.alias("flags"),
        F.coalesce(F.size(d["photos"]), F.lit(0)).alias("photo_count"), d["priceLevel"].alias("price_level"),
        F.struct(price["startPrice"]["units"].try_cast("long").alias("start"), price["endPrice"]["units"].try_cast("long").alias("end"), F.coalesce(price["startPrice"]["currencyCode"], price["endPrice"]["currencyCode"]).alias("currency")).alias("price_range"),
        site.isNotNull().alias("has_website"), phone.isNotNull().alias("has_phone"), site.alias("website"), phone.alias("phone"),
        F.transform(F.slice(d["reviews"], 1, 5), lambda r: F.struct(r["rating"].alias("rating"), r["text"]["text"].alias("text"), r["text"]["languageCode"].alias("language"), r["publishTime"].alias("published"))).alias("reviews"),
        *[d[k].alias(v) for k, v in AMENITIES.items()],
    )


def _scraped(name: str) -> Column:
    return F.when(~text.missing_scraped(F.col(name)), F.trim(F.col(name)))


def clean_tripadvisor(raw: DataFrame, low: int = 10, cap: int = 20) -> DataFrame:
    rating, count = numbers.italian_rating(_scraped("rating")), numbers.whole(_scraped("total_review"))
    address = text.normal_address(_scraped("address"))
    parts = text.address_parts(address)
    street = F.nullif(F.regexp_replace(parts["street"], r"[, ]+\d+\S*$", ""), F.lit(""))
    hours, reviews = numbers.weekly_hours(_scraped("working_days_hours")), F.coalesce(F.slice("review", 1, cap), F.slice("review", 1, 1))
    reviews = F.transform(F.coalesce(reviews, F.from_json(F.lit("[]"), "array<struct<author:struct<nickname:string>,title:string,text:string,date_of_publication:string>>")), lambda r: F.struct(r["author"]["nickname"].alias("author"), r["title"].alias("title"), text.strip_more(r["text"]).alias("text"), numbers.italian_date(r["date_of_publication"]).alias("date")))
    site, phone, email = text.website(_scraped("website")), text.phone(_scraped("phone_number")), _scraped("email")
    is_low = F.coalesce(count < low, F.lit(False))
    flags = arrays.flags(("no_rating", rating.isNull()), ("missing_review_count", count.isNull()), ("low_review", is_low), ("missing_address", address.isNull()), ("rating_with_zero_reviews", F.coalesce(rating.isNotNull() & (count == 0), F.lit(False))), ("no_reviews", F.size(reviews) == 0), ("no_hours", F.coalesce(F.size(hours), F.lit(0)) <= 0))
    return raw.where(F.trim(F.coalesce("source_url", F.lit(""))) != "").select(
        "source_url", text.id_from_url(F.col("source_url")).alias("ta_location_id"), text.squeeze(_scraped("restaurant_name")).alias("restaurant_name"), rating.alias("rating"), count.alias("total_review"), address.alias("address"),
        street.alias("street"), F.nullif(F.regexp_extract(parts["street"], r"[, ]+(\d+\S*)$", 1), F.lit("")).alias("house_number"), parts["postal_code"].alias("postal_code"), parts["city"].alias("city"), numbers.whole(_scraped("number_photo_uploaded")).alias("photo_count"),
        _scraped("price_range").alias("price_band"), numbers.euro_tier(_scraped("price_range")).alias("price_tier_level"), F.coalesce(arrays.split_labels(_scraped("cuisine_type")), F.array().cast("array<string>")).alias("cuisines"), hours.alias("opening_hours"), reviews.alias("reviews"), F.size(reviews).alias("sample_size"),
        site.alias("website"), phone.alias("phone"), email.alias("email"), rating.isNotNull().alias("has_rating"), count.isNotNull().alias("has_review_count"), is_low.alias("low_review"), address.isNotNull().alias("has_address"), (F.size(reviews) > 0).alias("has_reviews"),
        phone.isNotNull().alias("has_phone"), site.isNotNull().alias("has_website"), email.isNotNull().alias("has_email"), flags.alias("flags"),
    )


def clean_thefork(raw: DataFrame, low: int = 10, cap: int = 15) -> DataFrame:
    rating = F.when(F.col("rating").between(0, 10), F.col("rating"))
    count = F.when(F.col("review_count") >= 0, F.col("review_count"))
    address = text.normal_address(F.col("address"))
    parts = text.address_parts(address)
    leak = F.coalesce(F.col("cuisine_type").rlike(r"\b\d{5}\b|(?i)\b(via|viale|piazza|corso)\b"), F.lit(False))
    labels = arrays.lift_dietary(F.coalesce(F.when(~leak, arrays.split_labels(F.col("cuisine_type"))), F.array().cast("array<string>")))
    hours = F.flatten(F.transform(F.coalesce(F.col("working_hours_structured"), F.from_json("working_days_hours", _HOURS)), lambda h: F.transform(h["dayOfWeek"], lambda day: F.struct(day.alias("day"), h["opens"].alias("opens"), h["closes"].alias("closes"), (h["closes"] < h["opens"]).alias("closes_next_day")))))
    reviews = F.slice("reviews", 1, cap)
    average = numbers.sample_average(F.transform(reviews, lambda r: r["rating"]))
    apart = F.coalesce(F.abs(rating - average) > 1.0, F.lit(False))
    is_low = F.coalesce(count < low, F.lit(False))
    flags = arrays.flags(("no_rating", rating.isNull()), ("missing_review_count", count.isNull()), ("low_review", is_low), ("rating_sample_divergent", apart), ("invalid_cuisine_type", leak))
    percent = numbers.discount(F.col("discount"))
    return raw.where(F.trim(F.coalesce("source_id", F.lit(""))) != "").select(
        "source", "source_id", text.id_from_url(F.col("source_id")).alias("tf_id"), "restaurant_url", text.display_name(F.col("restaurant_name")).alias("restaurant_name"), "latitude", "longitude", address.alias("address"), parts["street"].alias("street"), parts["postal_code"].alias("postal_code"), text.canonical_city(F.col("city")).alias("city"),
        rating.alias("rating"), count.alias("review_count"), rating.isNotNull().alias("has_rating"), count.isNotNull().alias("has_review_count"), is_low.alias("low_review"), numbers.whole(F.col("price_range")).alias("avg_price_eur"), percent.alias("discount_pct"), percent.isNotNull().alias("has_discount"),
        labels["cuisines"].alias("cuisines"), labels["dietary"].alias("dietary_options"), hours.alias("opening_hours"), F.coalesce(F.size(hours) > 0, F.lit(False)).alias("has_hours"), "photo_count", reviews.alias("reviews"), arrays.list_or_empty(F.col("review_snippets")).alias("review_snippets"),
        F.coalesce(F.size(reviews), F.lit(0)).alias("sample_size"), average.alias("sample_avg_rating"), apart.alias("rating_sample_divergent"), F.to_timestamp("scraped_at").alias("scraped_at"), flags.alias("flags"),
    )


def report(clean: DataFrame) -> DataFrame:
    """(flag, n) of a clean table, with the number of records under the empty flag: one pass."""
    return clean.select(F.explode(F.concat(F.array(F.lit("")), "flags")).alias("flag")).groupBy("flag").agg(F.count(F.lit(1)).alias("n"))


#: canonical bucket -> raw labels; how specific a bucket is: umbrellas below what they cover
BUCKETS = {
    "Italian": ("italiana", "italiano", "lombardo", "milanese", "romano", "siciliano", "toscano", "sardo", "pugliese", "italian_restaurant"), "Pizza": ("pizza", "pizzeria", "pizza_restaurant"), "Asian": ("asiatica", "asiatico", "asian_restaurant"), "Chinese": ("cinese", "chinese_restaurant"),
    "Japanese": ("giapponese", "japanese_restaurant"), "Sushi": ("sushi", "sushi_restaurant"), "Indian": ("indiana", "indiano", "indian_restaurant"), "Mexican": ("messicana", "messicano", "tex mex", "taco", "burrito", "mexican_restaurant"), "Seafood": ("pesce", "frutti di mare", "seafood_restaurant"), "Steak": ("steakhouse", "steak_house", "carne"),
    "Café/Bakery/Bar": ("caffè", "caffetteria", "bar", "pub", "gastropub", "brewpub", "irish_pub", "cafe", "bakery"), "Other": ("internazionale", "altro"),
}
SPECIFIC = {"Italian": 1, "Asian": 1, "Other": 0, "Japanese": 2, "Chinese": 2, "Indian": 2, "Mexican": 2, "Café/Bakery/Bar": 2, "Seafood": 3, "Steak": 3, "Pizza": 3, "Sushi": 3}


def buckets_of(labels: Column) -> Column:
    """The distinct canonical buckets of raw labels, in order of appearance."""
    known = F.create_map(*[F.lit(x) for b, raw in BUCKETS.items() for r in raw for x in (r, b)])
    return F.array_distinct(F.array_compact(F.transform(F.coalesce(labels, F.array().cast("array<string>")), lambda x: F.try_element_at(known, F.lower(F.trim(x))))))


def integrate(google: DataFrame, tripadvisor: DataFrame, thefork: DataFrame, links: DataFrame) -> DataFrame:
    """One row for each seed with what is linked to it; links(place_id, source, source_id, score). Ratings are compared on five points, never resolved."""
    def linked(source: str, docs: DataFrame, key: str, alias: str) -> DataFrame:
        mine = links.where(F.col("source") == source).select("place_id", F.col("source_id").alias("_key"))
        return mine.join(docs.select(F.col(key).alias("_key"), F.struct(*docs.columns).alias(alias)), "_key", "left").select("place_id", alias, F.lit(True).alias(f"{alias}_linked"))

    g = google.select("place_id", F.struct(*google.columns).alias("g"))
    all_ = g.join(linked("tripadvisor", tripadvisor, "source_url", "t"), "place_id", "left").join(linked("thefork", thefork, "source_id", "f"), "place_id", "left")
    ratings = [F.col("g.rating"), F.col("t.rating"), F.col("f.rating") / 2]
    count = sum((r.isNotNull().cast("int") for r in ratings), F.lit(0))
    has_t, has_f = F.col("t").isNotNull().cast("int"), F.col("f").isNotNull().cast("int")
    levels = F.create_map(*[F.lit(x) for k, v in numbers.LEVELS.items() for x in (k, numbers.LABELS[v])])
    tiers = F.create_map(*[F.lit(x) for kv in numbers.LABELS.items() for x in kv])
    vote = arrays.price_vote(F.try_element_at(levels, F.col("g.price_level")), F.try_element_at(tiers, F.col("t.price_tier_level")), numbers.integrated_level(F.col("f.avg_price_eur")))
    labels = arrays.merged_labels([("tripadvisor", buckets_of(F.col("t.cuisines"))), ("thefork", buckets_of(F.col("f.cuisines"))), ("google", buckets_of(F.concat(F.array("g.primary_type"), "g.types")))], SPECIFIC)
    gw, tw = F.col("g.website"), F.col("t.website")
    status = arrays.website_status(gw, tw, text.host(gw), text.host(tw))
    return all_.withColumn("_v", vote).withColumn("_l", labels).select(
        F.col("place_id").alias("integrated_restaurant_id"), F.col("place_id").alias("google_place_id"), arrays.text_or_empty(F.col("t.source_url")).alias("tripadvisor_source_url"), arrays.text_or_empty(F.col("f.source_id")).alias("thefork_source_id"),
        *[arrays.text_or_empty(F.col(f"g.{c}")).alias(f"canonical_{c}") for c in ("name", "address", "street", "house_number", "postal_code", "city")], F.col("g.latitude").alias("latitude"), F.col("g.longitude").alias("longitude"), F.lit("google").alias("coordinate_source"),
        F.lit(1).alias("has_google"), has_t.alias("has_tripadvisor"), has_f.alias("has_thefork"), (has_t * has_f).alias("has_all_three_platforms"), (has_t + has_f + 1).alias("platform_count"),
        ratings[0].alias("google_rating_5"), ratings[1].alias("tripadvisor_rating_5"), F.col("f.rating").alias("thefork_rating_raw_10"), ratings[2].alias("thefork_rating_5"), count.alias("rating_platform_count"),
        F.round(F.try_divide(sum((F.coalesce(r, F.lit(0.0)) for r in ratings), F.lit(0.0)), count), 3).alias("rating_avg_5"), F.round(F.greatest(*ratings) - F.least(*ratings), 3).alias("rating_range_5"),
        F.col("g.review_count").alias("google_review_count"), F.col("t.total_review").alias("tripadvisor_review_count"), F.col("f.review_count").alias("thefork_review_count"),
        F.col("g.photo_count").cast("long").alias("google_photo_count"), F.col("t.photo_count").alias("tripadvisor_photo_count"), F.col("f.photo_count").alias("thefork_photo_count"),
        *[F.coalesce(F.col(f"{s}.has_{c}").cast("int"), F.lit(0)).alias(f"{n}_has_{c}") for s, n, c in (("g", "google", "website"), ("g", "google", "phone"), ("t", "tripadvisor", "website"), ("t", "tripadvisor", "phone"), ("t", "tripadvisor", "email"))],
        arrays.list_or_empty(F.col("t.cuisines")).alias("tripadvisor_cuisines"), arrays.list_or_empty(F.col("f.cuisines")).alias("thefork_cuisines"), F.coalesce(F.try_element_at("t.cuisines", F.lit(1)), F.try_element_at("f.cuisines", F.lit(1)), F.lit("")).alias("primary_cuisine"),
        F.col("_l.tags").alias("cuisine_tags"), F.col("_l.primary").alias("cuisine_primary"), F.col("_l.primary_source").alias("cuisine_primary_source"), F.col("_l.n_sources").alias("cuisine_n_sources"), F.col("_l.agreement").alias("cuisine_agreement"),
        arrays.text_or_empty(F.col("g.price_level")).alias("google_price_level"), arrays.text_or_empty(F.col("t.price_band")).alias("tripadvisor_price_band"), F.col("t.price_tier_level").alias("tripadvisor_price_tier_level"), F.col("f.avg_price_eur").alias("thefork_avg_price_eur"),
        numbers.price_tier(F.col("t.price_tier_level"), F.col("g.price_level"), F.col("f.avg_price_eur")).alias("price_tier"), arrays.text_or_empty(F.col("g.category_tier")).alias("google_category_tier"), F.coalesce(F.col("g.is_dining").cast("int"), F.lit(0)).alias("google_is_dining"),
        arrays.text_or_empty(F.when(status == "host_match", text.host(gw)).otherwise(F.coalesce(gw, tw))).alias("website"), F.when(status.isin("exact_match", "host_match"), "google_tripadvisor").when(gw.isNotNull(), "google").when(tw.isNotNull(), "tripadvisor").otherwise("").alias("website_source"), status.alias("website_match_status"),
        arrays.contact_status(F.col("g.phone"), F.col("t.phone")).alias("phone_match_status"), arrays.joined(F.col("_v.levels")).alias("price_level"), arrays.text_or_empty(F.col("_v.source")).alias("price_level_source"),
        F.array_sort(arrays.flags(("missing_tripadvisor_source_doc", F.col("t_linked").isNotNull() & F.col("t").isNull()), ("missing_thefork_source_doc", F.col("f_linked").isNotNull() & F.col("f").isNull()), ("website_conflict", status == "conflict"))).alias("integration_flags"),
    )
