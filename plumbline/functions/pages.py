"""Fields out of listing cards and detail pages: visible lines, links, embedded and structured data, and which of them counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.text import host, optional, squeeze

OWN_AND_SOCIAL = r"(^|\.)(facebook|instagram|twitter|x|tiktok|youtube|linkedin|google|apple)\.com$"
LD_SCHEMA = "name string, telephone string, email string, url string, servesCuisine string, priceRange string, address struct<streetAddress:string, postalCode:string, addressLocality:string, addressRegion:string, addressCountry:string>, geo struct<latitude:double, longitude:double>, aggregateRating struct<ratingValue:double, reviewCount:long>"


def lines(page_text: Column) -> Column:
    return F.filter(F.transform(F.split(page_text, "\n"), lambda x: squeeze(x)), lambda x: x != "")


def first_line(found: Column, pattern: str) -> Column:
    return F.try_element_at(F.filter(found, lambda x: x.rlike(pattern)), F.lit(1))


def first_non_empty(*values: Column) -> Column:
    """The first value that is there: earlier layers win, empty ones never do."""
    return F.coalesce(*[optional(v) for v in values])


def card(text: Column) -> Column:
    """(name, rating, reviews, price, discount, address) of a listing card's visible lines."""
    found = lines(text)
    return F.struct(
        F.try_element_at(F.filter(found, lambda x: x.rlike(r"^\p{L}") & ~x.rlike(r"€|%|\d{5}")), F.lit(1)).alias("name"),
        F.replace(F.regexp_extract(first_line(found, r"^\d{1,2}[.,]\d$"), r"(\d{1,2}[.,]\d)", 1), F.lit(","), F.lit(".")).try_cast("double").alias("rating"),
        F.regexp_replace(F.regexp_extract(first_line(found, r"(?i)\d[\d.]*\s*(recensioni|reviews)"), r"(\d[\d.]*)", 1), r"\.", "").try_cast("long").alias("reviews"),
        price_text(F.coalesce(first_line(found, "€|EUR"), F.lit(""))).alias("price"),
        F.nullif(F.regexp_extract(F.coalesce(first_line(found, r"-?\d{1,3}\s*%"), F.lit("")), r"(-?\d{1,3}\s*%)", 1), F.lit("")).alias("discount"),
        first_line(found, r"\b\d{5}\b").alias("address"),
    )


def price_text(c: Column) -> Column:
    """The first amount in euros, written as '30 €'."""
    amount = F.coalesce(F.nullif(F.regexp_extract(c, r"(\d+(?:[.,]\d{1,2})?)\s*(?:€|EUR)", 1), F.lit("")), F.nullif(F.regexp_extract(c, r"(?:€|EUR)\s*(\d+(?:[.,]\d{1,2})?)", 1), F.lit("")))
    return F.concat(amount, F.lit(" €"))


def links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit('href="([^"]+)"'), 1)


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is worked out once for each row, however often f names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def phone_of(html: Column, found: Column | None = None) -> Column:
    """From a tel: link, else the first number in the text; found: the links of html, if they are known."""
    linked = F.try_element_at(F.filter(links(html) if found is None else found, lambda u: u.startswith("tel:")), F.lit(1))
    return first_non_empty(F.substring(linked, 5, 40), F.regexp_extract(html, r"(\+\d{2}[\d ]{6,14}\d)", 1))


def email_of(html: Column, found: Column | None = None) -> Column:
    linked = F.try_element_at(F.filter(links(html) if found is None else found, lambda u: u.startswith("mailto:")), F.lit(1))
    return first_non_empty(F.regexp_replace(F.substring(linked, 8, 200), r"\?.*$", ""), F.regexp_extract(html, r"([A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]*[A-Za-z])", 1))


def website_of(html: Column, own: str, found: Column | None = None) -> Column:
    """The first link to another site that is no social network."""
    sites = F.transform(F.filter(links(html) if found is None else found, lambda u: u.rlike("^https?://")), lambda u: F.struct(u.alias("u"), host(u).alias("h")))
    out = F.filter(sites, lambda x: ~F.coalesce(x["h"].rlike(OWN_AND_SOCIAL), F.lit(True)) & ~F.coalesce(x["h"].rlike(rf"(^|\.){own}$"), F.lit(True)))
    return F.try_element_at(out, F.lit(1))["u"]


def coordinates(c: Column) -> Column:
    """(latitude, longitude): a pair as in map links, else two separate keys."""
    pair = r"[@=!](-?\d{1,2}\.\d{3,}),(-?\d{1,3}\.\d{3,})"
    la = first_non_empty(F.regexp_extract(c, pair, 1), F.regexp_extract(c, r'"lat(?:itude)?"\s*:\s*"?(-?\d{1,2}\.\d+)', 1))
    lo = first_non_empty(F.regexp_extract(c, pair, 2), F.regexp_extract(c, r'"(?:lng|lon(?:gitude)?)"\s*:\s*"?(-?\d{1,3}\.\d+)', 1))
    return F.struct(la.try_cast("double").alias("latitude"), lo.try_cast("double").alias("longitude"))


def structured(html: Column) -> Column:
    """The page's schema.org record, with its address joined."""

    def record(x: Column) -> Column:
        a = x["address"]
        return F.struct(
            x["name"].alias("name"), x["telephone"].alias("phone"), x["email"].alias("email"), x["url"].alias("website"), x["servesCuisine"].alias("cuisine"), x["priceRange"].alias("price"),
            F.nullif(F.concat_ws(", ", *[optional(a[k]) for k in ("streetAddress", "postalCode", "addressLocality", "addressRegion", "addressCountry")]), F.lit("")).alias("address"),
            x["geo"]["latitude"].alias("latitude"), x["geo"]["longitude"].alias("longitude"), x["aggregateRating"]["ratingValue"].alias("rating"), x["aggregateRating"]["reviewCount"].alias("reviews"),
        )

    return bound(F.from_json(F.regexp_extract(html, r'(?s)<script[^>]*application/ld\+json[^>]*>(.*?)</script>', 1), LD_SCHEMA), record)


def detail(html: Column, own: str) -> Column:
    """Contacts and place of a page: structured data before what links and text show; each part is read once."""

    def joined(h: Column, x: Column) -> Column:
        s, seen, found = x["s"], x["seen"], x["found"]
        return F.struct(
            s["name"].alias("name"), first_non_empty(s["phone"], phone_of(h, found)).alias("phone"), first_non_empty(s["email"], email_of(h, found)).alias("email"), first_non_empty(s["website"], website_of(h, own, found)).alias("website"),
            s["address"].alias("address"), F.coalesce(s["latitude"], seen["latitude"]).alias("latitude"), F.coalesce(s["longitude"], seen["longitude"]).alias("longitude"), s["rating"].alias("rating"), s["reviews"].alias("reviews"),
        )

    return bound(html, lambda h: bound(F.struct(structured(h).alias("s"), coordinates(h).alias("seen"), links(h).alias("found")), lambda x: joined(h, x)))


def snippets(found: Column, words: str = "(?i)cibo|piatt|servizio|ottim|buon|food|service", most: int = 5) -> Column:
    """Lines that read like reviews: 40 to 260 signs, with a usual word, each once whatever its case."""
    fit = F.filter(found, lambda x: F.length(x).between(40, 260) & x.rlike(words))
    once = F.filter(fit, lambda x, k: F.array_position(F.transform(fit, lambda y: F.lower(y)), F.lower(x)) == k + 1)
    return F.slice(once, 1, most)


def merge_reviews(reviews: DataFrame, key: str, most: int = 20) -> DataFrame:
    """reviews(key, seq, author, date, text): of equal author, date and text the first, at most so many for each key."""
    same = Window.partitionBy(key, "author", "date", "text").orderBy("seq")
    first = reviews.withColumn("_k", F.row_number().over(same)).where("_k = 1")
    return first.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy("seq"))).where(F.col("_n") <= most).drop("_k", "_n")


def geocode_query(street: Column, number: Column, code: Column, city: Column, address: Column) -> Column:
    """(structured, street, postal_code, city, text): structured where a street or a code is known, else free text."""
    known = optional(street).isNotNull() | optional(code).isNotNull()
    return F.struct(known.alias("structured"), F.when(known, F.nullif(F.concat_ws(" ", optional(street), optional(number)), F.lit(""))).alias("street"), F.when(known, optional(code)).alias("postal_code"), F.when(known, optional(city)).alias("city"), F.when(~known, optional(address)).alias("text"))
