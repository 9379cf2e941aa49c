"""Names, addresses, ids and contacts as column expressions; null stays null unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ACCENTED = "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝ"
_PLAIN = "aaaaaaceeeeiiiinoooooouuuuyyAAAAAACEEEEIIIINOOOOOOUUUUY"
MISSING_TEXT = ("", "nan", "null", "none", "n/a", "na", "-")
SOCIAL_HOSTS = ("facebook", "instagram", "twitter", "x", "tiktok", "youtube", "linkedin")


def optional(c: Column) -> Column:
    """Trimmed, blank as null."""
    return F.nullif(F.trim(c), F.lit(""))


def missing(c: Column) -> Column:
    """Null or one of the textual signs of a missing value."""
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin(*MISSING_TEXT), F.lit(True))


def missing_scraped(c: Column) -> Column:
    """The narrower rule of scraped records: null, blank or NaN as it is written there."""
    return F.coalesce(F.trim(c).isin("", "NaN"), F.lit(True))


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def fold_accents(c: Column) -> Column:
    return F.translate(c, _ACCENTED, _PLAIN)


def normal_name(c: Column) -> Column:
    """Lower case, three abbreviations written out, punctuation as spaces."""
    c = F.lower(F.coalesce(c, F.lit("")))
    for short, long in ((r"\brist\.", "ristorante "), (r"\btrat\.", "trattoria "), (r"\bp\.za", "piazza ")):
        c = F.regexp_replace(c, short, long)
    return squeeze(F.regexp_replace(c, r"\p{P}", " "))


def tokens(c: Column, least: int = 4) -> Column:
    return F.array_distinct(F.filter(F.split(normal_name(c), " "), lambda t: F.length(t) >= least))


def plain_text(c: Column) -> Column:
    """Accents folded, lower case, runs of other signs than letters and digits as one space."""
    return F.trim(F.regexp_replace(F.lower(fold_accents(F.coalesce(c, F.lit("")))), "[^a-z0-9]+", " "))


def display_name(c: Column) -> Column:
    """Squeezed; names all in capitals get a capital behind every sign that is no letter, as in D'Amare."""
    c = squeeze(c)
    runs = F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}]+|[^\p{L}]+)"), 1)
    titled = F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.substring(r, 2, 1 << 20))), "")
    return F.when((F.upper(c) == c) & (F.lower(c) != c), titled).otherwise(optional(c))


def normal_address(c: Column) -> Column:
    c = F.regexp_replace(squeeze(c), r"\s*,\s*", ", ")
    c = F.regexp_replace(F.regexp_replace(c, r"\bI-(\d{5})\b", "$1"), r"\bMilan\b", "Milano")
    return optional(F.regexp_replace(F.regexp_replace(c, r"\bItaly\b", "Italia"), r"[ ,]+$", ""))


def canonical_city(c: Column) -> Column:
    low = F.lower(optional(c))
    return F.when(low.isin("milan", "milano", "mi"), "Milano").otherwise(F.initcap(low))


def address_parts(c: Column) -> Column:
    """(street, postal_code, city): what stands before the five digits, they, and what follows."""
    code = F.nullif(F.regexp_extract(c, r"\b(\d{5})\b", 1), F.lit(""))
    street = optional(F.regexp_replace(F.when(code.isNotNull(), F.regexp_extract(c, r"^(.*?)\b\d{5}\b", 1)).otherwise(F.substring_index(c, ",", 1)), r"[ ,]+$", ""))
    city = F.when(code.isNotNull(), optional(F.regexp_extract(c, r"\b\d{5}\b[ ,]*([^,]*)", 1)))
    return F.struct(street.alias("street"), code.alias("postal_code"), canonical_city(city).alias("city"))


def address_component(components: Column, kind: str) -> Column:
    """longText of the last component of a kind."""
    return F.try_element_at(F.filter(components, lambda x: F.array_contains(x["types"], kind)), F.lit(-1))["longText"]


def geographic_name(c: Column) -> Column:
    """A name that only says where: five digits, or a bare city."""
    low = F.lower(F.trim(c))
    return F.coalesce(low.rlike(r"^[0-9]{5}$") | low.isin("milano", "milan", "italia", "italy"), F.lit(False))


def phone(c: Column) -> Column:
    """E.164: other signs go; numbers that begin with 0 or 3 are Italian; null without digits."""
    bare = F.regexp_replace(c, r"[\s().-]", "")
    return F.when(bare.startswith("+"), bare).when(bare.startswith("00"), F.concat(F.lit("+"), F.substring(bare, 3, 40))).when(bare.rlike("^[03]"), F.concat(F.lit("+39"), bare)).otherwise(F.nullif(bare, F.lit("")))


def website(c: Column) -> Column:
    return optional(F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"^https?://", ""), r"^www\.|/+$", ""))


def host(c: Column) -> Column:
    return F.nullif(F.regexp_replace(F.regexp_extract(website(c), r"^([^/?#]+)", 1), r"\.+$", ""), F.lit(""))


def id_from_url(c: Column) -> Column:
    """The number behind -d in a page's path, or behind -r at its end."""
    return F.coalesce(F.nullif(F.regexp_extract(c, r"-d(\d+)-", 1), F.lit("")), F.nullif(F.regexp_extract(c, r"-r(\d+)$", 1), F.lit("")))


def normal_url(c: Column) -> Column:
    """Scheme and host in lower case, no query, no final slash."""
    head = F.lower(F.regexp_extract(c, r"^([a-zA-Z]+://[^/?#]+)", 1))
    return F.when(head != "", F.concat(head, F.regexp_replace(F.regexp_extract(c, r"^[a-zA-Z]+://[^/?#]+([^?#]*)", 1), "/+$", "")))


def social_links(links: Column) -> Column:
    """platform -> the first link of it; the host of a link is read once."""
    sites = F.transform(F.coalesce(links, F.array().cast("array<string>")), lambda u: F.struct(u.alias("u"), host(u).alias("h")))
    of = lambda h: F.coalesce(*[F.when(h.rlike(rf"(^|\.){p}\.com$"), p) for p in SOCIAL_HOSTS])
    known = F.filter(F.transform(sites, lambda x: F.struct(of(x["h"]).alias("key"), x["u"].alias("value"))), lambda e: e["key"].isNotNull())
    # In the order of the platforms, the first of each: a later one of the same platform adds nothing.
    first = lambda es, p: F.slice(F.filter(es, lambda e: e["key"] == p), 1, 1)
    return F.get(F.transform(F.array(known), lambda es: F.map_from_entries(F.concat(*[first(es, p) for p in SOCIAL_HOSTS]))), F.lit(0))


def strip_more(c: Column) -> Column:
    """Without the words that a page puts behind a shortened review."""
    return F.trim(F.regexp_replace(c, r"\s*(Scopri di più|Leggi tutto|Read more|Mostra di più)\s*$", ""))


def chain_brand(c: Column, brands: list[str]) -> Column:
    """The longest brand that the accent-free name is, or begins with as a word."""
    name = normal_name(fold_accents(c))
    out = F.lit(None).cast("string")
    for b in sorted(brands, key=len):
        out = F.when((name == b) | name.startswith(b + " "), b).otherwise(out)
    return out


def pair_brand(a: Column, b: Column) -> Column:
    """The brand of a pair: that of either side, both in order where they differ, null without one."""
    one = F.when(a.isNull() | (a == b), b).when(b.isNull(), a)
    return F.nullif(F.coalesce(one, F.concat(F.least(a, b), F.lit("|"), F.greatest(a, b))), F.lit(""))


#: Places of the region that are no part of the city.
OUTSKIRTS = ("assago", "corsico", "rho", "segrate", "sesto san giovanni", "monza")


def out_of_area(city: Column, outskirts: tuple[str, ...] = OUTSKIRTS) -> Column:
    """A city that is known to lie outside."""
    return F.coalesce(F.lower(F.trim(city)).isin(*outskirts), F.lit(False))
