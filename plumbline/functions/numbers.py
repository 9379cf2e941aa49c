"""Numbers, prices, dates and opening hours out of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = ["gennaio", "febbraio", "marzo", "aprile", "maggio", "giugno", "luglio", "agosto", "settembre", "ottobre", "novembre", "dicembre"]
DAYS = {"lun": "Monday", "mar": "Tuesday", "mer": "Wednesday", "gio": "Thursday", "ven": "Friday", "sab": "Saturday", "dom": "Sunday"}
LEVELS = {"PRICE_LEVEL_INEXPENSIVE": 1, "PRICE_LEVEL_MODERATE": 2, "PRICE_LEVEL_EXPENSIVE": 3, "PRICE_LEVEL_VERY_EXPENSIVE": 4}
LABELS = {1: "INEXPENSIVE", 2: "MODERATE", 3: "EXPENSIVE", 4: "VERY_EXPENSIVE"}


def number(c: Column) -> Column:
    """The first number, its separators read as its locale writes them: groups of three are thousands, a last other sign is decimal."""
    t = F.regexp_extract(c, r"([+-]?\d+(?:[.,]\d+)*)", 1)
    both = t.contains(".") & t.contains(",")
    comma_last = F.instr(F.reverse(t), ",") < F.instr(F.reverse(t), ".")
    thousands = t.rlike(r"^[+-]?\d{1,3}([.,]\d{3})+$")
    clean = (
        F.when(both & comma_last, F.replace(F.replace(t, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
        .when(both, F.replace(t, F.lit(","), F.lit("")))
        .when(thousands, F.regexp_replace(t, "[.,]", ""))
        .otherwise(F.replace(t, F.lit(","), F.lit(".")))
    )
    return clean.try_cast("double")


def rounded(c: Column, digits: int) -> Column:
    """F.round of a double, without its decimal arithmetic where the next digits aren't about half a unit."""
    scaled = c * 10**digits
    plain = (F.abs(c) < 1e6) & (F.abs(scaled - F.floor(scaled) - 0.5) > 1e-3)
    return F.when(plain, F.floor(scaled + 0.5) / F.lit(10.0**digits)).otherwise(F.round(c, digits))


def italian_rating(c: Column) -> Column:
    x = F.replace(F.regexp_extract(c, r"(\d+(?:[.,]\d+)?)", 1), F.lit(","), F.lit(".")).try_cast("double")
    return F.when(x.between(0, 5), x)


def whole(c: Column) -> Column:
    """The first integer, dots as thousands."""
    return F.replace(F.regexp_extract(c, r"(\d{1,3}(?:\.\d{3})+|\d+)", 1), F.lit("."), F.lit("")).try_cast("long")


def euro_tier(c: Column) -> Column:
    """The number of euro signs in the lower bound; null for any other sign."""
    bare = F.regexp_replace(c, r"\s", "")
    return F.when(bare.rlike("^[€-]+$"), F.nullif(F.length(F.regexp_replace(F.substring_index(bare, "-", 1), "[^€]", "")), F.lit(0)))


def flat_tier(eur: Column) -> Column:
    return F.when(eur <= 15, 1).when(eur <= 30, 2).when(eur <= 50, 3).when(eur.isNotNull(), 4)


def integrated_level(eur: Column) -> Column:
    return F.when(eur <= 20, "INEXPENSIVE").when(eur <= 40, "MODERATE").when(eur <= 70, "EXPENSIVE").when(eur.isNotNull(), "VERY_EXPENSIVE")


def price_tier(tripadvisor: Column, google: Column, eur: Column) -> Column:
    level = F.lit(None).cast("int")
    for k, v in LEVELS.items():
        level = F.when(google == k, v).otherwise(level)
    return F.coalesce(F.nullif(tripadvisor, F.lit(0)), level, flat_tier(eur))


def discount(c: Column) -> Column:
    """The percentage, if the text is short, has one line and names just one."""
    found = F.array_distinct(F.regexp_extract_all(c, F.lit(r"(\d{1,3})\s*%"), 1))
    return F.when(~c.contains("\n") & (F.length(c) <= 22) & (F.size(found) == 1), F.try_element_at(found, F.lit(1)).try_cast("int"))


def money(value: Column, decimals: Column, currency: Column) -> Column:
    amount = F.format_string("%.2f", value / F.pow(F.lit(10.0), decimals))
    return F.concat(F.regexp_replace(amount, r"\.00$", ""), F.lit(" "), F.when(currency == "EUR", "€").otherwise(currency))


def italian_date(c: Column) -> Column:
    """29 maggio 2026 as an ISO date."""
    low = F.lower(c)
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.regexp_extract(low, r"\d{1,2}\s+([a-z]+)\s+\d{4}", 1))
    text = F.concat_ws("-", F.regexp_extract(low, r"(\d{4})", 1), F.lpad(month.cast("string"), 2, "0"), F.lpad(F.regexp_extract(low, r"(\d{1,2})\s", 1), 2, "0"))
    return F.when(month > 0, F.date_format(F.try_to_date(text, "yyyy-MM-dd"), "yyyy-MM-dd"))


def fold_hours(minutes: Column) -> Column:
    """Minutes since midnight, up to 29:00, as (clock, next_day)."""
    m = F.pmod(minutes, F.lit(1440))
    return F.struct(F.format_string("%02d:%02d", F.floor(m / 60).cast("int"), F.pmod(m, F.lit(60)).cast("int")).alias("clock"), (minutes >= 1440).alias("next_day"))


def minutes_text(m: Column) -> Column:
    return F.format_string("%02d:%02d", F.floor(m / 60).cast("int"), F.pmod(m, F.lit(60)).cast("int"))


def weekly_hours(c: Column) -> Column:
    """'lun 12:00 - 15:00 19:00 - 01:00 mar ...' as an array of (day, opens, closes, closes_next_day)."""
    days = "|".join(DAYS)
    parts = F.regexp_extract_all(F.lower(c), F.lit(rf"((?:{days})[^a-z]*)"), 1)
    name = F.create_map(*[F.lit(x) for kv in DAYS.items() for x in kv])

    def shifts(p: Column) -> Column:
        found = F.regexp_extract_all(p, F.lit(r"(\d{1,2}:\d{2}\s*-\s*\d{1,2}:\d{2})"), 1)
        return F.transform(found, lambda s: F.struct(name[F.substring(p, 1, 3)].alias("day"), F.lpad(F.trim(F.substring_index(s, "-", 1)), 5, "0").alias("opens"), F.lpad(F.trim(F.substring_index(s, "-", -1)), 5, "0").alias("closes"), (F.lpad(F.trim(F.substring_index(s, "-", -1)), 5, "0") < F.lpad(F.trim(F.substring_index(s, "-", 1)), 5, "0")).alias("closes_next_day")))

    return F.flatten(F.transform(parts, shifts))


def utc_timestamp(c: Column) -> Column:
    return F.try_to_timestamp(c)


def refreshability(hours: Column, target: float) -> Column:
    return F.coalesce(F.greatest(F.lit(0.0), 100 * (1 - hours / target)), F.lit(0.0))


def capped_pct(part: Column, whole_: Column) -> Column:
    """Share in percent, two places; 100 only if nothing is missing; 0 of nothing."""
    x = F.round(F.try_divide(part * 100.0, whole_), 2)
    return F.coalesce(F.when((part < whole_) & (x == 100.0), 99.99).otherwise(x), F.lit(0.0))


def sample_average(ratings: Column) -> Column:
    known = F.filter(ratings, lambda x: x.isNotNull())
    return F.round(F.try_divide(F.aggregate(known, F.lit(0.0), lambda a, x: a + x), F.size(known)), 2)


def comparable_rating(rating: Column, scale: Column) -> Column:
    return F.when(scale == 10, rating / 2).otherwise(rating * 5 / scale)
