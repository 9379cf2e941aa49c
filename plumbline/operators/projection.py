"""Flat rows of the three clean sources, in a fixed order of columns, ready for a table without nested values.

Texts that are missing become empty, lists empty lists, conditions 0 or 1;
numbers stay null where they are missing, but for counts that a table sums up.
Rows without their key are left out. A column that a source lacks is missing in
each of its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.arrays import list_or_empty, text_or_empty
from plumbline.operators.maintenance import guarded

TEXT, LIST, FLAG, NUMBER, COUNT = "text", "list", "flag", "number", "count"
_PLACE = {"address": TEXT, "street": TEXT, "house_number": TEXT, "postal_code": TEXT}

CLEAN_GOOGLE = {
    "place_id": NUMBER, "name": TEXT, "latitude": NUMBER, "longitude": NUMBER, **_PLACE, "locality": TEXT, "province": TEXT, "country": TEXT, "city": TEXT, "city_out_of_area": FLAG,
    "rating": NUMBER, "review_count": NUMBER, "has_rating": FLAG, "low_review": FLAG, "primary_type": TEXT, "types": LIST, "category_tier": TEXT, "is_dining": FLAG, "is_operational": FLAG,
    "business_status": TEXT, "photo_count": COUNT, "price_level": TEXT, "has_website": FLAG, "has_phone": FLAG, "website": TEXT, "phone": TEXT, "flags": LIST,
}
CLEAN_TRIPADVISOR = {
    "source_url": NUMBER, "ta_location_id": TEXT, "restaurant_name": TEXT, "rating": NUMBER, "total_review": NUMBER, **_PLACE, "city": TEXT, "latitude": NUMBER, "longitude": NUMBER, "has_coordinates": FLAG,
    "photo_count": NUMBER, "price_band": TEXT, "price_tier_level": NUMBER, "cuisines": LIST, **{f"has_{c}": FLAG for c in ("rating", "review_count")}, "low_review": FLAG,
    **{f"has_{c}": FLAG for c in ("address", "reviews", "hours", "phone", "website", "email")}, "website": TEXT, "phone": TEXT, "email": TEXT, "flags": LIST,
}
CLEAN_THEFORK = {
    "source_id": NUMBER, "source": TEXT, "tf_id": TEXT, "restaurant_url": TEXT, "restaurant_name": TEXT, "latitude": NUMBER, "longitude": NUMBER, **_PLACE, "city": TEXT, "rating": NUMBER, "review_count": NUMBER,
    "has_rating": FLAG, "has_review_count": FLAG, "low_review": FLAG, "avg_price_eur": NUMBER, "discount_pct": NUMBER, "has_discount": FLAG, "cuisines": LIST, "dietary_options": LIST, "has_hours": FLAG,
    "photo_count": NUMBER, "has_reviews": FLAG, "sample_size": COUNT, "sample_avg_rating": NUMBER, "rating_sample_divergent": FLAG, "flags": LIST,
}
KEYS = {"google": ("place_id", CLEAN_GOOGLE), "tripadvisor": ("source_url", CLEAN_TRIPADVISOR), "thefork": ("source_id", CLEAN_THEFORK)}


def flat(clean: DataFrame, source: str) -> DataFrame:
    """The rows of a clean source as its table has them."""
    key, columns = KEYS[source]

    def column(name: str, kind: str) -> Column:
        there = F.col(name) if name in clean.columns else F.lit(None)
        if kind == TEXT:
            return text_or_empty(there)
        if kind == LIST:
            return list_or_empty(there.cast("array<string>"))
        if kind == FLAG:
            return F.coalesce(there.cast("boolean"), F.lit(False)).cast("int")
        if kind == COUNT:
            return F.coalesce(there.cast("long"), F.lit(0))
        return there if name in clean.columns else there.cast("double")

    return guarded(clean, key).select(*[column(name, kind).alias(name) for name, kind in columns.items()])
