from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import pages

HTML = """<a href="tel:+39 02 123">t</a><a href="mailto:a@b.it?subject=x">m</a><a href="https://facebook.com/x">f</a><a href="https://own.it/x">o</a><a href="https://www.mario.it/">w</a>
<script type="application/ld+json">{"name": "Da Mario", "address": {"streetAddress": "Via Roma 1", "addressLocality": "Milano"}, "geo": {"latitude": 45.1, "longitude": 9.2}, "aggregateRating": {"ratingValue": 9.1, "reviewCount": 12}}</script>"""


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first().y


def test_detail_page(spark):
    d = one(spark, HTML, lambda c: pages.detail(c, r"own\.it"))
    assert (d.name, d.phone, d.email, d.website, d.address, d.latitude, d.rating, d.reviews) == ("Da Mario", "+39 02 123", "a@b.it", "https://www.mario.it/", "Via Roma 1, Milano", 45.1, 9.1, 12)
    bare = one(spark, "Call +39 02 1234567, write to c.d@e.com, map @45.4642,9.1900", lambda c: pages.detail(c, "own"))
    assert (bare.phone, bare.email, bare.latitude, bare.longitude) == ("+39 02 1234567", "c.d@e.com", 45.4642, 9.19)
    assert one(spark, None, lambda c: pages.detail(c, "own")).phone is None


def test_card(spark):
    c = one(spark, "Da Mario\n Pizzeria \n9,3\n(1.204 recensioni)\nPrezzo medio 30 €\n-20% sul menu\nVia Roma 1, 20121 Milano", pages.card)
    assert tuple(c) == ("Da Mario", 9.3, 1204, "30 €", "-20%", "Via Roma 1, 20121 Milano")


def test_snippets_reviews_geocoding(spark):
    text = "x\n" + "Il cibo era davvero molto buono e il servizio\n" * 2 + "IL CIBO ERA DAVVERO MOLTO BUONO E IL SERVIZIO\nshort food"
    assert one(spark, text, lambda c: pages.snippets(pages.lines(c))) == ["Il cibo era davvero molto buono e il servizio"]
    rows = [("k", 1, "a", "d", "t"), ("k", 2, "a", "d", "t"), ("k", 3, "b", "d", "t"), ("k", 4, "c", None, "t")]
    df = spark.createDataFrame(rows, "k string, seq int, author string, date string, text string")
    assert [r.seq for r in pages.merge_reviews(df, "k", 2).orderBy("seq").collect()] == [1, 3]
    q = spark.range(1).select(pages.geocode_query(F.lit("Via Roma"), F.lit("1"), F.lit(" "), F.lit("Milano"), F.lit("all")).alias("q"), pages.geocode_query(F.lit(""), F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit("M"), F.lit("all")).alias("r")).first()
    assert tuple(q.q) == (True, "Via Roma 1", None, "Milano", None) and tuple(q.r) == (False, None, None, None, "all")
