from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from plumbline.functions import arrays, geo, numbers, similarity, text


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "f,given,want",
    [
        (text.normal_name, "  RIST.   DA, MARIO!!  P.ZA   TEST ", "ristorante da mario piazza test"),
        (text.normal_name, None, ""),
        (text.display_name, "TRATTORIA  D'AMARE", "Trattoria D'Amare"),
        (text.display_name, "  Da  Mario ", "Da Mario"),
        (text.normal_address, "Via Roma 1 ,I-20121 Milan , Italy", "Via Roma 1, 20121 Milano, Italia"),
        (text.canonical_city, "MILAN", "Milano"),
        (text.phone, "02 123.45-67", "+39021234567"),
        (text.phone, "+44 20 7946", "+44207946"),
        (text.phone, "  ", None),
        (text.website, "https://www.Example.com/menu/", "example.com/menu"),
        (text.host, "http://www.example.com./a?b", "example.com"),
        (text.id_from_url, "https://x.it/Restaurant-g1-d4567-Reviews", "4567"),
        (text.id_from_url, "da-mario-r99", "99"),
        (text.normal_url, "HTTPS://Www.X.it/Path/?q=1", "https://www.x.it/Path"),
        (text.strip_more, "Ottimo. Scopri di più", "Ottimo."),
        (text.plain_text, "Caffè & Città!", "caffe citta"),
        (text.geographic_name, "20121", True),
        (text.missing, " N/A ", True),
        (text.missing_scraped, "NaN", True),
        (text.missing_scraped, "n/a", False),
        (numbers.number, "1.234,56 €", 1234.56),
        (numbers.number, "1,234.56", 1234.56),
        (numbers.number, "12.345", 12345.0),
        (numbers.number, "4,3", 4.3),
        (numbers.number, "none", None),
        (numbers.italian_rating, "4,5 su 5", 4.5),
        (numbers.italian_rating, "9,1", None),
        (numbers.whole, "(1.234 recensioni)", 1234),
        (numbers.euro_tier, "€€-€€€", 2),
        (numbers.euro_tier, "20 €", None),
        (numbers.discount, "-30% sul menu", 30),
        (numbers.discount, "20% o 30%", None),
        (numbers.italian_date, "29 maggio 2026", "2026-05-29"),
        (numbers.italian_date, "31 febbraio 2026", None),
    ],
)
def test_text_functions(spark, f, given, want):
    assert one(spark, given, f) == want


def test_address_parts(spark):
    got = one(spark, "Via Roma 1, 20121 Milano MI, Italia", text.address_parts)
    assert (got.street, got.postal_code) == ("Via Roma 1", "20121") and got.city is not None
    assert one(spark, None, text.address_parts).street is None


def test_chain_brand_prefers_the_longest(spark):
    brands = ["burger", "burger king", "kfc"]
    assert one(spark, "Burger King Duomo", lambda c: text.chain_brand(c, brands)) == "burger king"
    assert one(spark, "burgeria", lambda c: text.chain_brand(c, brands)) is None


def test_hours(spark):
    got = one(spark, "lun 12:00 - 15:00 19:00 - 01:00 mar 9:00 - 10:00", numbers.weekly_hours)
    assert [tuple(h) for h in got] == [("Monday", "12:00", "15:00", False), ("Monday", "19:00", "01:00", True), ("Tuesday", "09:00", "10:00", False)]
    assert tuple(one(spark, 1500, numbers.fold_hours, "int")) == ("01:00", True)
    assert one(spark, 1500, numbers.minutes_text, "int") == "25:00"


def test_tiers_differ(spark):
    row = spark.range(1).select(numbers.flat_tier(F.lit(18)).alias("a"), numbers.integrated_level(F.lit(18)).alias("b"), numbers.price_tier(F.lit(0), F.lit("PRICE_LEVEL_EXPENSIVE"), F.lit(10)).alias("c"), numbers.capped_pct(F.lit(99999), F.lit(100000)).alias("d"), numbers.capped_pct(F.lit(0), F.lit(0)).alias("e"), numbers.money(F.lit(1250), F.lit(2), F.lit("EUR")).alias("f")).first()
    assert tuple(row) == (2, "INEXPENSIVE", 3, 99.99, 0.0, "12.50 €")


def test_labels_flags_votes(spark):
    assert one(spark, "Pizza, pizza , Sushi,", arrays.split_labels) == ["Pizza", "Sushi"]
    assert tuple(one(spark, ["Pizza", "Vegano"], arrays.lift_dietary, "array<string>")) == (["Pizza"], ["Vegano"])
    vote = lambda *x: tuple(spark.range(1).select(arrays.price_vote(*[F.lit(v).cast("string") for v in x]).alias("v")).first().v)
    assert vote("A", "A", "B") == (["A"], "majority") and vote("B", "A", None) == (["A", "B"], "tie") and vote(None, None, "A") == (["A"], "thefork") and vote(None, None, None)[1] is None
    assert one(spark, "x", lambda c: arrays.flags(("a", c == "x"), ("b", c == "y"), ("c", F.lit(True)))) == ["a", "c"]
    status = lambda a, b: spark.range(1).select(arrays.contact_status(F.lit(a).cast("string"), F.lit(b).cast("string")).alias("s")).first().s
    assert [status("1", "1"), status("1", "2"), status("1", None), status(None, None)] == ["exact_match", "conflict", "single_source", "missing"]


def test_json_walk(spark):
    arrays.json_walk(spark)
    rows = spark.sql("""SELECT path, value FROM json_walk('{"a": {"b": [1, "x"]}, "c": null}')""").collect()
    assert [tuple(r) for r in rows] == [("$.a.b[0]", "1"), ("$.a.b[1]", "x"), ("$.c", None)]
    assert spark.sql("SELECT * FROM json_walk('nope')").count() == 0


def test_similarity():
    assert similarity.token_set_ratio("da mario", "mario da") == 1.0
    assert similarity.token_set_ratio("da mario", "da mario duomo") == 1.0
    assert similarity.token_set_ratio("", "x") == 0.0
    assert similarity.indel_ratio("abcd", "abxd") == pytest.approx(0.75)
    assert similarity.token_set_ratio("abcd", "abxd") == pytest.approx(0.75)


def test_similarity_columns(spark):
    row = spark.createDataFrame([("Rist. Da Mario", "da mario ristorante", ["a", "b"], ["b", "c"])], "a string, b string, x array<string>, y array<string>").select(similarity.token_set(F.col("a"), F.col("b")).alias("t"), similarity.jaccard(F.col("x"), F.col("y")).alias("j"), similarity.exact(F.lit(" "), F.lit(" ")).alias("e"), similarity.geo_score(F.lit(250.0)).alias("g"), similarity.geo_score(F.lit(None).cast("double")).alias("n")).first()
    assert (row.t, row.e, row.g, row.n) == (1.0, 0.0, 0.5, 0.0) and row.j == pytest.approx(1 / 3)


def test_geo(spark):
    d = spark.range(1).select(geo.haversine_m(F.lit(45.0), F.lit(9.0), F.lit(45.0009), F.lit(9.0)).alias("d"), geo.valid_coordinate(F.lit(0.0), F.lit(0.0)).alias("z"), geo.in_box(F.lit(45.4), F.lit(9.1)).alias("b")).first()
    assert d.d == pytest.approx(100.07, abs=0.1) and not d.z and d.b
    tiles = geo.tile_grid(spark, 45.0, 9.0, 1000, 500)
    assert tiles.count() == 13
    two = tiles.withColumn("seq", F.lit(1)).unionByName(tiles.withColumn("seq", F.lit(2)))
    assert geo.tile_union(two, 500).where("seq = 2").count() == 0
    anchors = spark.createDataFrame([("navigli_1", 45.0, 9.0, 100.0), ("navigli_2", 45.2, 9.2, 300.0), ("duomo", 45.1, 9.1, 50.0)], "name string, latitude double, longitude double, radius double")
    assert {r.name: r.radius for r in geo.collapse_anchors(anchors).collect()} == {"navigli": 300.0, "duomo": 50.0}
