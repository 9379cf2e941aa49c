from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from plumbline.operators import blocking, cleaning, linking, maintenance, scoring
from plumbline.quality import assess, profile
from plumbline.sources import files
from plumbline.streaming import flows


def test_geo_block_equals_all_pairs(spark):
    from plumbline.functions.geo import haversine_m

    rng = random.Random(1)
    rows = [(i, 45 + rng.random() / 50, 9 + rng.random() / 50) for i in range(200)] + [(900, None, 9.0), (901, 0.0, 0.0)]
    a = spark.createDataFrame(rows, "id long, latitude double, longitude double")
    got = {(r.a_id, r.s_id) for r in blocking.geo_pairs(a, a, 150).collect()}
    b = a.select(F.col("id").alias("s"), F.col("latitude").alias("la"), F.col("longitude").alias("lo"))
    all_ = a.where("id < 900").crossJoin(b.where("s < 900")).where(haversine_m(F.col("latitude"), F.col("longitude"), F.col("la"), F.col("lo")) <= 150)
    assert got == {(r.id, r.s) for r in all_.collect()}


def test_token_block(spark):
    a = spark.createDataFrame([(1, "Trattoria Mario", "20121"), (2, "Bar Uno", "20121"), (3, "Mario", "")], "id long, name string, place string")
    s = spark.createDataFrame([(10, "da MARIO!", "20121"), (11, "mario", "20122")], "id long, name string, place string")
    assert [tuple(r) for r in blocking.token_pairs(a, s).collect()] == [(1, 10)]


def pair(**x):
    base = {"source": "tripadvisor", "geo_dist_m": 10.0, "is_chain": False, "name_sim": 1.0, "geo_score": 1.0, "street_sim": 1.0, "phone_match": 0.0, "website_match": 0.0, "phone_equal": False, "website_equal": False}
    return {**base, **x}


def label(spark, fast=False, **x):
    kinds = "source string, geo_dist_m double, is_chain boolean, name_sim double, geo_score double, street_sim double, phone_match double, website_match double, phone_equal boolean, website_equal boolean"
    return scoring.labelled(spark.createDataFrame([tuple(pair(**x).values())], kinds), scoring.Thresholds((0.4, 0.7)), fast).first()


def test_labels_and_chain_rules(spark):
    assert label(spark).label == "MATCH" and label(spark).score == pytest.approx(0.75)
    assert label(spark, name_sim=0.0, geo_score=0.0).label == "NON_MATCH"
    far = label(spark, is_chain=True, geo_dist_m=80.0)
    assert far.label == "UNCERTAIN" and far.chain_hardening == ["chain_distance_gt_auto_match_radius"]
    assert label(spark, is_chain=True, geo_dist_m=None).chain_hardening == ["chain_no_geo_evidence"]
    assert label(spark, is_chain=True, geo_dist_m=80.0, phone_equal=True).label == "MATCH"
    fast = label(spark, True, name_sim=0.0, phone_equal=True)
    assert (fast.label, fast.score, fast.fast_path) == ("MATCH", 1.0, "phone")
    held = label(spark, True, is_chain=True, website_equal=True, geo_dist_m=10.0)
    assert held.fast_path is None and held.chain_hardening == ["chain_website_fast_path_suppressed"]
    with pytest.raises(ValueError):
        scoring.Thresholds((0.9, 0.5))


def test_greedy_links(spark):
    rng = random.Random(2)
    for trial in range(3):
        rows = [(rng.randrange(12), rng.randrange(12), f"p{k:03d}", False, rng.choice([None, 0.5, 0.7, 0.9]), rng.random() < 0.3, rng.choice([None, 1.0, 2.0]), rng.choice([None, 0.5])) for k in range(60)]
        df = spark.createDataFrame(rows, "a_id long, s_id long, pair_id string, overridden boolean, score double, fast boolean, geo_dist_m double, name_sim double")
        got = {r.pair_id for r in linking.one_to_one(df).collect()}
        key = lambda r: (r[3], -1 if r[4] is None else r[4], r[5], -(float("inf") if r[6] is None else r[6]), -1 if r[7] is None else r[7], r[2])
        used_a, used_s, want = set(), set(), set()
        for r in sorted(rows, key=key, reverse=True):
            if r[0] not in used_a and r[1] not in used_s:
                used_a.add(r[0])
                used_s.add(r[1])
                want.add(r[2])
        assert got == want
    assert linking.one_to_one(df.where("false")).count() == 0


def test_decisions_apply(spark):
    pairs = spark.createDataFrame([("t", 1, 7), ("t", 1, 8), ("t", 2, 9), ("t", 3, 9)], "source string, s_id long, a_id long")
    d = spark.createDataFrame([("t", 1, 7, "MATCH"), ("t", 2, 9, "NON_MATCH"), ("t", 3, 9, "UNCERTAIN")], "source string, s_id long, a_id long, final_decision string")
    got = {(r.s_id, r.a_id): r.llm_label for r in scoring.apply_decisions(pairs, d).collect()}
    assert got == {(1, 7): "MATCH", (1, 8): "NON_MATCH", (2, 9): "NON_MATCH", (3, 9): None}


def test_upserts(spark):
    old = spark.createDataFrame([("a", 0, "x"), ("b", 0, "keep")], "k string, seq int, v string")
    new = spark.createDataFrame([("a", 1, "y"), ("a", 2, "z"), ("b", 1, "no"), (" ", 1, "bad"), ("c", 1, "n")], "k string, seq int, v string")
    assert {r.k: r.v for r in maintenance.upsert(old, new, "k", "seq").collect()} == {"a": "z", "b": "no", "c": "n"}
    assert {r.k: r.v for r in maintenance.protected_upsert(old, new, "k", "seq", F.col("v") == "keep").collect()} == {"a": "z", "b": "keep", "c": "n"}
    docs = spark.createDataFrame([("1", "u", 1), ("2", "u", 2)], "id string, url string, seq int")
    assert {r.lookup_key: r.seq for r in maintenance.keyed_lookup(docs, ["id", "url"], "seq").collect()} == {"1": 1, "2": 2, "u": 2}
    sample = maintenance.stratified(spark.range(100).withColumn("s", F.when(F.col("id") < 5, "few").otherwise("many")), ["s"], "id", 20)
    assert sample.count() == 20 and sample.where("s = 'few'").count() == 5


def test_cleaning_and_integration(spark):
    raw = [{"place_id": "g1", "name": "DA MARIO", "formatted_address": "Via Roma 1 , 20121 Milan", "latitude": 45.46, "longitude": 9.19, "types": ["bar"], "primary_type": "pizza_restaurant", "details": {"rating": 4.5, "userRatingCount": 5, "businessStatus": "OPERATIONAL", "addressComponents": [{"longText": "20121", "shortText": "20121", "types": ["postal_code"]}], "photos": [{"name": "p"}], "priceLevel": "PRICE_LEVEL_MODERATE", "websiteUri": "https://www.mario.it/"}}, {"place_id": " "}]
    google = cleaning.clean_google(spark.read.schema(cleaning.GOOGLE).json(spark.sparkContext.parallelize(map(json.dumps, raw))))
    g = google.first()
    assert google.count() == 1 and g.name == "Da Mario" and g.flags == ["low_review"] and g.category_tier == "restaurant" and g.postal_code == "20121" and g.website == "mario.it" and g.photo_count == 1
    raw = [{"source_url": "https://x/-d77-", "restaurant_name": " Da  Mario ", "rating": "4,0", "total_review": "(1.018 recensioni)", "cuisine_type": "Pizza, Italiana", "price_range": "€€-€€€", "address": "Via Roma, 1, 20121 Milano", "website": "http://mario.it/menu", "phone_number": "NaN", "working_days_hours": "lun 12:00 - 15:00", "review": [{"author": {"nickname": "n"}, "title": "t", "text": "buono Scopri di più", "date_of_publication": "29 maggio 2026"}]}]
    trip = cleaning.clean_tripadvisor(spark.read.schema(cleaning.TRIPADVISOR).json(spark.sparkContext.parallelize(map(json.dumps, raw))))
    t = trip.first()
    assert (t.ta_location_id, t.rating, t.total_review, t.price_tier_level, t.cuisines, t.phone) == ("77", 4.0, 1018, 2, ["Pizza", "Italiana"], None)
    assert t.reviews[0].text == "buono" and t.reviews[0].date == "2026-05-29" and t.flags == []
    raw = [{"source": "thefork", "source_id": "da-mario-r9", "restaurant_name": "Da Mario", "rating": 9.0, "review_count": 30, "cuisine_type": "Pizzeria, Vegano", "price_range": "30 €", "discount": "-20%", "reviews": [{"rating": 6.0}, {"rating": 7.0}], "working_hours_structured": [{"opens": "19:00", "closes": "01:00", "dayOfWeek": ["Monday", "Friday"]}]}]
    fork = cleaning.clean_thefork(spark.read.schema(cleaning.THEFORK).json(spark.sparkContext.parallelize(map(json.dumps, raw))))
    f = fork.first()
    assert (f.tf_id, f.avg_price_eur, f.discount_pct, f.dietary_options, f.sample_avg_rating, f.flags) == ("9", 30, 20, ["Vegano"], 6.5, ["rating_sample_divergent"])
    assert len(f.opening_hours) == 2 and f.opening_hours[0].closes_next_day
    links = spark.createDataFrame([("g1", "tripadvisor", "https://x/-d77-", 1.0), ("g1", "thefork", "gone", 1.0)], "place_id string, source string, source_id string, score double")
    i = cleaning.integrate(google, trip, fork, links).first()
    assert (i.platform_count, i.rating_platform_count, i.rating_range_5, i.website_match_status, i.website) == (2, 2, 0.5, "host_match", "mario.it")
    assert i.price_level == "MODERATE" and i.price_level_source == "majority" and i.cuisine_primary == "Pizza" and i.cuisine_agreement == "agree" and i.integration_flags == ["missing_thefork_source_doc"]
    assert {r.flag: r.n for r in cleaning.report(google).collect()} == {"": 1, "low_review": 1}


def test_profile(spark):
    df = spark.createDataFrame([("1", "http://a.b", "x", 3), ("2", "bad", None, 30), ("2", "nan", "x", 0)], "id string, url string, name string, n int")
    assert {r.field: r.coverage_pct for r in profile.field_coverage(df, ["url", "name"]).collect()} == {"url": 66.67, "name": 66.67}
    assert tuple(profile.validity(df, {"url": "url"}).first()) == ("url", 2, 1, 50.0)
    found = profile.anomalies(df, "id", [("zero", "n", F.col("n") == 0), ("low", "n", (F.col("n") > 0) & (F.col("n") < 20))])
    assert {(r.record_id, r.issue_type) for r in found.collect()} == {("1", "low"), ("2", "zero")}
    assert profile.duplicates(df, ["id"]).first().excess == 1 and profile.top_issues(found).count() == 2
    assert spark.range(1).select(profile.overall({k: F.lit(100.0) for k in profile.WEIGHTS}).alias("o")).first().o == 100.0


def test_assessment(spark):
    df = spark.createDataFrame([(True, "MATCH", "a"), (True, "UNCERTAIN", "a"), (False, "MATCH", "b"), (False, "NON_MATCH", "b")], "truth boolean, label string, source string")
    all_ = assess.confusion(df, "source").where("source = 'all'").first()
    assert (all_.precision, all_.strict_recall, all_.kept_recall, all_.accuracy, all_.uncertain_rate) == (0.5, 0.5, 1.0, 0.5, 0.25)
    ranks = spark.range(1).select(assess.nearest_rank(F.array(*[F.lit(float(k)) for k in range(6)]), 0.5).alias("q")).first().q
    assert ranks == 2.0


def test_files(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text('{"id": "1", "v": 2}\nbroken\n\n{"id": " ", "v": 3}\n')
    from pyspark.sql.types import LongType, StringType, StructType

    schema = StructType().add("id", StringType()).add("v", LongType())
    good, report = files.loaded(files.read_json(spark, str(tmp_path / "r.jsonl"), schema), "id")
    assert [r._id for r in good.collect()] == ["1"] and tuple(report.first()) == (3, 1, 1, 1)
    (tmp_path / "a.json").write_text('[{"id": "1", "v": 1}, {"id": "2", "v": 2}]')
    assert files.read_json(spark, str(tmp_path / "a.json"), schema, array=True).count() == 2
    (tmp_path / "g1.csv").write_text("﻿id,label\nx,MATCH\ny,MAYBE\nx,NON_MATCH\n")
    (tmp_path / "g2.csv").write_text("id,label\nz,match\nx,MATCH\n")
    assert {r.id: r.truth for r in files.read_gold(spark, [str(tmp_path / "g1.csv"), str(tmp_path / "g2.csv")]).collect()} == {"x": True, "z": True}
    df = spark.createDataFrame([("a_b & c", 1.5)], "name string, x double")
    assert r"a\_b \& c & 1.5" in files.latex(df) and "{lr}" in files.latex(df) and "(no rows)" in files.latex(df.where("false"))
    files.write_jsonl(df, str(tmp_path / "out"))
    assert "".join(f.read_text() for f in (tmp_path / "out").glob("*.json")) == '{"name":"a_b & c","x":1.5}\n'
    files.write_csv(df, str(tmp_path / "csv"))
    assert [f.read_text() for f in (tmp_path / "csv").glob("*.csv")] == ["name,x\na_b & c,1.5\n"]
    assert json.loads(files.manifest({"t": df})) == {"t": 1}
    specs = {"g": files.SourceSpec("g", "p", "jsonl", "id")}
    assert files.resolve(specs, "all") == files.resolve(specs, "g")
    with pytest.raises(ValueError):
        files.resolve(specs, "nope")


def test_latex_writes_every_row(spark):
    assert files.latex(spark.range(250)).count(r" \\") == 251


def test_stream_equals_batch(spark, tmp_path):
    from pyspark.sql.types import LongType, StringType, StructType

    schema = StructType().add("k", StringType()).add("seq", LongType()).add("v", StringType())
    source, target, checkpoint = (str(tmp_path / x) for x in ("in", "out", "ck"))
    first = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y"), ("a", 2, "z")], schema)
    second = spark.createDataFrame([("b", 5, "new"), ("c", 1, "c")], schema)
    for part in (first, second):
        part.coalesce(1).write.mode("append").parquet(source)
        flows.upsert_stream(spark, source, schema, target, checkpoint, "k", "seq").awaitTermination()
    assert {r.k: r.v for r in flows.latest(spark, target).collect()} == {"a": "z", "b": "new", "c": "c"}


def test_sliding_alarm_equals_brute_force(spark):
    rng = random.Random(4)
    rows = [(k, f"u{rng.randrange(6)}", 1_700_000_000 + rng.randrange(4000)) for k in range(150)]
    df = spark.createDataFrame(rows, "event_id long, user string, s long").withColumn("ts", F.timestamp_seconds("s"))
    got = {r.event_id: (r.distinct_keys, r.alarm) for r in flows.sliding_alarm(df, "event_id", "user", "ts", 60, 3, slot_s=500).collect()}
    for k, _, s in rows:
        n = len({u for _, u, t in rows if s - 60 <= t <= s})
        assert got[k] == (n, n >= 3)


def test_json_array_and_done_sets(spark, tmp_path):
    df = spark.createDataFrame([("b", 1), ("a", None)], "k string, v long").repartition(2)
    assert files.write_json_array(df, str(tmp_path / "a.json")) == 2
    assert sorted(json.loads((tmp_path / "a.json").read_text()), key=lambda x: x["k"]) == [{"k": "a", "v": None}, {"k": "b", "v": 1}]
    files.write_json_array(df.where("false"), str(tmp_path / "none.json"))
    assert json.loads((tmp_path / "none.json").read_text()) == []
    done = str(tmp_path / "done")
    assert files.remaining(spark, df, "k", done).count() == 2
    files.mark_done(df.where("v = 1"), "k", done)
    files.mark_done(df.where("v = 1"), "k", done)
    assert [r.k for r in files.remaining(spark, df, "k", done).collect()] == ["a"]


def test_invalid_json_is_an_anomaly(spark, tmp_path):
    from pyspark.sql.types import LongType, StructType

    (tmp_path / "r.jsonl").write_text('{"v": 2}\nbroken\n')
    found = profile.invalid_json(files.read_json(spark, str(tmp_path / "r.jsonl"), StructType().add("v", LongType())), files.CORRUPT, "v", "google")
    assert [tuple(r) for r in found.collect()] == [("google", "invalid_json", "_corrupt", "broken")]


def test_a_client_that_fails_leaves_its_group_open(spark):
    rows = [("tripadvisor", s, a, k, 10.0, 0.9, 0.1, 1.0, 0.0) for s in (1, 2) for k, a in enumerate((7, 8), 1)]
    ranked = spark.createDataFrame(rows, "source string, s_id long, a_id long, rank_no int, geo_dist_m double, name_sim double, street_sim double, phone_match double, website_match double")

    def client(group):
        if group["s_id"] == 2:
            raise TimeoutError
        return {"a_id": group["candidates"][1]["a_id"], "decision": "MATCH", "confidence": 1, "risk_flag": None}

    got = {r.s_id: tuple(r)[2:] for r in scoring.adjudicated(ranked, client).collect()}
    assert got == {1: (8, "MATCH", 1.0, None), 2: (None, "UNCERTAIN", 0.0, "client_error: TimeoutError")}
    assert {r.decision for r in scoring.adjudicated(ranked).collect()} == {"UNCERTAIN"} and scoring.adjudicated(ranked.where("false")).count() == 0


def test_stores_and_merges(spark):
    v = spark.createDataFrame([("a", 1, "x", 10, None), ("a", 3, "y", 20, "d"), ("a", 5, "z", None, None), (" ", 1, "x", 1, "d")], "k string, seq long, status string, seeded long, details string")
    assert [tuple(r) for r in maintenance.keyed_store(v.where("seq < 3"), v.where("seq >= 3"), "k", "seq", ["seeded"], ["details"]).collect()] == [("a", 5, "z", 10, "d")]
    key = lambda *x: spark.range(1).select(maintenance.merge_key(*[F.lit(y).cast("string") for y in x]).alias("k")).first().k
    assert [key(" u ", "1", "N", "A"), key(" ", "1", "N", "A"), key(None, "", "N", "A")] == ["url:u", "id:1", "na:n|a"]
    shards = spark.createDataFrame([("a", "1", 1, True, 1), ("a", "2", 2, True, 5), ("a", "2", 3, False, 9), ("b", "1", 4, False, 0), ("b", "2", 5, False, 0)], "key string, shard string, seq long, detail boolean, rich int")
    merged = maintenance.merged_shards(shards, "key", "shard", "seq", F.col("detail"), F.col("rich"))
    assert {r.key: (r.shard, r.seq, r.n_versions, r.n_shards) for r in merged.collect()} == {"a": ("2", 2, 3, 2), "b": ("1", 4, 2, 2)}
    state = maintenance.crawl_state(*[spark.createDataFrame([(k,) for k in ks], "k string") for ks in ("abcd", "a", "ab", "cx")], "k")
    assert {r.k: (r.state, r.in_master, r.redo) for r in state.collect()} == {"a": ("processed", True, False), "b": ("failed", True, True), "c": ("processed", True, False), "d": ("redo", True, True), "x": ("processed", False, False)}


def test_thresholds_by_brute_force(spark):
    rng = random.Random(8)
    rows = [(g, rng.random() < 0.5 if g == "a" else True, round(min(1.0, max(0.0, rng.gauss(0.5, 0.3))), 2)) for g in "ab" for _ in range(40)]
    df = spark.createDataFrame(rows, "g string, truth boolean, score double")

    def rates(part, lo, hi):
        tp, fp = (sum(s >= hi and t == x for _, t, s in part) for x in (True, False))
        fn, positive = sum(s <= lo and t for _, t, s in part), sum(t for _, t, _ in part)
        p, r, u = tp / (tp + fp) if tp + fp else None, (positive - fn) / positive if positive else None, sum(lo < s < hi for _, _, s in part) / len(part)
        return p, r, u, fn, p is not None and r is not None and p >= 0.9 and r >= 0.97

    best = {r.g: r for r in assess.recommended(assess.threshold_grid(df, 100, ["g"]), ["g"]).collect()}
    said = {(r.g, r.rank_no): (r.lo, r.hi) for r in assess.suggestions(df, ["g"]).collect()}
    summed = {r.g: tuple(r)[1:] for r in assess.score_summary(df, ["g"]).collect()}
    for g in "ab":
        part = [r for r in rows if r[0] == g]
        grid = [(lo / 100, hi / 100) for lo in range(101) for hi in range(lo + 1, 101)]
        found = [(x, rates(part, *x)) for x in grid]
        order = lambda m: (0 if m[1][4] and m[1][2] <= 0.1 else 1 if m[1][4] else 2, m[1][3], -(m[1][0] or 0), m[1][2], -(m[1][1] or 0))
        top = min(found, key=order)
        assert (best[g].lo / 100, best[g].hi / 100) == top[0] and best[g].fn == top[1][3]
        marks = sorted({0.0, 0.4, 0.85, 1.0, *(s for _, _, s in part)})
        pairs = [((lo, hi), rates(part, lo, hi)) for lo in marks for hi in marks if lo < hi]
        ranked = sorted(pairs, key=lambda m: (not m[1][4], m[1][2], -(m[1][0] or 0), -(m[1][1] or 0), *m[0]))[:5]
        assert [said[g, k] for k in range(1, 6)] == [x for x, _ in ranked]
        ordered = sorted(s for _, _, s in part)
        assert summed[g] == (40, ordered[0], *(ordered[round(39 * q)] for q in (0.25, 0.5, 0.75)), ordered[-1])


def test_mann_whitney_by_brute_force(spark):
    rng = random.Random(3)
    rows = [("g", rng.random() < 0.4, rng.randrange(8) / 2) for _ in range(60)]
    got = assess.mann_whitney(spark.createDataFrame(rows, "g string, one boolean, v double"), ["g"], "one", "v").first()
    a, b = [v for _, o, v in rows if o], [v for _, o, v in rows if not o]
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    assert got.u == u and abs(got.effect - (2 * u / len(a) / len(b) - 1)) < 1e-12


def test_deferrals_of_a_stream_equal_the_batch(spark, tmp_path):
    rng = random.Random(2)
    rows = [(f"k{rng.randrange(5)}", c, rng.random() < 0.3) for c in range(60)]
    schema = "k string, cycle long, ok boolean"
    batch = {r.k: tuple(r)[1:] for r in flows.deferrals(spark.createDataFrame(rows, schema), "k", "cycle", "ok", 3, 10).collect()}
    state: dict = {}
    for k, c, ok in rows:
        state[k] = (0, None) if ok else (state.get(k, (0, None))[0] + 1, c)
    assert batch == {k: (n, c, c + 10 if n >= 3 else None) for k, (n, c) in state.items() if n}
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "ck")
    seen: dict = {}
    for some in (rows[:30], rows[30:]):
        spark.createDataFrame(some, schema).coalesce(1).write.mode("append").parquet(source)
        found = flows.deferrals_stream(spark.readStream.schema(schema).parquet(source), "k", "cycle", "ok", 3, 10)
        found.writeStream.outputMode("update").foreachBatch(lambda df, _: seen.update({r.k: tuple(r)[1:] for r in df.collect()})).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    assert {k: x for k, x in seen.items() if x[0]} == batch


def test_upserts_leave_untouched_buckets_alone(spark, tmp_path):
    from pyspark.sql.types import LongType, StringType, StructType

    schema = StructType().add("k", StringType()).add("seq", LongType())
    source, target, checkpoint = (str(tmp_path / x) for x in ("in", "out", "ck"))
    for part in ([(f"k{i}", 1) for i in range(40)], [("k3", 2)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        flows.upsert_stream(spark, source, schema, target, checkpoint, "k", "seq", buckets=8).awaitTermination()
    versions = sorted(p.name for p in (tmp_path / "out").glob("_bucket=*/v*"))
    assert versions.count("v00000001") == 1 and len(versions) == 8
    assert {r.k: r.seq for r in flows.latest(spark, target).collect()} == {f"k{i}": 2 if i == 3 else 1 for i in range(40)}


def test_windows_with_many_keys_alarm(spark, tmp_path):
    rows = [(f"u{k}", 60 * k) for k in range(5)] + [("u9", 10_000)]
    spark.createDataFrame(rows, "user string, s long").select("user", F.timestamp_seconds(F.col("s") + 1_700_000_000).alias("ts")).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("user string, ts timestamp").parquet(str(tmp_path / "in"))
    got = []
    flows.windowed_alarm(stream, "user", "ts", "10 minutes", "5 minutes", 3).writeStream.outputMode("append").foreachBatch(lambda df, _: got.extend(r.distinct_keys for r in df.collect())).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    assert got and all(n >= 3 for n in got)


def test_a_question_reads_what_it_needs(spark, sf_dir):
    from plumbline import registry

    read = lambda name: registry.QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert read("q0_coverage").count("Relation") == 1 and read("q8_price_rows").count("Relation") == 2


def test_small_functions(spark):
    from plumbline.functions import arrays, numbers, text

    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(text.pair_brand(F.lit("b"), F.lit("a"))) == "a|b" and one(text.pair_brand(F.lit(None), F.lit("a"))) == "a" and one(text.pair_brand(F.lit(None), F.lit(None))) is None
    assert one(text.out_of_area(F.lit(" Rho "))) and not one(text.out_of_area(F.lit("Milano"))) and not one(text.out_of_area(F.lit(None)))
    assert one(text.social_links(F.array(F.lit("https://www.facebook.com/a"), F.lit("https://facebook.com/b"), F.lit("https://x.com/c")))) == {"facebook": "https://www.facebook.com/a", "x": "https://x.com/c"}
    assert one(arrays.canonical_hash(F.struct(F.lit(1).alias("a")))) == one(arrays.canonical_hash(F.struct(F.lit(1).alias("a"))))
    assert one(numbers.comparable_rating(F.lit(8.0), F.lit(10))) == 4.0
    assert profile.flagged_duplicates(spark.createDataFrame([(1,), (1,), (2,)], "k long"), ["k"]).where("is_duplicate").count() == 2
    coverage = profile.field_coverage(spark.createDataFrame([("a", None), ("b", None)], "x string, y string"), ["x", "y"])
    assert profile.lowest_coverage(coverage, 1).first().field == "y"
