"""The steps that queries over pairs share: blocks, lookups, least scores, lists; held against all pairs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from plumbline import registry
from plumbline.functions import similarity
from plumbline.functions.geo import haversine_m
from plumbline.functions.numbers import rounded
from plumbline.operators import blocking, linking, scoring
from plumbline.quality import assess

#: Queries whose pairs are dealt out to all cores, by what they stand for; before, few tasks had them all.
DEALT = ["er_one_to_one_links", "as_suggestions", "fn_page_detail", "fn_social_links", "as_geo_error", "er_chain_brands", "er_score_label", "er_token_block", "er_label_counts", "er_topk_groups", "er_competitors", "er_match_confidence", "er_link_union", "er_open_groups", "er_policy", "er_features", "er_adjudicated", "er_geo_block", "er_chain_rules"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in DEALT if n != "er_one_to_one_links"])
def test_pairs_are_dealt_out(spark, sf_dir, name):
    assert "REPARTITION_BY_NUM" in plan(registry.QUERIES[name](spark, sf_dir))


def points(spark, seed: int, n: int, spots: int):
    rng = random.Random(seed)
    at = [(45 + rng.random() / 50, 9 + rng.random() / 50) for _ in range(spots)]
    return spark.createDataFrame([(i, *rng.choice(at), rng.choice("pqrst")) for i in range(n)], "id long, latitude double, longitude double, name string")


def all_pairs(a, s, radius):
    b = s.select(F.col("id").alias("s"), F.col("latitude").alias("la"), F.col("longitude").alias("lo"), F.col("name").alias("s_name"))
    return a.crossJoin(b).where(haversine_m(F.col("latitude"), F.col("longitude"), F.col("la"), F.col("lo")) <= radius)


def test_geo_blocks_of_bounded_size(spark, monkeypatch):
    """Points that by themselves fill several blocks lose no pair and give none twice."""
    monkeypatch.setattr(blocking, "ANCHORS", 3)
    monkeypatch.setattr(blocking, "SOURCES", 2)
    a, s = points(spark, 1, 150, 12), points(spark, 2, 60, 12)
    got = [tuple(r) for r in blocking.geo_pairs(a, s, 300, ("name",)).select("a_id", "s_id").collect()]
    assert sorted(got) == sorted((r.id, r.s) for r in all_pairs(a, s, 300).collect())
    places = blocking.geo_places(a, s, 300).select(F.size("members").alias("n"))
    assert 1 < places.agg(F.max("n")).first()[0] < 12


def test_geo_block_reaches_the_whole_radius(spark):
    """A degree has 111,195 m on the sphere of the distances; with 111,320 the outermost cell was left out."""
    from plumbline.functions.geo import EARTH_M, cell_degrees

    edge = cell_degrees(1500.0) * 3400  # an anchor just above a cell's lower side, a source 1,499.5 m below
    a = spark.createDataFrame([(1, edge + 1e-9, 9.0)], "id long, latitude double, longitude double")
    s = spark.createDataFrame([(2, edge - 1499.5 / EARTH_M * 180 / 3.141592653589793, 9.0)], "id long, latitude double, longitude double")
    assert blocking.geo_pairs(a, s, 1500.0).count() == 1


def test_kinds_equal_those_of_all_pairs(spark):
    a, s = points(spark, 3, 40, 40), points(spark, 4, 12, 12)
    got = sorted(map(tuple, blocking.geo_kinds(a, s, 200.0, "name").collect()))
    assert got == sorted({(r.name, r.s_name) for r in all_pairs(a, s, 200.0).collect()}) and len(got) < 25


def test_similarity_of_names_without_pairs(spark, sf_dir):
    """The query's plan calls Python for distinct pairs of names only: nothing explodes into pairs of records."""
    said = plan(registry.QUERIES["er_name_similarity"](spark, sf_dir))
    assert said.count("ArrowEvalPython") == 1 and "members" not in said and "a_id" not in said


def test_token_blocks_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(blocking, "ANCHORS", 3)
    monkeypatch.setattr(blocking, "SOURCES", 2)
    rng = random.Random(5)
    rows = lambda n: [(i, " ".join(rng.sample(["rosso", "verde", "bianco", "nero", "bar"], 2)), rng.choice(["20121", "20122", " "])) for i in range(n)]
    a, s = rows(60), rows(30)
    kinds = "id long, name string, place string"
    got = sorted(map(tuple, blocking.token_pairs(spark.createDataFrame(a, kinds), spark.createDataFrame(s, kinds)).collect()))
    words = lambda x: {w for w in x.split() if len(w) >= 4}
    assert got == sorted((i, j) for i, x, p in a for j, y, q in s if p == q and p.strip() and words(x) & words(y))


def test_names_are_looked_up_or_compared(spark, monkeypatch):
    a = spark.createDataFrame([(1, "da mario"), (2, "mario"), (3, "")], "a_id long, a_words string")
    s = spark.createDataFrame([(10, "mario bar"), (11, "mario")], "s_id long, s_words string")

    def similarities(most):
        monkeypatch.setattr(similarity, "COMPARED", most)
        found = similarity.Lookup(a, s, {"words": "sim"})
        return bool(found.known), {(r.a_id, r.s_id): r.sim for r in found.added(found.carried(a).crossJoin(found.carried(s))).collect()}

    assert similarities(6) == (True, {(i, j): similarity.token_set_ratio(x, y) for i, x in ((1, "da mario"), (2, "mario"), (3, "")) for j, y in ((10, "mario bar"), (11, "mario"))})
    assert similarities(5) == (False, similarities(6)[1])


def test_least_scores_lose_no_candidate(spark):
    rng = random.Random(6)
    rows = [("t", s, a, rng.choice([None, 0.1, 0.4, 0.4, rng.random()]), rng.random(), 0.5) for s in range(6) for a in range(4 if s == 0 else 40)]
    pairs = spark.createDataFrame(rows, "source string, s_id long, a_id long, score double, geo_dist_m double, name_sim double")
    close = pairs.where("geo_dist_m < 0.5")
    carried = pairs.join(scoring.least_scores(close), ["source", "s_id"], "left")
    best = lambda df: sorted(tuple(r) for r in scoring.top_candidates(df).select("s_id", "a_id", "rank_no").collect())
    assert best(scoring.reaching(carried)) == best(pairs)
    assert scoring.reaching(carried).count() < pairs.count()


def test_greedy_links_from_short_lists(spark):
    """Sources that all of a list refuse come back for more; only lists are written, never all pairs."""
    for trial in range(2):
        rng = random.Random(trial)
        rows = [(rng.randrange(9), rng.randrange(20), f"p{k:03d}", False, rng.choice([None, 0.5, 0.7, 0.9]), rng.random() < 0.3, rng.choice([None, 1.0, 2.0]), rng.choice([None, 0.5])) for k in range(120)]
        df = spark.createDataFrame(rows, "a_id long, s_id long, pair_id string, overridden boolean, score double, fast boolean, geo_dist_m double, name_sim double")
        key = lambda r: (r[3], -1 if r[4] is None else r[4], r[5], -(float("inf") if r[6] is None else r[6]), -1 if r[7] is None else r[7], r[2])
        used_a, used_s, want = set(), set(), set()
        for r in sorted(rows, key=key, reverse=True):
            if r[0] not in used_a and r[1] not in used_s:
                used_a.add(r[0])
                used_s.add(r[1])
                want.add(r[2])
        links = linking.one_to_one(df, k=2)
        assert {r.pair_id for r in links.collect()} == want
        first = next(f for f in links.inputFiles() if "batch=0" in f).rpartition("/")[0]
        assert spark.read.parquet(first).groupBy("s_id").count().agg(F.max("count")).first()[0] == 2


def test_competing_pairs(spark):
    pairs = spark.createDataFrame([(1, 7), (1, 8), (2, 8)], "a_id long, s_id long")
    per_a, per_s = linking.competing(pairs)
    said = linking.conflicts(pairs.join(per_a, "a_id").join(per_s, "s_id").withColumn("overridden", F.col("a_id") == 2)).collect()
    assert {(r.a_id, r.s_id): (r.n_same_a, r.n_same_s, r.conflict_flags) for r in said} == {(1, 7): (1, 0, ["multiple_source_matches"]), (1, 8): (1, 1, ["multiple_source_matches", "source_record_matched_multiple"]), (2, 8): (0, 1, ["llm_override", "source_record_matched_multiple"])}


def test_ranks_from_counts(spark):
    rng = random.Random(7)
    rows = [(g, rng.randrange(9) / 4) for g in "xxy" for _ in range(31)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: tuple(r)[1:] for r in assess.ranked(df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("times")), ["g"], "v", {"p50": 0.5, "p90": 0.9}).collect()}
    want = df.groupBy("g").agg(F.count(F.lit(1)), assess.nearest_rank(F.collect_list("v"), 0.5), assess.nearest_rank(F.collect_list("v"), 0.9), F.max("v"))
    assert got == {r.g: tuple(r)[1:] for r in want.collect()}


def test_rounded_equals_round(spark):
    rng = random.Random(8)
    values = [rng.random() * 10**k for k in range(-7, 7) for _ in range(40)] + [0.0005, 2.5e-6, 1.0000005, 1e300, float("nan"), None]
    df = spark.createDataFrame([(v,) for v in [*values, *(-v for v in values if v)]], "v double")
    assert df.where(~rounded(F.col("v"), 6).eqNullSafe(F.round("v", 6)) | ~rounded(F.col("v"), 3).eqNullSafe(F.round("v", 3))).count() == 0


def test_suggestions_from_blocks(spark, monkeypatch):
    """However thresholds are shared out, the best pairs are the same."""
    rng = random.Random(9)
    df = spark.createDataFrame([(g, rng.randrange(40) / 40, rng.random() < 0.6) for g in "xxxy" for _ in range(40)], "g string, score double, truth boolean")
    best = lambda: sorted(tuple(r) for r in assess.suggestions(df, ["g"]).collect())
    whole = best()
    monkeypatch.setattr(assess, "LOWER", 3)
    monkeypatch.setattr(assess, "HIGHER", 5)
    assert best() == whole and len(whole) == 10


def test_a_page_is_read_once(spark, sf_dir):
    """The JSON of a page was parsed thirteen times, its links found ten times."""
    said = plan(registry.QUERIES["fn_page_detail"](spark, sf_dir))
    assert said.count("from_json") == 1 and said.count("regexp_extract_all") == 1


def test_social_links_of_odd_lists(spark):
    from plumbline.functions import text

    df = spark.createDataFrame([(["https://box.com/a", None, "https://www.x.com/1", "https://facebook.com/b", "http://m.facebook.com/c", "https://x.com/2"],), (None,), ([],)], "u array<string>")
    got = [dict(r.m) for r in df.select(text.social_links(F.col("u")).alias("m")).collect()]
    assert got == [{"facebook": "https://facebook.com/b", "x": "https://www.x.com/1"}, {}, {}]


def test_a_links_host_is_read_once(spark, sf_dir):
    assert plan(registry.QUERIES["fn_social_links"](spark, sf_dir)).count("regexp") < 20
