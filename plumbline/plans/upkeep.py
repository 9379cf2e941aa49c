"""Queries of calibration, holdouts, merges, flat tables, deferrals and quality summaries, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import numbers
from plumbline.operators import blocking, linking, maintenance, projection, scoring
from plumbline.plans.listing import SQL, listing, table
from plumbline.plans.records import BASE, GOLD, RADIUS, anchors, best_candidates, candidates, gold, part, sources
from plumbline.quality import assess, profile
from plumbline.streaming import flows

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


r6 = lambda c: F.round(c, 6)

# calibration and holdouts

RATES = "tp / nullif(tp + fp, 0) AS precision, (positive - fn) / nullif(positive, 0) AS kept_recall, uncertain / nullif(n, 0) AS uncertain_rate"
MEETS = "coalesce(precision >= 0.9 AND kept_recall >= 0.97, false)"


@query(f"""WITH g AS ({GOLD}), t AS (SELECT a.i AS lo, b.i AS hi FROM range(21) a(i), range(21) b(i) WHERE a.i < b.i),
m AS (SELECT lang, lo, hi, count(*) FILTER (truth AND floor(round(score * 20, 9)) >= hi) AS tp, count(*) FILTER (NOT truth AND floor(round(score * 20, 9)) >= hi) AS fp, count(*) FILTER (truth AND ceil(round(score * 20, 9)) <= lo) AS fn, count(*) FILTER (floor(round(score * 20, 9)) < hi AND ceil(round(score * 20, 9)) > lo) AS uncertain, count(*) FILTER (truth) AS positive, count(*) AS n FROM g, t GROUP BY 1, 2, 3),
r AS (SELECT *, {RATES} FROM m), o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY CASE WHEN {MEETS} AND uncertain_rate <= 0.1 THEN 0 WHEN {MEETS} THEN 1 ELSE 2 END, fn, coalesce(precision, 0) DESC, coalesce(uncertain_rate, 1), coalesce(kept_recall, 0) DESC, lo, hi) AS k FROM r)
SELECT lang, CAST(lo AS INTEGER) AS lo, CAST(hi AS INTEGER) AS hi, round(precision, 6) AS precision, round(kept_recall, 6) AS kept_recall, round(uncertain_rate, 6) AS uncertain_rate, fn, n FROM o WHERE k = 1""")
def as_calibration(spark, sf_dir):
    """The thresholds to work with for each group of labelled rows."""
    best = assess.recommended(assess.threshold_grid(gold(spark, sf_dir), 20, ["lang"]), ["lang"])
    return best.select("lang", "lo", "hi", *[r6(F.col(c)).alias(c) for c in ("precision", "kept_recall", "uncertain_rate")], "fn", "n")


@query(f"""WITH g AS ({GOLD}), t AS (SELECT DISTINCT lang, score AS x FROM g UNION SELECT lang, x FROM (SELECT DISTINCT lang FROM g), (VALUES (0.0::DOUBLE), (0.4), (0.85), (1.0)) v(x)),
c AS (SELECT a.lang, a.x AS lo, b.x AS hi FROM t a JOIN t b ON a.lang = b.lang AND a.x < b.x),
m AS (SELECT c.lang, lo, hi, count(*) FILTER (truth AND score >= hi) AS tp, count(*) FILTER (NOT truth AND score >= hi) AS fp, count(*) FILTER (truth AND score <= lo) AS fn, count(*) FILTER (score < hi AND score > lo) AS uncertain, count(*) FILTER (truth) AS positive, count(*) AS n FROM c JOIN g ON g.lang = c.lang GROUP BY 1, 2, 3),
r AS (SELECT *, {RATES} FROM m), q AS (SELECT *, {MEETS} AS meets FROM r), o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY meets DESC, coalesce(uncertain_rate, 1), coalesce(precision, 0) DESC, coalesce(kept_recall, 0) DESC, lo, hi) AS k FROM q)
SELECT lang, CAST(k AS INTEGER) AS rank_no, lo, hi, round(precision, 6) AS precision, round(kept_recall, 6) AS kept_recall, round(uncertain_rate, 6) AS uncertain_rate, meets FROM o WHERE k <= 5""")
def as_suggestions(spark, sf_dir):
    """The five best pairs of thresholds for each group, among the scores that occur."""
    best = assess.suggestions(gold(spark, sf_dir), ["lang"])
    return best.select("lang", "rank_no", "lo", "hi", *[r6(F.col(c)).alias(c) for c in ("precision", "kept_recall", "uncertain_rate")], "meets")


@query(f"""WITH g AS ({GOLD}), e AS (SELECT lang, list_sort(list(score)) AS s FROM g GROUP BY 1)
SELECT lang, len(s) AS n, s[1] AS least, """ + ", ".join(f"s[1 + CAST(round_even((len(s) - 1) * {q}, 0) AS INTEGER)] AS p{round(100 * q)}" for q in (0.25, 0.5, 0.75)) + ", s[-1] AS most FROM e")
def as_score_summary(spark, sf_dir):
    return assess.score_summary(gold(spark, sf_dir), ["lang"])


CELLS = ", ".join(f"count(*) FILTER ({'' if t else 'NOT '}truth AND label = '{x}') AS {k}" for t, x, k in ((True, "MATCH", "tp"), (False, "MATCH", "fp"), (True, "NON_MATCH", "fn"), (False, "NON_MATCH", "tn"), (True, "UNCERTAIN", "up"), (False, "UNCERTAIN", "un")))


@query(f"""WITH g AS (SELECT *, CAST(doc_id % 2 = 0 AS VARCHAR) AS chain FROM ({GOLD})) SELECT coalesce(lang, 'all') AS lang, coalesce(chain, 'all') AS chain, {CELLS}, round(count(*) FILTER (truth AND label = 'MATCH') / nullif(count(*) FILTER (label = 'MATCH'), 0), 6) AS precision FROM g GROUP BY CUBE (lang, chain)""")
def as_confusion_cross(spark, sf_dir):
    """Confusion by source, by chain, by both and over all."""
    rows = gold(spark, sf_dir).withColumn("chain", (F.col("doc_id") % 2 == 0).cast("string"))
    return assess.confusion(rows, "lang", "chain").select("lang", "chain", "tp", "fp", "fn", "tn", "up", "un", "precision")


@query(f"WITH g AS ({GOLD}) SELECT doc_id, lang, label FROM g WHERE doc_id NOT IN (SELECT doc_id FROM g WHERE doc_id % 3 = 0)")
def as_holdout(spark, sf_dir):
    """Labelled rows without those that thresholds were calibrated on."""
    rows = gold(spark, sf_dir).select("doc_id", "lang", "label")
    return maintenance.excluding(rows, rows.where("doc_id % 3 = 0"), key="doc_id")


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL) AND doc_id NOT IN (SELECT item_id FROM benchmark)")
def as_unlabelled(spark, sf_dir):
    """What can be handed out for labelling: rows that no label file has."""
    labels, more = table(spark, sf_dir, "labels").select("doc_id"), table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"))
    return maintenance.excluding(table(spark, sf_dir, "documents").select("doc_id", "lang"), labels, more, key="doc_id")


# adjudication and links

JUDGED = ", judged AS (SELECT *, CASE WHEN s_id % 5 = 0 AND a_id % 2 = 0 THEN 'MATCH' WHEN a_id % 7 = 0 THEN ' ' END AS llm_label, CASE WHEN a_id % 4 = 0 THEN 0.75 END AS llm_confidence FROM hardened)"


def judged(pairs):
    a, s = F.col("a_id"), F.col("s_id")
    label = F.when((s % 5 == 0) & (a % 2 == 0), "MATCH").when(a % 7 == 0, " ")
    return pairs.withColumn("llm_label", label).withColumn("llm_confidence", F.when(a % 4 == 0, 0.75))


@query(BASE + JUDGED + "SELECT a_id, s_id, round(CASE WHEN trim(coalesce(llm_label, '')) <> '' AND llm_confidence IS NOT NULL THEN llm_confidence ELSE score END, 6) AS match_confidence, coalesce(nullif(trim(llm_label), ''), label) AS effective_label FROM judged")
def er_match_confidence(spark, sf_dir):
    return judged(candidates(spark, sf_dir)).select("a_id", "s_id", numbers.rounded(scoring.match_confidence(F.col("llm_label"), F.col("llm_confidence"), F.col("score")), 6).alias("match_confidence"), scoring.effective_label(F.col("llm_label"), F.col("label")).alias("effective_label"))


@query(BASE + JUDGED + "SELECT a_id, s_id FROM judged WHERE s_id NOT IN (SELECT s_id FROM judged WHERE trim(coalesce(llm_label, '')) <> '')")
def er_open_groups(spark, sf_dir):
    """Candidates of the groups that still wait for an adjudication."""
    pairs = lambda rows: blocking.geo_pairs(anchors(spark, sf_dir), rows, RADIUS, of_s=("source",))
    done = scoring.judged_groups(judged(pairs(sources(spark, sf_dir)))).withColumnRenamed("s_id", "id")
    return pairs(sources(spark, sf_dir).join(done, ["source", "id"], "left_anti")).select("a_id", "s_id")


@query(BASE + """, topped AS (SELECT *, row_number() OVER (PARTITION BY source, s_id ORDER BY score DESC, geo_dist_m, name_sim DESC, a_id) AS rank_no FROM hardened),
g AS (SELECT b.source, b.s_id, b.a_id, b.geo_dist_m AS d, b.name_sim AS name, b.street_sim AS street, b.phone_match + b.website_match > 0 AS contact, s.name_sim AS name2, s.geo_dist_m AS d2 FROM topped b LEFT JOIN topped s ON s.source = b.source AND s.s_id = b.s_id AND s.rank_no = 2 WHERE b.rank_no = 1),
h AS (SELECT source, s_id, a_id, CASE WHEN coalesce(name2 >= .75 AND d2 <= 100 AND name >= .75, false) THEN 1 WHEN contact AND d <= 1000 THEN 2 WHEN d <= 50 AND (name >= .75 OR street >= .8) THEN 3 WHEN d > 300 THEN 4 ELSE 5 END AS k FROM g)
SELECT source, s_id, a_id, list_extract(['UNCERTAIN', 'MATCH', 'MATCH', 'NON_MATCH', 'UNCERTAIN'], k) AS decision, list_extract([0.62::DOUBLE, 0.92, 0.90, 0.82, 0.60], k) AS confidence, list_extract(['multiple_plausible_candidates', NULL, NULL, 'large_distance', 'insufficient_evidence'], k) AS risk_flag FROM h""")
def er_adjudicated(spark, sf_dir):
    """Each group as a client decides it that is called with its candidates."""
    return scoring.adjudicated(best_candidates(spark, sf_dir))


@query(BASE + "SELECT a_id, s_id, source FROM hardened WHERE source = 'tripadvisor' AND label = 'MATCH' UNION ALL SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 3 = 0 THEN 'tripadvisor' ELSE 'thefork' END FROM customer WHERE c_custkey % 3 <> 0")
def er_link_union(spark, sf_dir):
    """New links of one source beside the links that others have already."""
    new = candidates(spark, sf_dir, s=sources(spark, sf_dir).where("source = 'tripadvisor'")).where("label = 'MATCH'").select("a_id", "s_id", "source")
    key = F.col("c_custkey")
    old = table(spark, sf_dir, "customer").select(key.alias("a_id"), F.col("c_nationkey").cast("long").alias("s_id"), F.when(key % 3 == 0, "tripadvisor").otherwise("thefork").alias("source"))
    return linking.with_others(new, old, ["tripadvisor"])


# stores and merges


@query("""WITH v AS (SELECT o_custkey AS k, o_orderkey AS seq, o_orderpriority AS status, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate END AS seeded_at, CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice END AS details FROM orders)
SELECT k, max(seq) AS seq, arg_max(status, seq) AS status, arg_min(seeded_at, seq) FILTER (seeded_at IS NOT NULL) AS seeded_at, arg_max(details, seq) FILTER (details IS NOT NULL) AS details FROM v GROUP BY k""")
def mt_keyed_store(spark, sf_dir):
    """A store that keeps when a key was seen first, and its last details even where a newer version has none."""
    seq = F.col("o_orderkey")
    v = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), seq.alias("seq"), F.col("o_orderpriority").alias("status"), F.when(seq % 3 != 0, F.col("o_orderdate")).alias("seeded_at"), F.when(seq % 4 == 0, F.col("o_totalprice")).alias("details"))
    return maintenance.keyed_store(v.where("seq % 2 = 0"), v.where("seq % 2 = 1"), "k", "seq", ["seeded_at"], ["details"])


SHARDS = "(SELECT p_name AS key, CAST(p_partkey % 4 AS VARCHAR) AS shard, p_partkey AS seq, p_brand AS phone, CASE WHEN p_size > 20 THEN p_type END AS website, p_size % 3 = 0 AS detail_scraped, CASE WHEN p_size % 3 = 0 THEN 10 ELSE 0 END + 3 + CASE WHEN p_size > 20 THEN 3 ELSE 0 END AS rich FROM part)"


def shards(spark, sf_dir):
    size, key = F.col("p_size"), F.col("p_partkey")
    rows = part(spark, sf_dir).select(F.col("p_name").alias("key"), (key % 4).cast("string").alias("shard"), key.alias("seq"), F.col("p_brand").alias("phone"), F.when(size > 20, F.col("p_type")).alias("website"), (size % 3 == 0).alias("detail_scraped"))
    return rows, F.col("detail_scraped"), F.when(F.col("detail_scraped"), 10).otherwise(0) + maintenance.weighted_richness({"phone": 3, "website": 3})


@query(f"SELECT key, shard, seq, n_versions, n_shards FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY detail_scraped DESC, rich DESC, seq) AS k, count(*) OVER (PARTITION BY key) AS n_versions FROM {SHARDS}) JOIN (SELECT key, count(DISTINCT shard) AS n_shards FROM {SHARDS} GROUP BY 1) USING (key) WHERE k = 1")
def mt_shard_merge(spark, sf_dir):
    """Records of several workers: one with details before others, then the richest, then the first."""
    rows, detail, rich = shards(spark, sf_dir)
    return maintenance.merged_shards(rows, "key", "shard", "seq", detail, rich).select("key", "shard", "seq", "n_versions", "n_shards")


@query(f"""WITH s AS (SELECT * FROM {SHARDS}), m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY detail_scraped DESC, rich DESC, seq) AS k FROM s) WHERE k = 1)
SELECT shard, count(*) AS records, count(*) FILTER (detail_scraped) AS with_detail, round(avg(rich), 6) AS mean_richness, (SELECT count(*) FROM m WHERE m.shard = s.shard) AS chosen FROM s GROUP BY shard
UNION ALL SELECT '', count(*), count(*) FILTER (detail_scraped), round(avg(rich), 6), count(*) FROM m""")
def mt_merge_audit(spark, sf_dir):
    rows, detail, rich = shards(spark, sf_dir)
    return maintenance.merge_audit(rows, maintenance.merged_shards(rows, "key", "shard", "seq", detail, rich), "key", "shard", detail, rich)


@query("""WITH done AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' UNION SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'), bad AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'P'), master AS (SELECT c_custkey AS k FROM customer), a AS (SELECT k FROM done UNION SELECT k FROM bad UNION SELECT k FROM master)
SELECT k, CASE WHEN k IN (SELECT k FROM done) THEN 'processed' WHEN k IN (SELECT k FROM bad) THEN 'failed' ELSE 'redo' END AS state, k IN (SELECT k FROM master) AS in_master, k IN (SELECT k FROM master) AND k NOT IN (SELECT k FROM done) AS redo FROM a""")
def mt_crawl_state(spark, sf_dir):
    """What checkpoints, failures and records say of each address of the master list."""
    of = lambda condition: table(spark, sf_dir, "orders").where(condition).select(F.col("o_custkey").alias("k"))
    return maintenance.crawl_state(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), of("o_orderstatus = 'F'"), of("o_orderstatus = 'P'"), of("o_orderpriority = '1-URGENT'"), "k")


@query("""WITH d AS (SELECT s_suppkey * 3 AS k, CASE WHEN s_suppkey % 2 = 0 THEN 's' || s_suppkey END AS name, CASE WHEN s_suppkey % 5 > 0 THEN 'a' || s_suppkey ELSE ' ' END AS address FROM supplier), r AS (SELECT p_partkey AS k, p_name AS name, CASE WHEN p_size > 25 THEN p_brand END AS address FROM part)
SELECT r.k, coalesce(d.name, r.name) AS name, coalesce(r.address, nullif(d.address, ' ')) AS address, d.k IS NOT NULL AS updated FROM r LEFT JOIN d USING (k)""")
def int_detail_merge(spark, sf_dir):
    """Seeds with what their details say: a value that is there replaces the seed's, but an address only where the seed has none."""
    key = F.col("s_suppkey")
    details = table(spark, sf_dir, "supplier").select((key * 3).alias("k"), F.when(key % 2 == 0, F.concat(F.lit("s"), key.cast("string"))).alias("name"), F.when(key % 5 > 0, F.concat(F.lit("a"), key.cast("string"))).otherwise(" ").alias("address"))
    seeds = part(spark, sf_dir).select(F.col("p_partkey").alias("k"), F.col("p_name").alias("name"), F.when(F.col("p_size") > 25, F.col("p_brand")).alias("address"))
    return maintenance.filled(seeds, details, "k", ["name", "address"], keep=("address",))


@query("SELECT p_partkey, array_to_string(list_filter([p_name, CASE WHEN p_size > 10 THEN p_brand END, CASE WHEN p_name <> p_type THEN p_type END], lambda x: x IS NOT NULL), '|') AS snippets FROM part")
def int_review_texts(spark, sf_dir):
    """Texts of a record and of its details, each once."""
    name, brand, kind = F.col("p_name"), F.when(F.col("p_size") > 10, F.col("p_brand")), F.col("p_type")
    return part(spark, sf_dir).select("p_partkey", F.array_join(maintenance.joined_texts(F.array(name, brand, F.lit(" ")), F.array(F.concat(F.lit(" "), name), kind)), "|").alias("snippets"))


# flat tables of the clean sources

CLEAN = {
    "google": ("place_id", {"name": "p_name", "street": "CASE WHEN p_size > 10 THEN p_brand END", "rating": "p_size / 10.0::DOUBLE", "photo_count": "CASE WHEN p_size > 20 THEN p_size END", "types": "CASE WHEN p_size > 5 THEN [p_type] END", "has_website": "CASE WHEN p_size > 15 THEN p_size % 2 = 0 END", "flags": "CASE WHEN p_size < 9 THEN [p_brand, p_type] END"}),
    "tripadvisor": ("source_url", {"restaurant_name": "p_name", "price_band": "CASE WHEN p_size > 10 THEN p_brand END", "rating": "p_size / 10.0::DOUBLE", "photo_count": "CASE WHEN p_size > 20 THEN p_size END", "cuisines": "CASE WHEN p_size > 5 THEN [p_type] END", "has_email": "CASE WHEN p_size > 15 THEN p_size % 2 = 0 END"}),
    "thefork": ("source_id", {"restaurant_name": "p_name", "tf_id": "CASE WHEN p_size > 10 THEN p_brand END", "avg_price_eur": "p_size", "sample_size": "CASE WHEN p_size > 20 THEN p_size END", "dietary_options": "CASE WHEN p_size > 5 THEN [p_type] END", "has_hours": "CASE WHEN p_size > 15 THEN p_size % 2 = 0 END"}),
}
_EMPTY = {projection.TEXT: "coalesce(CAST({} AS VARCHAR), '')", projection.LIST: "coalesce({}, [])", projection.FLAG: "CAST(coalesce({}, false) AS INTEGER)", projection.COUNT: "CAST(coalesce({}, 0) AS BIGINT)", projection.NUMBER: "{}"}
_MISSING = {projection.TEXT: "NULL", projection.LIST: "CAST(NULL AS VARCHAR[])", projection.FLAG: "NULL::BOOLEAN", projection.COUNT: "NULL::BIGINT", projection.NUMBER: "NULL::DOUBLE"}


def _flat_sql(source: str) -> str:
    key, have = CLEAN[source]
    columns = projection.KEYS[source][1]
    said = ", ".join(f"{_EMPTY[kind].format('(' + have.get(c, _MISSING[kind]) + ')')} AS {c}" for c, kind in columns.items() if c != key)
    return f"SELECT k AS {key}, {said} FROM (SELECT *, CASE WHEN p_partkey % 9 > 0 THEN 'k' || p_partkey WHEN p_partkey % 2 = 0 THEN ' ' END AS k FROM part) WHERE trim(k) <> ''"


def _flat(source: str):
    def run(spark, sf_dir):
        size, key, kind = F.col("p_size"), F.col("p_partkey"), F.array("p_type")
        values = {
            "p_name": F.col("p_name"), "CASE WHEN p_size > 10 THEN p_brand END": F.when(size > 10, F.col("p_brand")), "p_size / 10.0::DOUBLE": size / 10.0, "CASE WHEN p_size > 20 THEN p_size END": F.when(size > 20, size), "p_size": size,
            "CASE WHEN p_size > 5 THEN [p_type] END": F.when(size > 5, kind), "CASE WHEN p_size > 15 THEN p_size % 2 = 0 END": F.when(size > 15, size % 2 == 0), "CASE WHEN p_size < 9 THEN [p_brand, p_type] END": F.when(size < 9, F.array("p_brand", "p_type")),
        }
        name, have = CLEAN[source]
        clean = part(spark, sf_dir).select(F.when(key % 9 > 0, F.concat(F.lit("k"), key.cast("string"))).when(key % 2 == 0, " ").alias(name), *[values[v].alias(c) for c, v in have.items()])
        return projection.flat(clean, source)

    run.__name__ = f"flat_clean_{source}"
    return run


for _source in CLEAN:
    query(_flat_sql(_source))(_flat(_source))


# quality summaries and deferrals

SUMMARY = """, s AS (SELECT city, count(*) AS n, 100.0 * count(*) FILTER (website <> '') / count(*) AS spatial_readiness, 100.0 * count(*) FILTER (rating_avg_5 IS NOT NULL) / count(*) AS timeliness, 100.0 * count(*) FILTER (google_review_count >= 20) / count(*) AS reliability, count(*) - count(DISTINCT primary_cuisine || cuisine_primary) AS duplicates, count(*) FILTER (website = '') AS flags FROM listing GROUP BY city)"""


def summary(spark, sf_dir):
    share = lambda p: 100.0 * F.count_if(p) / F.count(F.lit(1))
    rows = listing(spark, sf_dir).groupBy("city")
    return rows.agg(F.count(F.lit(1)).alias("n"), share(F.col("website") != "").alias("spatial_readiness"), share(F.col("rating_avg_5").isNotNull()).alias("timeliness"), share(F.col("google_review_count") >= 20).alias("reliability"), (F.count(F.lit(1)) - F.countDistinct(F.concat("primary_cuisine", "cuisine_primary"))).alias("duplicates"), F.count_if(F.col("website") == "").alias("flags"))


@query(SQL + SUMMARY + "SELECT priority, city AS source, action FROM (" + " UNION ALL ".join(f"SELECT {p} AS priority, city, '{todo}' AS action FROM s WHERE {condition}" for p, condition, todo in profile.ACTIONS) + ")")
def dq_actions(spark, sf_dir):
    """What each source's scores call for, the most urgent first."""
    return profile.actions(summary(spark, sf_dir), "city")


@query(SQL + SUMMARY + "SELECT measure, best, round(best_value, 6) AS best_value, worst, round(worst_value, 6) AS worst_value FROM (SELECT 'n' AS measure, arg_max(city, ROW(n, city)) AS best, max(n)::DOUBLE AS best_value, arg_min(city, ROW(n, city)) AS worst, min(n)::DOUBLE AS worst_value FROM s UNION ALL SELECT 'reliability', arg_max(city, ROW(reliability, city)), max(reliability), arg_min(city, ROW(reliability, city)), min(reliability) FROM s UNION ALL SELECT 'flags', arg_min(city, ROW(flags, city)), min(flags), arg_max(city, ROW(flags, city)), max(flags) FROM s)")
def dq_extremes(spark, sf_dir):
    """The best and the weakest source by each measure."""
    out = profile.extremes(summary(spark, sf_dir), "city", {"n": "high", "reliability": "high", "flags": "low"})
    return out.select("measure", "best", r6(F.col("best_value")).alias("best_value"), "worst", r6(F.col("worst_value")).alias("worst_value"))


@query(SQL + SUMMARY + "SELECT city, flags, n AS records, round(100.0 * flags / n, 2) AS flags_per_100 FROM s")
def dq_flag_rates(spark, sf_dir):
    return profile.flag_rates(summary(spark, sf_dir).select("city", "flags", F.col("n").alias("records")), "city")


@query("""WITH e AS (SELECT user_id, event_id AS cycle, event_type <> 'error' AS ok FROM events), w AS (SELECT user_id, max(cycle) AS worked FROM e WHERE ok GROUP BY 1)
SELECT e.user_id, count(*) AS failures, max(cycle) AS last_failed_cycle, CASE WHEN count(*) >= 2 THEN max(cycle) + 100 END AS deferred_until FROM e LEFT JOIN w USING (user_id) WHERE NOT ok AND (worked IS NULL OR cycle > worked) GROUP BY 1""")
def st_deferrals(spark, sf_dir):
    """Keys that failed since they last worked, and until when they are put off."""
    attempts = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("cycle"), (F.col("event_type") != "error").alias("ok"))
    return flows.deferrals(attempts, "user_id", "cycle", "ok", 2, 100)


@query(SQL + """, g AS (SELECT platform, CASE WHEN reviews < 20 THEN 1 ELSE 0 END AS side, rating FROM long WHERE rating IS NOT NULL AND reviews IS NOT NULL)
SELECT a.platform, count(DISTINCT a.rating) AS ratings, round(sum(a.n * (b.n * CASE WHEN a.rating > b.rating THEN 1.0::DOUBLE WHEN a.rating = b.rating THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END)), 4) AS u,
  round(2 * sum(a.n * (b.n * CASE WHEN a.rating > b.rating THEN 1.0::DOUBLE WHEN a.rating = b.rating THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END)) / sum(a.n * b.n) - 1, 6) AS effect
FROM (SELECT platform, rating, count(*) AS n FROM g WHERE side = 1 GROUP BY 1, 2) a JOIN (SELECT platform, rating, count(*) AS n FROM g WHERE side = 0 GROUP BY 1, 2) b ON a.platform = b.platform GROUP BY 1""")
def q4_mann_whitney(spark, sf_dir):
    """Mann and Whitney's U of sparse against well reviewed ratings, and its rank-biserial effect size."""
    from plumbline.plans.analytics import rated_long

    rows = rated_long(spark, sf_dir).select("platform", (F.col("reviews") < 20).alias("one"), "rating")
    return assess.mann_whitney(rows, ["platform"], "one", "rating").select("platform", F.col("values_one").alias("ratings"), F.round("u", 4).alias("u"), r6(F.col("effect")).alias("effect"))
