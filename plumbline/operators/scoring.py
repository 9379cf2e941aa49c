"""Features, scores and labels of candidate pairs, chain rules, ranked groups and their adjudication."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.arrays import flags

WEIGHTS = {
    "tripadvisor": {"name_sim": 0.40, "geo_score": 0.25, "street_sim": 0.10, "phone_match": 0.15, "website_match": 0.10},
    "thefork": {"name_sim": 0.50, "geo_score": 0.35, "street_sim": 0.15},
}
MATCH, NON_MATCH, UNCERTAIN, UNBLOCKABLE = "MATCH", "NON_MATCH", "UNCERTAIN", "UNBLOCKABLE"
CHAIN_RADIUS_M = 75.0


@dataclass(frozen=True)
class Thresholds:
    """(dmin, dmax) by (source, chain), by source, then for all."""

    default: tuple[float, float] = (0.40, 0.85)
    by_source: tuple[tuple[str, float, float], ...] = ()
    by_chain: tuple[tuple[str, float, float], ...] = ()

    def __post_init__(self):
        for lo, hi in (self.default, *((lo, hi) for _, lo, hi in (*self.by_source, *self.by_chain))):
            if not 0 <= lo < hi <= 1:
                raise ValueError(f"thresholds out of order: {lo}, {hi}")

    def columns(self, source: Column, chain: Column) -> tuple[Column, Column]:
        out = []
        for k in (0, 1):
            c = F.lit(self.default[k])
            for s, *pair in self.by_source:
                c = F.when(source == s, pair[k]).otherwise(c)
            for s, *pair in self.by_chain:
                c = F.when((source == s) & chain, pair[k]).otherwise(c)
            out.append(c)
        return out[0], out[1]


def score(source: Column) -> Column:
    """The weighted sum of a source's features; missing ones count 0."""
    out = F.lit(None).cast("double")
    for name, weights in WEIGHTS.items():
        out = F.when(source == name, sum((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * w for c, w in weights.items()), F.lit(0.0))).otherwise(out)
    return out


def label(x: Column, dmin: Column, dmax: Column) -> Column:
    return F.when(x >= dmax, MATCH).when(x <= dmin, NON_MATCH).otherwise(UNCERTAIN)


def labelled(pairs: DataFrame, thresholds: Thresholds = Thresholds(), fast: bool = False) -> DataFrame:
    """Adds fast_path, score, label and chain_hardening to pairs(source, features, phone_equal, website_equal, is_chain, geo_dist_m).

    fast: equal phones, or equal websites but of chains, are a match at once. A
    chain's match without a close distance is only uncertain, unless the phones
    are equal.
    """
    chain, near = F.col("is_chain"), F.col("geo_dist_m")
    phone = F.coalesce(F.col("phone_equal"), F.lit(False))
    website = F.coalesce(F.col("website_equal"), F.lit(False))
    path = F.when(F.lit(fast) & phone, "phone").when(F.lit(fast) & website & ~chain, "website")
    dmin, dmax = thresholds.columns(F.col("source"), chain)
    scored = pairs.withColumn("fast_path", path).withColumn("score", F.when(path.isNotNull(), 1.0).otherwise(score(F.col("source"))))
    raw = F.when(F.col("fast_path").isNotNull(), MATCH).otherwise(label(F.col("score"), dmin, dmax))
    hard = chain & ~phone & F.col("fast_path").isNull() & F.col("raw_label").isin(MATCH, UNCERTAIN)
    far = near.isNull() | (near > CHAIN_RADIUS_M)
    return (
        scored.withColumn("raw_label", raw)
        .withColumn("label", F.when(hard & far, UNCERTAIN).otherwise(F.col("raw_label")))
        .withColumn("chain_hardening", flags(("chain_website_fast_path_suppressed", F.lit(fast) & chain & website), ("chain_no_geo_evidence", hard & near.isNull()), ("chain_distance_gt_auto_match_radius", hard & (near > CHAIN_RADIUS_M))))
        .drop("raw_label")
    )


def rank_order() -> list[Column]:
    """Best candidate first."""
    return [F.desc(F.coalesce("score", F.lit(-1.0))), F.asc(F.coalesce("geo_dist_m", F.lit(1e6))), F.desc(F.coalesce("name_sim", F.lit(-1.0))), F.asc("a_id")]


def least_scores(pairs: DataFrame, k: int = 5) -> DataFrame:
    """(source, s_id, least): a score that each group's k best candidates reach; null where it has candidates in fewer than k of its parts.

    Each of some parts of a group by a_id has a best score, and so k candidates
    reach the k-th of these. That combines before rows move, so that only what
    reaches it has to be ranked. Some of the pairs give a lower bound too.
    """
    parts = pairs.groupBy("source", "s_id", F.pmod(F.xxhash64("a_id"), F.lit(3 * k)).alias("part")).agg(F.max(F.coalesce("score", F.lit(-1.0))).alias("best"))
    return parts.groupBy("source", "s_id").agg(F.get(F.sort_array(F.collect_list("best"), asc=False), F.lit(k - 1)).alias("least"))


def reaching(pairs: DataFrame) -> DataFrame:
    """Those of pairs that carry their group's least score which reach it."""
    return pairs.where(F.col("least").isNull() | (F.coalesce("score", F.lit(-1.0)) >= F.col("least"))).drop("least")


def top_candidates(pairs: DataFrame, k: int = 5) -> DataFrame:
    """The k best candidates of each (source, s_id), numbered by rank_no."""
    w = Window.partitionBy("source", "s_id").orderBy(*rank_order())
    return pairs.withColumn("rank_no", F.row_number().over(w)).where(F.col("rank_no") <= k)


def decide(ranked: DataFrame) -> DataFrame:
    """A decision for each group from its two best candidates, by a ladder of rules."""
    first = lambda c: F.max(F.when(F.col("rank_no") == 1, F.col(c)))
    second = lambda c: F.max(F.when(F.col("rank_no") == 2, F.col(c)))
    g = ranked.groupBy("source", "s_id").agg(*[first(c).alias(c) for c in ("a_id", "geo_dist_m", "name_sim", "street_sim", "phone_match", "website_match", "fast_path")], second("name_sim").alias("name2"), second("geo_dist_m").alias("dist2"), F.count(F.lit(1)).alias("n_candidates"))
    d, name, street = F.coalesce("geo_dist_m", F.lit(1e6)), F.coalesce("name_sim", F.lit(0.0)), F.coalesce("street_sim", F.lit(0.0))
    contact = F.coalesce((F.col("phone_match") == 1) | (F.col("website_match") == 1), F.lit(False))
    several = F.coalesce((F.col("name2") >= 0.75) & (F.coalesce("dist2", F.lit(1e6)) <= 100) & (name >= 0.75), F.lit(False))
    near = (d <= 50) & ((name >= 0.75) | (street >= 0.80))
    said = lambda d_, c, r: F.struct(F.lit(d_).alias("d"), F.lit(c).alias("c"), F.lit(r).cast("string").alias("r"))
    out = F.when(several, said(UNCERTAIN, 0.62, "multiple_plausible_candidates")).when(contact & (d <= 1000), said(MATCH, 0.92, None)).when(near, said(MATCH, 0.90, None))
    out = out.when(d > 300, said(NON_MATCH, 0.82, "large_distance")).otherwise(said(UNCERTAIN, 0.60, "insufficient_evidence"))
    return g.withColumn("x", out).select("*", F.col("x.d").alias("decision"), F.col("x.c").alias("confidence"), F.col("x.r").alias("risk_flag")).drop("x")


SEVERE = ("chain_branch_ambiguity", "address_mismatch", "large_distance", "multiple_plausible_candidates")


def policy(decided: DataFrame, least: float = 0.85, large_m: float = 150.0, most_m: float = 300.0, override_m: float = 1000.0) -> DataFrame:
    """Takes back matches that the evidence doesn't carry: final_decision and notes."""
    match, d = F.col("decision") == MATCH, F.col("geo_dist_m")
    contact = F.coalesce((F.col("phone_match") == 1) | (F.col("website_match") == 1) | F.col("fast_path").isin("phone", "website"), F.lit(False))
    confidence = F.when(F.col("confidence") < least, "confidence").when(F.col("risk_flag").isin(*SEVERE), "severe_risk_flag")
    distance = F.when(d.isNull() & ~contact, "missing_distance").when(d > override_m, "beyond_contact_override").when((d > most_m) & ~contact, "beyond_max_distance").when((d > large_m) & ~contact, "large_distance")
    notes = F.when(match, F.array_compact(F.array(confidence, distance))).otherwise(F.array().cast("array<string>"))
    return decided.withColumn("notes", notes).withColumn("final_decision", F.when(match & (F.size("notes") > 0), UNCERTAIN).otherwise(F.col("decision")))


def apply_decisions(pairs: DataFrame, decisions: DataFrame) -> DataFrame:
    """Pairs with llm_label: of a matched group the winner MATCH and all others NON_MATCH, of a rejected one all NON_MATCH, of an open one nothing."""
    d = decisions.select("source", "s_id", F.col("a_id").alias("winner"), "final_decision")
    got = F.when(F.col("final_decision") == MATCH, F.when(F.col("a_id") == F.col("winner"), MATCH).otherwise(NON_MATCH)).when(F.col("final_decision") == NON_MATCH, NON_MATCH)
    return pairs.join(d, ["source", "s_id"], "left").withColumn("llm_label", got).drop("winner", "final_decision")


def effective_label(llm: Column, own: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(llm), F.lit("")), own)


def match_confidence(llm_label: Column, llm_confidence: Column, own: Column) -> Column:
    """The confidence of the label that counts: of an adjudication where there is one, else the score."""
    judged = (F.trim(F.coalesce(llm_label, F.lit(""))) != "") & llm_confidence.isNotNull()
    return F.when(judged, llm_confidence.cast("double")).otherwise(own)


def judged_groups(pairs: DataFrame) -> DataFrame:
    """(source, s_id) of the groups of which a pair has been adjudicated already; the records of all others have open pairs only."""
    return pairs.where(F.trim(F.coalesce("llm_label", F.lit(""))) != "").select("source", "s_id").distinct()


DECIDED = "source string, s_id long, a_id long, decision string, confidence double, risk_flag string"


def rule_client(group: dict) -> dict:
    """A stand-in for a language model: the rules of `decide`, over one group's candidates, the best first."""
    best, *rest = group["candidates"]
    far = lambda c: 1e6 if c["geo_dist_m"] is None else c["geo_dist_m"]
    some = lambda x: 0.0 if x is None else x
    name, near = some(best["name_sim"]), far(best)
    if rest and some(rest[0]["name_sim"]) >= 0.75 and far(rest[0]) <= 100 and name >= 0.75:
        return {"a_id": best["a_id"], "decision": UNCERTAIN, "confidence": 0.62, "risk_flag": "multiple_plausible_candidates"}
    if (best["phone_match"] == 1 or best["website_match"] == 1) and near <= 1000:
        return {"a_id": best["a_id"], "decision": MATCH, "confidence": 0.92, "risk_flag": None}
    if near <= 50 and (name >= 0.75 or some(best["street_sim"]) >= 0.80):
        return {"a_id": best["a_id"], "decision": MATCH, "confidence": 0.90, "risk_flag": None}
    if near > 300:
        return {"a_id": best["a_id"], "decision": NON_MATCH, "confidence": 0.82, "risk_flag": "large_distance"}
    return {"a_id": best["a_id"], "decision": UNCERTAIN, "confidence": 0.60, "risk_flag": "insufficient_evidence"}


def adjudicated(ranked: DataFrame, client: Callable[[dict], dict] = rule_client, retries: int = 2) -> DataFrame:
    """A decision for each group by a client that is called with it, in Arrow batches; a group holds at most top_candidates' k rows.

    A client that fails `retries` times more leaves its group uncertain, with
    the error as risk flag, instead of failing the job.
    """
    fields = ("a_id", "geo_dist_m", "name_sim", "street_sim", "phone_match", "website_match")
    groups = ranked.groupBy("source", "s_id").agg(F.sort_array(F.collect_list(F.struct("rank_no", *fields))).alias("candidates"))

    def ask(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out = []
            for group in batch.to_pylist():
                for attempt in range(retries + 1):
                    try:
                        said = client(group)
                        break
                    except Exception as e:  # noqa: BLE001
                        said = {"a_id": None, "decision": UNCERTAIN, "confidence": 0.0, "risk_flag": f"client_error: {type(e).__name__}"}
                out.append((group["source"], group["s_id"], said["a_id"], said["decision"], float(said["confidence"]), said["risk_flag"]))
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.string()]
            columns = list(zip(*out)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], ["source", "s_id", "a_id", "decision", "confidence", "risk_flag"])

    return groups.mapInArrow(ask, DECIDED)
