"""Assessment of record linkage: confusion, thresholds, folds, survival and geocoding error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators.blocking import parted, spread


def rates(tp: Column, fp: Column, fn: Column, tn: Column, uncertain_pos: Column, uncertain_neg: Column) -> list[Column]:
    """Precision, recall that counts uncertain as missed, recall that keeps it, F1, accuracy, uncertain rate."""
    total = tp + fp + fn + tn + uncertain_pos + uncertain_neg
    p, r = F.try_divide(tp, tp + fp), F.try_divide(tp, tp + fn + uncertain_pos)
    r6 = lambda c: F.round(c, 6)
    return [r6(p).alias("precision"), r6(r).alias("strict_recall"), r6(F.try_divide(tp + uncertain_pos, tp + fn + uncertain_pos)).alias("kept_recall"), r6(F.try_divide(2 * p * r, p + r)).alias("f1"), r6(F.try_divide(tp + tn, total)).alias("accuracy"), r6(F.try_divide(uncertain_pos + uncertain_neg, total)).alias("uncertain_rate")]


def confusion(labelled: DataFrame, *by: str) -> DataFrame:
    """Counts and rates of (truth boolean, label), for all, for each value of each `by` and for each combination: one pass with grouping sets."""
    t, x = F.col("truth"), F.col("label")
    cells = [F.count_if(t & (x == "MATCH")).alias("tp"), F.count_if(~t & (x == "MATCH")).alias("fp"), F.count_if(t & (x == "NON_MATCH")).alias("fn"), F.count_if(~t & (x == "NON_MATCH")).alias("tn"), F.count_if(t & (x == "UNCERTAIN")).alias("up"), F.count_if(~t & (x == "UNCERTAIN")).alias("un")]
    counted = labelled.cube(*by).agg(*cells).withColumns({b: F.coalesce(F.col(b).cast("string"), F.lit("all")) for b in by})
    return counted.select(*by, "tp", "fp", "fn", "tn", "up", "un", *rates(*[F.col(c) for c in ("tp", "fp", "fn", "tn", "up", "un")]))


def threshold_grid(scored: DataFrame, step: int = 100, groups: list[str] | None = None) -> DataFrame:
    """(dmin, dmax, kept, wrong) for every pair of thresholds on a grid: a match from hi on, none up to lo, open between.

    Scores are counted per grid step first, by the step that they reach and the
    one that holds them; the crossing is over steps and thresholds, whose number
    the grid bounds, never over the labelled rows.
    """
    groups = groups or []
    steps = F.round(F.col("score") * step, 9)
    counted = scored.groupBy(*groups, F.floor(steps).cast("int").alias("s"), F.ceil(steps).cast("int").alias("c")).agg(F.count_if("truth").alias("p"), F.count_if(~F.col("truth")).alias("q"))
    cuts = scored.sparkSession.range(step + 1).select(F.col("id").cast("int").alias("lo")).select("lo", F.explode(F.sequence(F.lit(0), F.lit(step))).alias("hi")).where("lo < hi")
    above, below = F.col("s") >= F.col("hi"), F.col("c") <= F.col("lo")
    return counted.crossJoin(F.broadcast(cuts)).groupBy(*groups, "lo", "hi").agg(
        F.sum(F.when(above, F.col("p")).otherwise(0)).alias("tp"),
        F.sum(F.when(above, F.col("q")).otherwise(0)).alias("fp"),
        F.sum(F.when(below, F.col("p")).otherwise(0)).alias("fn"),
        F.sum(F.when(~above & ~below, F.col("p") + F.col("q")).otherwise(0)).alias("uncertain"),
        F.sum(F.col("p")).alias("positive"),
        F.sum(F.col("p") + F.col("q")).alias("n"),
    )


#: What thresholds should reach: the precision of matches, the true pairs kept as a match or open, and the open share.
TARGETS = {"precision": 0.90, "kept_recall": 0.97, "uncertain_rate": 0.10}


def measured(grid: DataFrame) -> DataFrame:
    """A grid with its rates and whether they meet the targets."""
    rates_ = grid.withColumns({"precision": F.try_divide("tp", F.col("tp") + F.col("fp")), "kept_recall": F.try_divide(F.col("positive") - F.col("fn"), "positive"), "uncertain_rate": F.try_divide("uncertain", "n")})
    meets = F.coalesce((F.col("precision") >= TARGETS["precision"]) & (F.col("kept_recall") >= TARGETS["kept_recall"]), F.lit(False))
    return rates_.withColumn("meets", meets)


def recommended(grid: DataFrame, groups: list[str]) -> DataFrame:
    """For each group the thresholds to work with: of those that meet the targets, with few open pairs if possible (else of all), the one that loses fewest true pairs, then the most precise, then the one with fewest open pairs."""
    m = measured(grid)
    bounded = F.col("meets") & (F.col("uncertain_rate") <= TARGETS["uncertain_rate"])
    pool = F.when(bounded, 0).when(F.col("meets"), 1).otherwise(2)
    rank = F.struct(pool.alias("pool"), F.col("fn"), (-F.coalesce("precision", F.lit(0.0))).alias("p"), F.coalesce("uncertain_rate", F.lit(1.0)).alias("u"), (-F.coalesce("kept_recall", F.lit(0.0))).alias("r"), F.col("lo"), F.col("hi"))
    kept = F.struct("lo", "hi", "precision", "kept_recall", "uncertain_rate", "fn", "n")
    return m.groupBy(*groups).agg(F.min_by(kept, rank).alias("x")).select(*groups, "x.*")


def score_counts(scored: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, score, p, q, upto, n): the labelled rows of each distinct score, and how many lie at it or below."""
    counted = scored.groupBy(*groups, "score").agg(F.count_if("truth").alias("p"), F.count_if(~F.col("truth")).alias("q"))
    each = Window.partitionBy(*groups)
    return counted.withColumn("upto", F.sum(F.col("p") + F.col("q")).over(each.orderBy("score"))).withColumn("n", F.sum(F.col("p") + F.col("q")).over(each))


def ranked(counted: DataFrame, groups: list[str], value: str, q: dict[str, float]) -> DataFrame:
    """(groups, n, worst and the nearest-rank quantiles q) of counted(groups, value, times): a running sum over distinct values, not over rows."""
    each = Window.partitionBy(*groups)
    upto = counted.withColumn("upto", F.sum("times").over(each.orderBy(value))).withColumn("n", F.sum("times").over(each))
    at = lambda x: F.min(F.when(F.col("upto") > F.bround((F.col("n") - 1) * x, 0), F.col(value)))
    return upto.groupBy(*groups).agg(F.max("n").alias("n"), *[at(x).alias(k) for k, x in q.items()], F.max(value).alias("worst"))


def score_summary(scored: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, n, least, p25, p50, p75, most): nearest-rank quantiles, from counts of distinct scores instead of gathered rows."""
    counted = score_counts(scored, groups)
    at = lambda q: F.min(F.when(F.col("upto") > F.bround((F.col("n") - 1) * q, 0), F.col("score")))
    return counted.groupBy(*groups).agg(F.max("n").alias("n"), F.min("score").alias("least"), *[at(q).alias(f"p{round(100 * q)}") for q in (0.25, 0.5, 0.75)], F.max("score").alias("most"))


#: So many lower and higher thresholds a block holds, about.
LOWER, HIGHER = 32, 1024


def suggestions(scored: DataFrame, groups: list[str], k: int = 5) -> DataFrame:
    """The k best pairs of thresholds for each group, out of the scores that occur and 0, 0.4, 0.85, 1; those that meet the targets before others.

    Each threshold carries how many rows lie below it, so a pair is judged by
    two rows of a table that has one for each distinct score of the labelled
    rows; people label hundreds of these.
    """
    marks = scored.select(*groups).distinct().select(*groups, F.explode(F.array(*[F.lit(x) for x in (0.0, 0.4, 0.85, 1.0)])).alias("score"))
    points = scored.select(*groups, "score", F.col("truth").cast("int").alias("p"), (~F.col("truth")).cast("int").alias("q")).unionByName(marks.select(*groups, "score", F.lit(0).alias("p"), F.lit(0).alias("q")))
    counted = points.groupBy(*groups, "score").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
    each, upto = Window.partitionBy(*groups), Window.partitionBy(*groups).orderBy("score")
    cuts = counted.select(*groups, "score", "p", "q", F.sum("p").over(upto).alias("pu"), F.sum("q").over(upto).alias("qu"), F.sum("p").over(each).alias("positive"), F.sum(F.col("p") + F.col("q")).over(each).alias("n"))
    lo = cuts.select(*groups, F.col("score").alias("lo"), F.col("pu").alias("fn"), F.col("qu").alias("tn"), "positive", "n")
    hi = cuts.select(*groups, F.col("score").alias("hi"), (F.col("positive") - F.col("pu") + F.col("p")).alias("tp"), (F.col("n") - F.col("positive") - F.col("qu") + F.col("q")).alias("fp"))
    # Pairs come in blocks dealt to all tasks, and each share of a group's lower thresholds keeps its own k best before any pair moves.
    low = parted(lo, groups, ["lo"], LOWER, "share").groupBy(*groups, "share").agg(F.collect_list(F.struct("lo", "fn", "tn", "positive", "n")).alias("low"))
    high = parted(hi, groups, ["hi"], HIGHER, "part").groupBy(*groups, "part").agg(F.collect_list(F.struct("hi", "tp", "fp")).alias("high"))
    blocks = spread(low.join(high.drop("part"), groups), *groups, "share")
    grid = blocks.select(*groups, "share", F.explode("low").alias("x"), "high").select(*groups, "share", "x", F.explode("high").alias("y")).where("x.lo < y.hi").select(*groups, "share", "x.*", "y.*")
    m = measured(grid.withColumn("uncertain", F.expr("n - tp - fp - fn - tn")))
    order = [F.desc("meets"), F.coalesce("uncertain_rate", F.lit(1.0)), F.desc(F.coalesce("precision", F.lit(0.0))), F.desc(F.coalesce("kept_recall", F.lit(0.0))), F.asc("lo"), F.asc("hi")]
    kept = [*groups, "lo", "hi", "precision", "kept_recall", "uncertain_rate", "meets"]
    best = m.select("share", *kept).withColumn("rank_no", F.row_number().over(Window.partitionBy(*groups, "share").orderBy(*order))).where(F.col("rank_no") <= k)
    return best.withColumn("rank_no", F.row_number().over(Window.partitionBy(*groups).orderBy(*order))).where(F.col("rank_no") <= k).select(*groups, "rank_no", *kept[len(groups) :])


def nearest_rank(values: Column, q: float) -> Column:
    """The value at round((n - 1) q), halves to the even place, of an array."""
    return F.try_element_at(F.array_sort(values), F.bround((F.size(values) - 1) * q, 0).cast("int") + 1)


def fold_summary(per_fold: DataFrame, metric: str) -> DataFrame:
    """Mean and population deviation over the folds."""
    return per_fold.agg(F.count(F.lit(1)).alias("folds"), F.round(F.avg(metric), 6).alias("mean"), F.round(F.stddev_pop(metric), 6).alias("sd"))


def mann_whitney(rows: DataFrame, groups: list[str], one: str, value: str) -> DataFrame:
    """(groups, values_one, u, effect) of the values of rows where `one` holds against the others: U by mid-ranks, and 2 U / (n1 n2) - 1.

    Values are counted first; the running sum goes over the distinct values of a group.
    """
    counted = rows.groupBy(*groups, value).agg(F.count_if(one).alias("a"), F.count_if(~F.col(one)).alias("b"))
    below = F.coalesce(F.sum("b").over(Window.partitionBy(*groups).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = counted.withColumn("below", below)
    n = F.sum("a") * F.sum("b")
    u = F.sum(F.col("a") * (F.col("below") + F.col("b") / 2))
    return ranked.groupBy(*groups).agg(F.count_if(F.col("a") > 0).alias("values_one"), u.alias("u"), (2 * F.try_divide(u, n) - 1).alias("effect"))
