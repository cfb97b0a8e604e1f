"""Exact ranked metrics over score tables of any size.

Scores are first reduced to one row per (group, distinct score) with the counts a metric
needs, which collapses ties and hot scores on the map side. Running totals over those rows
are taken in one window while there are few of them, else in two levels: quantile cuts
split the scores into ranges, each range is summed and ranked on its own, and the totals
of earlier ranges are added back. Both ways give the same numbers.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowlens.operators.joins import lookup_join

SINGLE_TASK_ROWS = 250_000
RANGES_PER_SIDE = 32


def _range_index(value: Column, cuts: Column, per_side: int) -> Column:
    """Number of cuts <= value, found in two steps of ``per_side`` comparisons."""
    coarse = F.transform(F.sequence(F.lit(1), F.lit(per_side - 1)),
                         lambda i: F.element_at(cuts, i * per_side))
    block = F.size(F.filter(coarse, lambda c: c <= value))
    inside = F.slice(cuts, block * per_side + 1, F.lit(per_side))
    return block * per_side + F.size(F.filter(inside, lambda c: c <= value))


def running_totals(points: DataFrame, by: list[str], order: str, totals: list[str],
                   descending: bool = False, peek: bool = False,
                   single_task_rows: int = SINGLE_TASK_ROWS,
                   per_side: int = RANGES_PER_SIDE) -> DataFrame:
    """Add ``cum_<c>`` per total, running over ``order`` within ``by``.

    ``points`` holds one row per (by, order). ``peek`` also adds ``next_<c>``, the total of
    the following row; it is null at the end of a group.
    """
    points = points.persist(StorageLevel.DISK_ONLY)  # in memory it would crowd out the sorts
    sort_key = F.desc(order) if descending else F.asc(order)

    def cumulate(df, keys, key, columns, names, ahead=()):
        w = Window.partitionBy(*keys).orderBy(key)
        upto = w.rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(c).over(upto).alias(n) for c, n in zip(columns, names)],
                         *[F.lead(c).over(w).alias(n) for c, n in zip(columns, ahead)])

    cum, ahead = [f"cum_{c}" for c in totals], [f"next_{c}" for c in totals] if peek else []
    if points.limit(single_task_rows + 1).count() <= single_task_rows:
        return cumulate(points, by, sort_key, totals, cum, ahead)

    n = per_side * per_side
    cuts = points.groupBy(*by).agg(
        F.percentile_approx(order, [i / n for i in range(1, n)], 10 * n).alias("_cuts"))
    ranged = (lookup_join(points, cuts, by, "inner", spread_by=order, max_rows=1_000)
              .withColumn("_range", _range_index(F.col(order), F.col("_cuts"), per_side))
              .drop("_cuts").persist(StorageLevel.DISK_ONLY))  # read by the sums and by the rows
    range_key = F.desc("_range") if descending else F.asc("_range")
    first = (F.max_by if descending else F.min_by)(F.struct(*totals), order)
    sums = ranged.groupBy(*by, "_range").agg(*[F.sum(c).alias(c) for c in totals],
                                             first.alias("_first"))
    following = F.lead("_first").over(Window.partitionBy(*by).orderBy(range_key))
    before = cumulate(sums, by, range_key, totals, [f"_upto_{c}" for c in totals]).select(
        *by, "_range", following.alias("_following"),
        *[(F.col(f"_upto_{c}") - F.col(c)).alias(f"_before_{c}") for c in totals])
    local = cumulate(ranged, [*by, "_range"], sort_key, totals, cum, ahead)
    joined = lookup_join(local, before, [*by, "_range"], "inner", spread_by=order)
    # the last row of a range is followed by the first of the next range that has rows
    seen = [F.coalesce(F.col(n), F.col(f"_following.{c}")).alias(n) for n, c in zip(ahead, totals)]
    return joined.select(*points.columns, *seen, *[
        (F.col(f"cum_{c}") + F.col(f"_before_{c}")).alias(f"cum_{c}") for c in totals])


def score_counts(scored: DataFrame, by: list[str], score: str = "score",
                 label: str = "binary_label", novel: str | None = None) -> DataFrame:
    """One row per (by, score): ``pos, neg`` and, on request, ``novel`` row counts."""
    counts = [F.count_if(F.col(label) == 1).alias("pos"),
              F.count_if(F.col(label) == 0).alias("neg")]
    if novel:
        counts.append(F.count_if(F.col(novel) == 1).alias("novel"))
    return scored.groupBy(*by, F.col(score).alias("score")).agg(*counts)


def percentile_of_counts(counts: DataFrame, p: float, by: list[str], weight: str = "neg",
                         **ranges) -> DataFrame:
    """Exact percentile with linear interpolation: ``by..., threshold``.

    The value at 0-based rank r is the smallest score whose running count exceeds r, so
    both neighbours of the wanted rank come out of one aggregate.
    """
    points = counts.filter(F.col(weight) > 0).select(*by, "score", weight)
    ranked = running_totals(points, by, "score", [weight], **ranges)
    sizes = points.groupBy(*by).agg((F.sum(weight) - 1).alias("_last"))
    ranked = lookup_join(ranked, sizes, by, "inner", spread_by="score")
    low = F.floor(F.col("_last") * p)
    high = F.least(low + 1, F.col("_last"))
    upto = F.col(f"cum_{weight}")
    found = ranked.groupBy(*by).agg(
        F.min(F.when(upto > low, F.col("score"))).alias("_a"),
        F.min(F.when(upto > high, F.col("score"))).alias("_b"),
        F.first(F.col("_last") * p - low).alias("_part"))
    value = F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_part")
    return found.select(*by, value.alias("threshold"))


def threshold_percentile(scored: DataFrame, by: list[str], p: float = 0.95,
                         score: str = "score", **ranges) -> DataFrame:
    """Percentile ``p`` of the scores of normal rows, per group; one row without groups."""
    normal = scored.filter("binary_label = 0")
    keys = by or ["_all"]
    if not by:
        normal = normal.withColumn("_all", F.lit(0))
    limits = percentile_of_counts(score_counts(normal, keys, score), p, keys, **ranges)
    return limits.select(*by, "threshold")


def flag(scored: DataFrame, thresholds: DataFrame, by: list[str], score: str = "score",
         key: str = "flow_id") -> DataFrame:
    """Add ``is_anomalous`` (0/1): score >= the threshold of the row's group."""
    if by:
        joined = lookup_join(scored, thresholds, by, "inner", spread_by=key)
        limit = F.col("threshold")
    else:
        joined, limit = scored, thresholds.select("threshold").scalar()
    hit = F.col(score) >= limit
    return joined.select(*scored.columns, hit.cast("int").alias("is_anomalous"))


def _ranked(counts: DataFrame, by: list[str], **options) -> DataFrame:
    """Running positives and negatives from the highest score down, with group sizes."""
    ranked = running_totals(counts, by, "score", ["pos", "neg"], descending=True, **options)
    sizes = counts.groupBy(*by).agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    return lookup_join(ranked, sizes, by, "inner", spread_by="score")


def _fraction(a: str, b: str) -> Column:
    return F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))


def roc_points(scored: DataFrame, by: list[str], thin: bool = False, **ranges) -> DataFrame:
    """fpr and tpr at every threshold, from (0, 0); the start has no threshold.

    ``thin`` drops points followed by an equal step, which lie on a straight line; the point of
    the highest score stays.
    """
    ranked = _ranked(score_counts(scored, by), by, peek=thin, **ranges)
    if thin:
        same = F.col("next_pos").eqNullSafe(F.col("pos")) & F.col("next_neg").eqNullSafe(F.col("neg"))
        top = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
        ranked = ranked.filter(top | ~same)
    points = ranked.select(*by, F.col("score").alias("threshold"),
                           _fraction("cum_neg", "_n").alias("fpr"),
                           _fraction("cum_pos", "_p").alias("tpr"))
    start = points.select(*by).distinct().select(
        *by, F.lit(None).cast("double").alias("threshold"),
        F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(start)


def pr_points(scored: DataFrame, by: list[str], **ranges) -> DataFrame:
    """precision and recall at every threshold, ending at (recall 0, precision 1)."""
    ranked = _ranked(score_counts(scored, by), by, **ranges)
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    points = ranked.select(*by, F.col("score").alias("threshold"),
                           precision.alias("precision"),
                           _fraction("cum_pos", "_p").alias("recall"))
    end = points.select(*by).distinct().select(
        *by, F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return points.unionByName(end)


def areas(counts: DataFrame, by: list[str], **ranges) -> DataFrame:
    """``roc_auc`` (trapezoid, tie-correct) and ``average_precision`` (step sum)."""
    ranked = _ranked(counts, by, **ranges)
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    up, across = F.col("cum_pos").cast("double"), F.col("cum_neg").cast("double")
    # All terms of one sum share a denominator, so dividing afterwards is exact.
    agg = ranked.groupBy(*by).agg(
        F.sum(neg * (up - pos / 2)).alias("_area"),
        F.sum(pos * up / (up + across)).alias("_step"),
        F.first("_p").cast("double").alias("_p"), F.first("_n").cast("double").alias("_n"))
    return agg.select(*by, F.try_divide("_area", F.col("_p") * F.col("_n")).alias("roc_auc"),
                      F.try_divide("_step", "_p").alias("average_precision"))


def roc_auc(scored: DataFrame, by: list[str], **ranges) -> DataFrame:
    return areas(score_counts(scored, by), by, **ranges).select(*by, "roc_auc")


def average_precision(scored: DataFrame, by: list[str], **ranges) -> DataFrame:
    return areas(score_counts(scored, by), by, **ranges).select(*by, "average_precision")


def rates_of_counts(counts: DataFrame, thresholds: DataFrame, by: list[str]) -> DataFrame:
    joined = lookup_join(counts, thresholds, by, "inner", spread_by="score")
    hit = F.col("score") >= F.col("threshold")
    nan = F.lit(float("nan"))

    def share(c):
        return F.coalesce(F.try_divide(F.sum(F.when(hit, F.col(c)).otherwise(0)).cast("double"),
                                       F.sum(c).cast("double")), nan)

    return joined.groupBy(*by).agg(
        F.first("threshold").alias("threshold"),
        share("pos").alias("attack_detection_rate"),
        share("novel").alias("zero_day_detection_rate"),
        F.sum("novel").alias("n_zero_day"))


def detection_rates(scored: DataFrame, by: list[str], p: float = 0.95, **ranges) -> DataFrame:
    """Share of all attacks, and of zero-day attacks, at or above the normal percentile."""
    counts = score_counts(scored, by, novel="is_novel").persist(StorageLevel.DISK_ONLY)
    thresholds = percentile_of_counts(counts, p, by, **ranges)
    return rates_of_counts(counts, thresholds, by)


def detector_summary(scored: DataFrame, by: list[str], p: float = 0.95, **ranges) -> DataFrame:
    """One row per detector with areas, threshold and detection rates.

    The scored rows are read once; every number comes from the distinct-score counts.
    """
    counts = score_counts(scored, by, novel="is_novel").persist(StorageLevel.DISK_ONLY)
    thresholds = percentile_of_counts(counts, p, by, **ranges)
    return (areas(counts, by, **ranges)
            .join(rates_of_counts(counts, thresholds, by), by))
