"""Routing of scored flows and the tables that judge it.

Input columns: ``pred_class, pred_conf, is_anomalous, category, binary_label, is_novel``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.functions import columns as C
from flowlens.schema import CONF_THRESHOLD, SUSPECT_LABEL

# Output labels.
ROUTES = ["Known Attack Class", "Normal", SUSPECT_LABEL]
GROUPS = ["Normal", "Known Attack", "True Zero-Day Attack"]


def route(scored: DataFrame, conf_threshold: float = CONF_THRESHOLD) -> DataFrame:
    """Add ``final_label`` and its three-way form ``routed_to``."""
    final = C.final_label(F.col("pred_class"), F.col("pred_conf"), F.col("is_anomalous") == 1,
                          conf_threshold)
    return (scored.withColumn("final_label", final)
                  .withColumn("routed_to", C.routed_to(F.col("final_label"))))


def triage(scored: DataFrame, conf_threshold: float = CONF_THRESHOLD) -> DataFrame:
    record = C.triage(F.col("pred_class"), F.col("pred_conf"), F.col("is_anomalous") == 1,
                      conf_threshold)
    return scored.withColumn("_t", record).select(*scored.columns, "_t.*")


def _correct():
    expected = F.when(F.col("is_novel") == 1, F.lit(SUSPECT_LABEL)).otherwise(F.col("category"))
    return (F.col("final_label") == expected).cast("double")


def hybrid_accuracy(routed: DataFrame) -> DataFrame:
    """The suspect label is right for zero-day rows only."""
    return routed.agg(F.avg(_correct()).alias("hybrid_accuracy"))


def hybrid_summary(routed: DataFrame, anomaly_threshold: Column | float,
                   conf_threshold: float = CONF_THRESHOLD) -> DataFrame:
    """Routing rates, accuracy, subset sizes and the two thresholds, in one aggregate."""
    suspect = F.col("final_label") == SUSPECT_LABEL
    novel = F.col("is_novel") == 1
    known = (F.col("binary_label") == 1) & ~novel
    normal = F.col("binary_label") == 0
    return routed.agg(
        C.rate(suspect, novel).alias("zero_day_to_unknown"),
        C.rate(suspect, known).alias("known_to_unknown"),
        C.rate(F.col("final_label") != "Normal", normal).alias("normal_false_alarm"),
        F.avg(_correct()).alias("hybrid_accuracy"),
        F.count_if(novel).alias("n_zero_day"),
        F.count_if(known).alias("n_known"),
        F.count_if(normal).alias("n_normal")).select(
        "*", F.lit(conf_threshold).alias("conf_threshold"),
        (anomaly_threshold if isinstance(anomaly_threshold, Column)
         else F.lit(float(anomaly_threshold))).alias("anomaly_threshold"))


def routing_crosstab(routed: DataFrame) -> DataFrame:
    """Share of each route within each truth group: three rows in a fixed order.

    A group without rows keeps its row, with null shares.
    """
    group = C.truth_group(F.col("is_novel"), F.col("binary_label")).alias("true_group")
    counts = (routed.groupBy(group).pivot("routed_to", ROUTES).agg(F.count(F.lit(1)))
                    .na.fill(0, ROUTES))
    size = sum((F.col(f"`{r}`") for r in ROUTES[1:]), F.col(f"`{ROUTES[0]}`"))
    groups = routed.sparkSession.range(len(GROUPS)).select(
        (F.col("id") + 1).cast("int").alias("row_order"),
        F.element_at(F.array(*map(F.lit, GROUPS)), F.col("id").cast("int") + 1).alias("true_group"))
    names = ["known_attack_class", "normal", "unknown"]
    return groups.join(counts, "true_group", "left").select(
        "row_order", "true_group",
        *[(F.col(f"`{r}`") / size).alias(n) for r, n in zip(ROUTES, names)]).orderBy("row_order")
