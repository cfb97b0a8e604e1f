"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores. Model queries include
fitting what they are the first to use.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from flowlens.plans.queries import QUERIES

HEADLINE = [
    "category_counts", "class_weights", "zero_day_rows", "what_if_overrides", "presets",
    "seeded_sample", "metric_summary", "confusion_norm", "class_report", "p95_threshold",
    "roc_curve", "detector_summary", "hybrid_summary", "routing_crosstab", "standard_scale",
    "feature_matrix", "scan_flows", "load_split",
    "clf_decision_tree", "clf_boosted_trees", "iforest_score", "lof_flow_score",
    "pca_reconstruction", "detector_comparison", "score_flows", "score_stream",
    "model_hybrid_summary", "shap_importance", "shap_case_rows",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("flowlens-bench")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.driver.memory", "16g")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # JVM start-up is not a query

    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir)}))
    spark.stop()


if __name__ == "__main__":
    main()
