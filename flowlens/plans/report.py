"""Jobs over several stages: fit a bundle, and the full report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions import columns as C
from flowlens.operators import (classify, confusion, detect, explain, features, hybrid, labels,
                                novelty, ranking, selection)
from flowlens.operators.iforest import IsolationForest
from flowlens.operators.lof import LocalOutlierFactor
from flowlens.schema import (BINARY_ORDER, CATEGORY_ORDER, CONF_THRESHOLD, NOMINAL_COLUMNS,
                             UNKNOWN_CATEGORY, feature_columns)
from flowlens.sources.bundle import Bundle
from flowlens.streaming import scoring


@dataclass
class Settings:
    """Sizes of the models; the defaults are the full-size configuration."""

    rounds: int = 300
    boost_depth: int = 8
    tree_depth: int = 15
    forest_trees: int = 200
    forest_depth: int = 20
    isolation_trees: int = 300
    neighbours: int = 35
    neighbour_rows: int = 20_000
    components: int = 30
    reconstruction: str = "pca"
    shap_rows: int = 1_500
    percentile: float = 0.95
    calibrate_on: str = "test_normal"
    conf_threshold: float = CONF_THRESHOLD

    def trainer_options(self) -> dict[str, dict]:
        return {"Decision Tree": {"depth": self.tree_depth},
                "Random Forest": {"trees": self.forest_trees, "depth": self.forest_depth},
                "Boosted Trees": {"rounds": self.rounds, "depth": self.boost_depth}}


def encode(train: DataFrame, test: DataFrame, nominal: list[str] = NOMINAL_COLUMNS):
    """Feature pipeline fitted on ``train``; both frames with ``features`` attached."""
    _, numeric = feature_columns(train.columns, nominal)
    model = features.feature_pipeline(train, numeric, nominal)
    with_text = [df.withColumn("binary_text", C.binary_text(F.col("binary_label")))
                 for df in (train, test)]
    return model, *[features.transform(model, df) for df in with_text]


def operating_threshold(detector, train: DataFrame, test: DataFrame, settings: Settings) -> float:
    """Percentile of the anomaly score over the normal rows of the chosen split."""
    rows = {"test_normal": test, "train_normal": train}[settings.calibrate_on]
    normal = detector.score(rows.filter("binary_label = 0"))
    found = ranking.threshold_percentile(normal, [], settings.percentile, "anomaly_score")
    return found.first().threshold


def fit_bundle(model, train: DataFrame, test: DataFrame, settings: Settings,
               classifier=None, detector=None) -> Bundle:
    """Fit what is not given; ``train`` and ``test`` carry ``features``."""
    if classifier is None:
        rows = classify.training_rows(train, "category", CATEGORY_ORDER)
        classifier = classify.boosted_trees(rows, CATEGORY_ORDER, settings.rounds,
                                            settings.boost_depth)
    if detector is None:
        detector = IsolationForest(settings.isolation_trees).fit(train.filter("binary_label = 0"))
    threshold = operating_threshold(detector, train, test, settings)
    return Bundle(model, classifier, detector, threshold, settings.conf_threshold)


def report(everything: DataFrame, settings: Settings | None = None) -> dict[str, DataFrame]:
    """All result tables from one labelled frame with ``split`` and ``flow_id``.

    ``everything`` should be a stored table (see ``stage``). Every model is fitted once and
    shared by the tables that need it.
    """
    settings = settings or Settings()
    train, test = (everything.filter(F.col("split") == s) for s in ("train", "test"))
    model, train_x, test_x = encode(train, novelty.mark_novel(test, train))

    tasks = {"binary": ("binary_text", BINARY_ORDER), "multiclass": ("category", CATEGORY_ORDER)}
    pred, fitted = classify.compare_models(train_x, test_x, tasks, settings.trainer_options())
    pred = pred.persist()

    detectors = detect.fit_detectors(
        train_x.filter("binary_label = 0"), settings.components, settings.reconstruction,
        IsolationForest(settings.isolation_trees),
        LocalOutlierFactor(settings.neighbours, settings.neighbour_rows))
    scores = detect.score_detectors(detectors, test_x).persist()

    bundle = fit_bundle(model, train_x, test_x, settings,
                        fitted["multiclass", "Boosted Trees"], detectors["Isolation Forest"])
    routed = scoring.judge(test_x, bundle).persist()

    names = features.clean_names(everything.sparkSession, model)
    sample = selection.seeded_sample(test_x, settings.shap_rows)
    spread = sample.repartition(everything.sparkSession.sparkContext.defaultParallelism)
    shap = explain.long_form(explain.shap_values(bundle.classifier, spread), names).persist()
    by = ["task", "model"]
    return {
        "split_shapes": labels.split_shapes(everything),
        "category_counts": labels.category_counts(everything),
        "zero_day_types": novelty.novel_types(test, train),
        "classification_summary": confusion.metric_summary(pred, by),
        "class_report_binary": confusion.class_report(
            pred.filter("task = 'binary'"), BINARY_ORDER, by),
        "class_report_multiclass": confusion.class_report(
            pred.filter("task = 'multiclass'"), CATEGORY_ORDER, by),
        "confusion_binary": confusion.confusion(
            pred.filter("task = 'binary'"), BINARY_ORDER, by, normalize=True),
        "confusion_multiclass": confusion.confusion(
            pred.filter("task = 'multiclass'"), CATEGORY_ORDER, by, normalize=True),
        "roc_points": ranking.roc_points(scores, ["model"], thin=True),
        "pr_points": ranking.pr_points(scores, ["model"]),
        "rows_without_class": everything.groupBy("split").agg(
            F.count_if(F.col("category") == UNKNOWN_CATEGORY).alias("n_left_out"),
            F.count("*").alias("n_rows")),
        "anomaly_summary": ranking.detector_summary(scores, ["model"]),
        "hybrid_summary": hybrid.hybrid_summary(
            routed, bundle.anomaly_threshold, bundle.conf_threshold),
        "hybrid_routing_breakdown": hybrid.routing_crosstab(routed),
        "shap_top_features": selection.top_features(explain.shap_importance(shap)),
        "shap_direction": explain.shap_direction(shap),
        "shap_case_studies": case_rows(bundle, routed, names),
    }


def cases(pred: DataFrame) -> DataFrame:
    """Up to three study rows: a caught attack, a missed one, a misleading zero-day one."""
    # Case titles.
    picks = {"Case A - Correctly Caught DoS": selection.best_hit(pred),
             "Case B - Missed R2L Attack": selection.first_miss(pred),
             "Case C - True Zero-Day Attack": selection.confident_error(pred)}
    parts = [rows.withColumn("case", F.lit(name)) for name, rows in picks.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def case_rows(bundle: Bundle, routed: DataFrame, names: list[str], k: int = 12) -> DataFrame:
    """Contributions behind the prediction of each study row."""
    # Three rows at most; stored so that the picks are made once.
    studied = cases(routed).persist()
    rows = explain.explain_rows(bundle.classifier, studied.dropDuplicates(["flow_id"]), names, k)
    about = studied.select("flow_id", "case", "category", "attack_type", "pred_class", "pred_conf")
    return rows.join(about, "flow_id").select(
        "case", "flow_id", "category", "attack_type", "pred_class", "pred_conf", "base_value",
        "place", "feature", "value", "shap")
