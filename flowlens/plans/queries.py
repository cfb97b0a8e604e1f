"""The registered queries: one per operator, over whole tables.

Each takes (spark, sf_dir). Floats are rounded to six places, because engines add in
different orders.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.functions import columns as C
from flowlens.operators import (boosting, classify, confusion, detect, explain, features, hybrid, labels,
                                novelty, ranking, selection)
from flowlens.operators.lof import LocalOutlierFactor
from flowlens.plans import report, wide
from flowlens.plans.workspace import SETTINGS, Workspace
from flowlens.schema import BINARY_ORDER, CATEGORY_ORDER, feature_columns, taxonomy
from flowlens.session import scratch_path
from flowlens.sources import bundle as bundles
from flowlens.sources import flows as flow_files
from flowlens.sources import results, tables
from flowlens.streaming import scoring

QUERIES = {}
BY_MODEL = ["model"]
BY_TASK = ["task", "model"]


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, *names: str, places: int = 6) -> DataFrame:
    """Round the named columns, or every double column."""
    names = names or [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(c, places) for c in names})


def train_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    everything = tables.typed(spark, sf_dir)
    return tuple(everything.filter(F.col("split") == s) for s in ("train", "test"))


def rule_limit(scored: DataFrame) -> DataFrame:
    return ranking.threshold_percentile(scored, [], 0.95, "anomaly_score")


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule scores with ``is_anomalous`` at the 95th percentile of normal rows."""
    scored = tables.scored(spark, sf_dir)
    return ranking.flag(scored, rule_limit(scored), [], "anomaly_score")


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hybrid.route(flagged(spark, sf_dir))


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.detections(tables.scored(spark, sf_dir))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.predictions(tables.scored(spark, sf_dir))


# Sources and sinks

@query
def scan_flows(spark, sf_dir):
    path = scratch_path(spark, "flows-csv")
    flow_files.write_flows(wide.flow_rows(tables.flows(spark, sf_dir)), path)
    return flow_files.read_flows(spark, path)


def _split_files(spark, sf_dir):
    paths = {}
    for split, with_difficulty in (("train", False), ("test", True)):
        paths[split] = scratch_path(spark, f"flows-{split}")
        rows = tables.flows(spark, sf_dir).filter(F.col("split") == split)
        flow_files.write_flows(wide.flow_rows(rows, with_difficulty), paths[split])
    return paths


@query
def field_count_profile(spark, sf_dir):
    parts = [flow_files.field_count_profile(spark, path).withColumn("split", F.lit(split))
             for split, path in _split_files(spark, sf_dir).items()]
    return parts[0].unionByName(parts[1])


@query
def load_split(spark, sf_dir):
    paths = _split_files(spark, sf_dir)
    return flow_files.load_split(spark, paths["train"], paths["test"]).select(
        "split", "duration", "service", "attack_type", "category", "binary_label", "difficulty")


@query
def csv_round_trip(spark, sf_dir):
    table = rounded(labels.class_weights(train_test(spark, sf_dir)[0]))
    path = scratch_path(spark, "csv")
    results.write_csv(table, path)
    return results.read_csv(spark, path, table.schema)


@query
def json_round_trip(spark, sf_dir):
    nested = class_report(spark, sf_dir).groupBy(*BY_TASK).agg(F.sort_array(F.collect_list(
        F.struct("label", "precision", "recall", "f1", "support"))).alias("per_class"))
    path = scratch_path(spark, "json")
    results.write_json(nested, path)
    back = results.read_json(spark, path, nested.schema)
    return back.select(*BY_TASK, F.inline("per_class"))


@query
def model_metadata(spark, sf_dir):
    return bundles.metadata(spark, Workspace.of(spark, sf_dir).bundle)


@query
def bundle_round_trip(spark, sf_dir):
    ws = Workspace.of(spark, sf_dir)
    path = scratch_path(spark, "bundle")
    bundles.save_bundle(spark, ws.bundle, path)
    return _score_columns(scoring.score(ws.test, bundles.load_bundle(spark, path)))


# Projections, scalars, filters

@query
def label_clean(spark, sf_dir):
    return labels.clean_label(tables.flows(spark, sf_dir)).select("flow_id", "label", "attack_type")


@query
def category_map(spark, sf_dir):
    cleaned = labels.clean_label(tables.flows(spark, sf_dir))
    return labels.map_category(cleaned, taxonomy(spark)).select(
        "flow_id", "attack_type", "category")


@query
def binary_label(spark, sf_dir):
    return tables.typed(spark, sf_dir).select("flow_id", "category", "binary_label")


@query
def binary_text(spark, sf_dir):
    return tables.typed(spark, sf_dir).select(
        "flow_id", C.binary_text(F.col("binary_label")).alias("binary_text"))


@query
def feature_projection(spark, sf_dir):
    typed = tables.typed(spark, sf_dir)
    everything, _ = feature_columns(typed.columns)
    return typed.select("flow_id", *everything)


@query
def normal_only(spark, sf_dir):
    train, _ = train_test(spark, sf_dir)
    everything, _ = feature_columns(train.columns)
    return train.filter("binary_label = 0").select("flow_id", *everything)


def _pipeline(spark, sf_dir):
    train, _ = train_test(spark, sf_dir)
    return features.feature_pipeline(train, tables.NUMERIC, tables.NOMINAL)


@query
def feature_names(spark, sf_dir):
    return features.feature_names(spark, _pipeline(spark, sf_dir))


@query
def hybrid_route(spark, sf_dir):
    return routed(spark, sf_dir).select("flow_id", "pred_class", "is_anomalous", "final_label")


@query
def routed_to(spark, sf_dir):
    return routed(spark, sf_dir).select("flow_id", "routed_to")


@query
def truth_group(spark, sf_dir):
    group = C.truth_group(F.col("is_novel"), F.col("binary_label"))
    return tables.scored(spark, sf_dir).select("flow_id", group.alias("true_group"))


@query
def triage_disposition(spark, sf_dir):
    return hybrid.triage(flagged(spark, sf_dir)).select("flow_id", "decision", "badge", "action")


def _edited(spark, sf_dir):
    typed = tables.typed(spark, sf_dir)
    # Only the fields a row changes are set; the rest stay null.
    overrides = typed.filter("binary_label = 1").select(
        "flow_id",
        F.when(F.col("cnt") > 25, "icmp").alias("protocol_type"),
        (F.col("duration") * 2).alias("duration"),
        F.when(F.col("serror_rate") > 0.04, F.lit(0.0)).alias("serror_rate"))
    return selection.apply_overrides(typed, overrides)


@query
def what_if_overrides(spark, sf_dir):
    return _edited(spark, sf_dir).select(
        "flow_id", "protocol_type", "duration", "serror_rate", "cnt")


@query
def what_if_scored(spark, sf_dir):
    return _score_columns(scoring.score(_edited(spark, sf_dir),
                                        Workspace.of(spark, sf_dir).bundle))


@query
def nan_profile(spark, sf_dir):
    typed = tables.typed(spark, sf_dir)
    return labels.null_profile(typed, feature_columns(typed.columns)[0])


# Joins and set operations

@query
def zero_day_rows(spark, sf_dir):
    train, test = train_test(spark, sf_dir)
    return novelty.zero_day_rows(test, train).select("flow_id", "attack_type", "category")


@query
def zero_day_types(spark, sf_dir):
    train, test = train_test(spark, sf_dir)
    return novelty.novel_types(test, train)


@query
def known_attack_rows(spark, sf_dir):
    train, test = train_test(spark, sf_dir)
    return novelty.known_attacks(test, train).select("flow_id", "attack_type", "category")


@query
def weighted_rows(spark, sf_dir):
    train, _ = train_test(spark, sf_dir)
    return rounded(labels.with_weights(train).select("flow_id", "category", "weight"))


# Aggregations

@query
def split_shapes(spark, sf_dir):
    return labels.split_shapes(tables.typed(spark, sf_dir))


@query
def category_counts(spark, sf_dir):
    return labels.category_counts(tables.typed(spark, sf_dir))


@query
def attack_types(spark, sf_dir):
    return labels.attack_types(tables.typed(spark, sf_dir))


@query
def class_weights(spark, sf_dir):
    return rounded(labels.class_weights(train_test(spark, sf_dir)[0]))


@query
def confusion_matrix(spark, sf_dir):
    pred = predictions(spark, sf_dir).filter("task = 'multiclass'")
    return confusion.confusion(pred, CATEGORY_ORDER, BY_TASK)


@query
def confusion_norm(spark, sf_dir):
    pred = predictions(spark, sf_dir).filter("task = 'multiclass'")
    return rounded(confusion.confusion(pred, CATEGORY_ORDER, BY_TASK, normalize=True))


@query
def accuracy(spark, sf_dir):
    return rounded(confusion.accuracy(predictions(spark, sf_dir), BY_TASK))


def _averages(spark, sf_dir, kind):
    counts = confusion.pair_counts(predictions(spark, sf_dir), BY_TASK)
    names = [f"{m}_{kind}" for m in ("precision", "recall", "f1")]
    return rounded(confusion.averages(counts, BY_TASK).select(*BY_TASK, *names))


@query
def prf_macro(spark, sf_dir):
    return _averages(spark, sf_dir, "macro")


@query
def prf_weighted(spark, sf_dir):
    return _averages(spark, sf_dir, "weighted")


@query
def class_report(spark, sf_dir):
    pred = predictions(spark, sf_dir)
    multi = confusion.class_report(pred.filter("task = 'multiclass'"), CATEGORY_ORDER, BY_TASK)
    binary = confusion.class_report(pred.filter("task = 'binary'"), BINARY_ORDER, BY_TASK)
    return rounded(multi.unionByName(binary))


@query
def metric_summary(spark, sf_dir):
    return confusion.metric_summary(predictions(spark, sf_dir), BY_TASK)


@query
def p95_threshold(spark, sf_dir):
    """Calibrated on the normal rows of the test split and, as the other choice, of train."""
    rows = tables.rule_scores(tables.typed(spark, sf_dir))
    limits = ranking.threshold_percentile(rows, ["split"], 0.95, "anomaly_score")
    return rounded(limits)


@query
def anomaly_flags(spark, sf_dir):
    return flagged(spark, sf_dir).select("flow_id", "anomaly_score", "is_anomalous")


@query
def detection_rates(spark, sf_dir):
    return rounded(ranking.detection_rates(detections(spark, sf_dir), BY_MODEL))


@query
def roc_auc(spark, sf_dir):
    return rounded(ranking.roc_auc(detections(spark, sf_dir), BY_MODEL))


@query
def average_precision(spark, sf_dir):
    return rounded(ranking.average_precision(detections(spark, sf_dir), BY_MODEL))


@query
def roc_curve(spark, sf_dir):
    return rounded(ranking.roc_points(detections(spark, sf_dir), BY_MODEL))


@query
def roc_curve_thin(spark, sf_dir):
    return rounded(ranking.roc_points(detections(spark, sf_dir), BY_MODEL, thin=True))


@query
def pr_curve(spark, sf_dir):
    return rounded(ranking.pr_points(detections(spark, sf_dir), BY_MODEL))


@query
def detector_summary(spark, sf_dir):
    return rounded(ranking.detector_summary(detections(spark, sf_dir), BY_MODEL))


@query
def hybrid_summary(spark, sf_dir):
    scored = tables.scored(spark, sf_dir)
    limit = rule_limit(scored)
    rows = hybrid.route(ranking.flag(scored, limit, [], "anomaly_score"))
    return rounded(hybrid.hybrid_summary(rows, limit.select("threshold").scalar()))


@query
def hybrid_accuracy(spark, sf_dir):
    return rounded(hybrid.hybrid_accuracy(routed(spark, sf_dir)))


@query
def routing_crosstab(spark, sf_dir):
    return rounded(hybrid.routing_crosstab(routed(spark, sf_dir)))


# Sort, top-k, sampling

def _plain_attributions(spark, sf_dir) -> DataFrame:
    """Scaled field values as stand-in attributions of two classes, in long form."""
    test = tables.typed(spark, sf_dir).filter("split = 'test'")
    cells = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in tables.NUMERIC]
    long = test.select("flow_id", F.explode(F.array(*cells)).alias("c")).select("flow_id", "c.*")
    signed = F.explode(F.array(
        F.struct(F.lit("DoS").alias("class_name"), (F.col("value") / 100).alias("shap")),
        F.struct(F.lit("Probe").alias("class_name"), (F.col("value") / -400).alias("shap"))))
    return long.withColumn("s", signed).select("flow_id", "feature", "value", "s.*")


@query
def attribution_importance(spark, sf_dir):
    return rounded(explain.shap_importance(_plain_attributions(spark, sf_dir)))


@query
def top_features(spark, sf_dir):
    importance = explain.shap_importance(_plain_attributions(spark, sf_dir))
    return rounded(selection.top_features(importance, 5))


@query
def presets(spark, sf_dir):
    rules = selection.standard_presets("promo burnished", "neptune", "guess_passwd",
                                       "snmpgetattack")
    return selection.pick_presets(tables.scored(spark, sf_dir), rules).select(
        "preset_name", "flow_id", "service", "attack_type", "category", "duration", "src_bytes",
        "binary_label")


def _case(df: DataFrame) -> DataFrame:
    return rounded(df.select("flow_id", "attack_type", "category", "pred_class", "pred_conf"))


@query
def case_best_hit(spark, sf_dir):
    return _case(selection.best_hit(tables.scored(spark, sf_dir)))


@query
def case_first_miss(spark, sf_dir):
    return _case(selection.first_miss(tables.scored(spark, sf_dir)))


@query
def case_confident_error(spark, sf_dir):
    return _case(selection.confident_error(tables.scored(spark, sf_dir)))


@query
def argmax_class(spark, sf_dir):
    votes = F.array(F.col("duration") / 50, F.col("cnt") / 50, F.col("same_srv_rate") * 10,
                    F.col("serror_rate") * 10, F.lit(0.5))
    rows = tables.typed(spark, sf_dir).withColumn("votes", votes)
    index = C.argmax_index(F.col("votes"))
    return rows.select("flow_id", index.alias("class_idx"),
                       features.class_name(index, CATEGORY_ORDER).alias("pred_class"),
                       F.round(F.array_max("votes"), 6).alias("pred_conf"))


@query
def seeded_sample(spark, sf_dir):
    normal = train_test(spark, sf_dir)[0].filter("binary_label = 0")
    return selection.seeded_sample(normal, 20_000).select("flow_id", "service", "src_bytes")


# Features

@query
def standard_scale(spark, sf_dir):
    train, _ = train_test(spark, sf_dir)
    scaled = features.scaler(train, tables.NUMERIC).transform(tables.typed(spark, sf_dir))
    return scaled.select("flow_id", "split", *[
        F.round(f"num__{c}", 6).alias(f"scaled_{c}") for c in tables.NUMERIC])


@query
def one_hot(spark, sf_dir):
    encoded = _pipeline(spark, sf_dir).transform(tables.typed(spark, sf_dir))

    def slot(c):
        place = F.array_position(vector_to_array(f"cat__{c}"), F.lit(1.0))
        return F.when(place > 0, place - 1).cast("int").alias(f"{c}_slot")

    return encoded.select("flow_id", *[slot(c) for c in tables.NOMINAL])


@query
def feature_matrix(spark, sf_dir):
    typed = tables.typed(spark, sf_dir)
    encoded = features.transform(_pipeline(spark, sf_dir), typed).select(
        "flow_id", vector_to_array("features").alias("row"))
    row = F.col("row")
    hot = F.slice(row, len(tables.NUMERIC) + 1, F.size(row))

    def total(a):
        return F.aggregate(a, F.lit(0.0), lambda x, y: x + y)

    return encoded.select("flow_id", F.size(row).alias("n_features"),
                          total(hot).cast("int").alias("n_active"),
                          F.round(total(row), 6).alias("vector_sum"))


@query
def leakage_free_transform(spark, sf_dir):
    train, _ = train_test(spark, sf_dir)
    scaled = features.scaler(train, tables.NUMERIC).transform(tables.typed(spark, sf_dir))
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"num__{c}").alias("x"))
                                for c in tables.NUMERIC]))
    # Adding 0.0 turns a rounded -0.0 into 0.0.
    return (scaled.select("split", cells.alias("c")).groupBy("split", "c.feature")
                  .agg((F.round(F.avg("c.x"), 6) + 0.0).alias("mean_scaled"),
                       F.round(F.stddev_pop("c.x"), 6).alias("std_scaled")))


@query
def label_index(spark, sf_dir):
    known = tables.typed(spark, sf_dir).filter("category <> 'Unknown'")
    index = features.class_index(F.col("category"), CATEGORY_ORDER)
    return known.select("flow_id", index.alias("class_idx"),
                        features.class_name(index, CATEGORY_ORDER).alias("decoded"))


# Classifiers

def _predicted(model, test: DataFrame) -> DataFrame:
    return classify.predict(model, test).select(
        "flow_id", "category", "pred_class", F.round("pred_conf", 6).alias("pred_conf"))


@query
def clf_decision_tree(spark, sf_dir):
    ws = Workspace.of(spark, sf_dir)
    return _predicted(ws.tree, ws.test)


@query
def clf_random_forest(spark, sf_dir):
    ws = Workspace.of(spark, sf_dir)
    return _predicted(ws.forest, ws.test)


@query
def clf_boosted_trees(spark, sf_dir):
    ws = Workspace.of(spark, sf_dir)
    return _predicted(ws.boosted, ws.test)


@query
def boost_first_round(spark, sf_dir):
    """Root split and both leaf values of every class after one round of depth one."""
    ws = Workspace.of(spark, sf_dir)
    nodes, _ = boosting.fit(ws.training_rows, len(CATEGORY_ORDER), rounds=1, depth=1)
    names = F.array(*map(F.lit, ws.names))
    side = F.col("node")
    return nodes.groupBy("class_idx").agg(
        features.class_name(F.first("class_idx"), CATEGORY_ORDER).alias("class_name"),
        F.max(F.when(side == 0, F.get(names, F.col("feature")))).alias("feature"),
        *[F.round(F.max(F.when(side == n, F.col(c))), places).alias(alias)
          for n, c, alias, places in (
              (0, "gain", "gain", 3), (1, "cover", "left_cover", 3), (2, "cover", "right_cover", 3),
              (1, "value", "left_value", 6), (2, "value", "right_value", 6))],
        F.round(F.max("loss"), 6).alias("loss")).drop("class_idx")


@query
def score_agreement(spark, sf_dir):
    """Test flows whose bit-vector scores differ from a walk through the same trees: none."""
    ws = Workspace.of(spark, sf_dir)
    return classify.walk_differences(ws.boosted, ws.test)


@query
def predict_proba(spark, sf_dir):
    ws = Workspace.of(spark, sf_dir)
    out = classify.predict(ws.boosted, ws.test)
    each = [F.round(F.col("probability")[k], 6).alias(f"p_{c.lower()}")
            for k, c in enumerate(ws.boosted.classes)]
    return out.select("flow_id", *each)


@query
def model_comparison(spark, sf_dir):
    return confusion.metric_summary(Workspace.of(spark, sf_dir).comparison, BY_TASK)


# Novelty detectors

@query
def iforest_fit(spark, sf_dir):
    return Workspace.of(spark, sf_dir).isolation.nodes


def _scores(model, test: DataFrame) -> DataFrame:
    return model.score(test).select("flow_id", "binary_label", "is_novel",
                                    F.round("anomaly_score", 6).alias("anomaly_score"))


@query
def iforest_score(spark, sf_dir):
    ws = Workspace.of(spark, sf_dir)
    return _scores(ws.isolation, ws.test)


@query
def lof_score(spark, sf_dir):
    """Vectors of the first five labels are the normal ones; every vector is scored."""
    vectors = tables.table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.col("embedding").cast(T.ArrayType(T.DoubleType())).alias("x"),
        F.col("vec_id").cast("string").alias("key"))
    model = LocalOutlierFactor().fit(vectors.filter("label < 5"), key="key")
    return model.score(vectors).select("vec_id", "label",
                                       F.round("anomaly_score", 6).alias("lof"))


@query
def lof_flow_score(spark, sf_dir):
    ws = Workspace.of(spark, sf_dir)
    return _scores(ws.factor, ws.test.withColumn("x", vector_to_array("features")))


@query
def pca_reconstruction(spark, sf_dir):
    ws = Workspace.of(spark, sf_dir)
    return _scores(ws.components, ws.test)


@query
def autoencoder_error(spark, sf_dir):
    ws = Workspace.of(spark, sf_dir)
    return _scores(ws.autoencoder, ws.test)


@query
def detector_comparison(spark, sf_dir):
    ws = Workspace.of(spark, sf_dir)
    models = {"Isolation Forest": ws.isolation, "Local Outlier Factor": ws.factor,
              "PCA Reconstruction Error": ws.components, "Autoencoder": ws.autoencoder}
    return rounded(ranking.detector_summary(detect.score_detectors(models, ws.test), BY_MODEL))


# Scoring jobs

def _score_columns(df: DataFrame) -> DataFrame:
    return df.select("flow_id", "pred_class", F.round("pred_conf", 6).alias("pred_conf"),
                     F.round("anomaly_score", 6).alias("anomaly_score"), "is_anomalous",
                     "final_label", "routed_to", "decision", "badge", "action")


@query
def score_flows(spark, sf_dir):
    return _score_columns(scoring.score(tables.flows(spark, sf_dir),
                                        Workspace.of(spark, sf_dir).bundle))


def _flow_stream(spark, sf_dir):
    lines = tables.table(spark, sf_dir, "lineitem")
    arriving = (spark.readStream.schema(lines.schema)
                     .option("pathGlobFilter", "lineitem.parquet").parquet(sf_dir))
    return tables.flows_from(arriving, *(tables.table(spark, sf_dir, t)
                                         for t in ("orders", "part")))


def _drain(spark, stream, name):
    path, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-progress")
    scoring.start_sink(stream, path, checkpoint).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


@query
def score_stream(spark, sf_dir):
    stream = scoring.score(_flow_stream(spark, sf_dir), Workspace.of(spark, sf_dir).bundle)
    return _drain(spark, _score_columns(stream), "scored-stream")


@query
def route_stream(spark, sf_dir):
    """The rule scorer on arriving flows, with the threshold of the batch test split."""
    batch = tables.scored(spark, sf_dir)
    limit = ranking.threshold_percentile(batch, [], 0.95, "anomaly_score").first().threshold
    scored = tables.rule_scores(_flow_stream(spark, sf_dir))
    judged = scored.withColumn("is_anomalous", (F.col("anomaly_score") >= limit).cast("int"))
    return _drain(spark, hybrid.route(judged).select("flow_id", "final_label", "routed_to"),
                  "routed-stream")


@query
def full_report(spark, sf_dir):
    """All result tables of the report job, one JSON row each."""
    tables_by_name = report.report(Workspace.of(spark, sf_dir).typed, SETTINGS)
    parts = [df.select(F.lit(name).alias("table"),
                       F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row"))
             for name, df in tables_by_name.items()]
    return reduce(DataFrame.unionByName, parts)


@query
def model_hybrid_summary(spark, sf_dir):
    ws = Workspace.of(spark, sf_dir)
    return rounded(hybrid.hybrid_summary(scoring.score(ws.test, ws.bundle),
                                         ws.bundle.anomaly_threshold, ws.bundle.conf_threshold))


# Explanation

@query
def shap_values(spark, sf_dir):
    ws = Workspace.of(spark, sf_dir)
    return explain.long_form(ws.shap, ws.names)


@query
def shap_importance(spark, sf_dir):
    ws = Workspace.of(spark, sf_dir)
    importance = explain.shap_importance(explain.long_form(ws.shap, ws.names))
    return rounded(selection.top_features(importance))


@query
def shap_direction(spark, sf_dir):
    ws = Workspace.of(spark, sf_dir)
    return rounded(explain.shap_direction(explain.long_form(ws.shap, ws.names)))


@query
def shap_case_rows(spark, sf_dir):
    ws = Workspace.of(spark, sf_dir)
    return rounded(report.case_rows(ws.bundle, scoring.judge(ws.test, ws.bundle), ws.names))
