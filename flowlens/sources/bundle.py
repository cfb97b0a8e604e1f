"""Fitted artifacts as one folder: features, classifier, detector, operating metadata."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from flowlens.operators import boosting, features
from flowlens.operators.classify import BoostedModel
from flowlens.operators.iforest import NODE_SCHEMA, IsolationForestModel
from flowlens.schema import CATEGORY_ORDER, CONF_THRESHOLD

METADATA_SCHEMA = ("conf_threshold double, anomaly_threshold double, category_order array<string>, "
                   "classes array<string>, n_slots int, psi int, "
                   "feature_names_raw array<string>, clean_feature_names array<string>")


@dataclass
class Bundle:
    features: PipelineModel
    classifier: BoostedModel
    detector: IsolationForestModel
    anomaly_threshold: float
    conf_threshold: float = CONF_THRESHOLD


def metadata(spark: SparkSession, bundle: Bundle) -> DataFrame:
    """Thresholds, class order and feature names as one row."""
    row = (bundle.conf_threshold, bundle.anomaly_threshold, CATEGORY_ORDER,
           bundle.classifier.classes, bundle.classifier.width, bundle.detector.psi,
           features.raw_feature_names(bundle.features),
           features.clean_names(spark, bundle.features))
    return spark.createDataFrame([row], METADATA_SCHEMA)


def save_bundle(spark: SparkSession, bundle: Bundle, path: str) -> None:
    bundle.features.write().save(f"{path}/features")
    bundle.classifier.nodes.write.parquet(f"{path}/classifier")
    bundle.detector.nodes.write.parquet(f"{path}/detector")
    metadata(spark, bundle).write.json(f"{path}/metadata")


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    meta = spark.read.json(f"{path}/metadata", schema=METADATA_SCHEMA).first()
    trees = spark.read.schema(boosting.NODE_SCHEMA).parquet(f"{path}/classifier")
    nodes = spark.read.schema(NODE_SCHEMA).parquet(f"{path}/detector")
    return Bundle(PipelineModel.load(f"{path}/features"),
                  BoostedModel(trees, list(meta.classes), meta.n_slots),
                  IsolationForestModel(nodes, meta.psi),
                  meta.anomaly_threshold, meta.conf_threshold)
