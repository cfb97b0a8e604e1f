"""Supervised classifiers on the assembled features, trained by MLlib."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions.columns import argmax_index
from flowlens.operators import boosting
from flowlens.operators.features import class_index, class_name
from flowlens.operators.labels import with_weights
from flowlens.operators.trees import Trees
from flowlens.session import shared_dir

MAX_BINS = 256
#: Histograms that a task of the single tree holds at once. More would not fit beside its neighbours
#: and the cached rows; the nodes of a level that do not fit are taken in another pass.
TREE_MB = 256
#: Nodes of an ensemble that may go to the driver and every task.
MAX_NODES = 4_000_000


def training_rows(df: DataFrame, label: str, classes: list[str]) -> DataFrame:
    """``flow_id, features, y, weight`` of the rows whose class is listed, balanced by class."""
    known = df.filter(F.col(label).isin(classes))
    weighted = with_weights(known.select("flow_id", label, "features"), label)
    return weighted.select("flow_id", "features", "weight",
                           class_index(F.col(label), classes).cast("double").alias("y"))


@dataclass
class ClassModel:
    """A fitted MLlib classifier with its class names, sorted as its labels are."""

    model: object
    classes: list[str]

    def probabilities(self, df: DataFrame) -> DataFrame:
        out = self.model.transform(df)
        return out.select(*df.columns, vector_to_array("probability").alias("probability"))


@dataclass
class BoostedModel:
    """Softmax ensemble as a stored node table; two classes share one tree a round.

    ``width`` is the number of feature slots.
    """

    nodes: DataFrame
    classes: list[str]
    width: int

    @cached_property
    def trees(self) -> Trees:
        """The ensemble as flat arrays on the driver; its size is checked before it is fetched."""
        n = self.nodes.count()
        if n > MAX_NODES:
            raise ValueError(f"an ensemble of {n} nodes is too large for one task")
        return boosting.to_trees(self.nodes.toPandas())

    @cached_property
    def shared(self):
        return self.nodes.sparkSession.sparkContext.broadcast(self.trees)

    def probabilities(self, df: DataFrame) -> DataFrame:
        """Row by row, in Arrow batches; ``df`` may be a stream."""
        shared, n = self.shared, len(self.classes)

        @F.pandas_udf("array<double>")
        def probability(features: pd.Series) -> pd.Series:
            if not len(features):
                return pd.Series([], dtype=object)
            p = class_probabilities(shared.value.margins(np.stack(features.to_numpy()), n))
            return pd.Series(list(p))

        return df.withColumn("probability", probability(vector_to_array("features")))


def class_probabilities(margins: np.ndarray) -> np.ndarray:
    """Softmax of the margins of all classes; with two classes the first margin is zero."""
    p = np.exp(margins - margins.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def walk_differences(model: BoostedModel, df: DataFrame, rows: int = 256) -> DataFrame:
    """``n_flows`` and how many of them the bit vectors score unlike a walk node by node."""
    shared, n = model.shared, len(model.classes)

    def compare(batches):
        trees = shared.value
        for batch in batches:
            differ = 0
            for at in range(0, len(batch), rows):
                x = np.stack(batch["x"].to_numpy()[at:at + rows])
                leaf = trees.value[np.arange(len(trees))[None, :], trees.walk(x)]
                want = np.stack([leaf[:, trees.target == k].sum(axis=1) for k in range(n)], axis=1)
                differ += int((np.abs(trees.margins(x, n) - want) > 1e-9).any(axis=1).sum())
            yield pd.DataFrame({"n": [len(batch)], "d": [differ]})

    parts = df.select(vector_to_array("features").alias("x")).mapInPandas(compare, "n long, d long")
    return parts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_flows"),
                     F.coalesce(F.sum("d"), F.lit(0)).alias("n_differ"))


def predict(model, df: DataFrame) -> DataFrame:
    """Add ``probability`` (array), ``pred_class`` and ``pred_conf``; first class wins ties."""
    out = model.probabilities(df)
    out = out.withColumn("pred_class",
                         class_name(argmax_index(F.col("probability")), model.classes))
    return out.withColumn("pred_conf", F.array_max("probability"))


def decision_tree(train: DataFrame, classes: list[str], depth: int = 15,
                  seed: int = 42) -> ClassModel:
    est = DecisionTreeClassifier(labelCol="y", weightCol="weight", maxDepth=depth,
                                 maxBins=MAX_BINS, maxMemoryInMB=TREE_MB, seed=seed)
    return ClassModel(est.fit(train), sorted(classes))


def random_forest(train: DataFrame, classes: list[str], trees: int = 200, depth: int = 20,
                  seed: int = 42) -> ClassModel:
    """Node ids travel with the rows, so that a level costs no walk from the root; they are
    checkpointed every ten levels."""
    shared_dir(train.sparkSession)
    est = RandomForestClassifier(labelCol="y", weightCol="weight", numTrees=trees,
                                 maxDepth=depth, maxBins=MAX_BINS, maxMemoryInMB=1024,
                                 featureSubsetStrategy="sqrt", cacheNodeIds=True,
                                 checkpointInterval=10, seed=seed)
    return ClassModel(est.fit(train), sorted(classes))


def boosted_trees(train: DataFrame, classes: list[str], rounds: int = 300, depth: int = 8,
                  rate: float = 0.1, tasks: int | None = None) -> BoostedModel:
    """Softmax boosting on histograms (``boosting.fit``) of ``flow_id, features, y, weight``."""
    ordered = sorted(classes)
    nodes, width = boosting.fit(train, len(ordered), rounds, depth, rate, tasks=tasks)
    return BoostedModel(nodes, ordered, width)


TRAINERS = {"Decision Tree": decision_tree, "Random Forest": random_forest,
            "Boosted Trees": boosted_trees}


def compare_models(train: DataFrame, test: DataFrame, tasks: dict[str, tuple[str, list[str]]],
                   options: dict[str, dict] | None = None,
                   ready: dict | None = None, parallelism: int = 3) -> tuple[DataFrame, dict]:
    """Fit every model on every task; return predictions in long form and the models.

    ``tasks`` maps a task to (label column, class list); ``ready`` holds models by (task,
    name) that need no fitting. Fits are independent, so a few run side by side. The test
    rows are scored by all models in one scan and unfolded to (task, model, flow_id, truth,
    guess).
    """
    options = options or {}
    fitted, cells, wide = dict(ready or {}), [], test
    rows = {task: training_rows(train, label, classes)
            for task, (label, classes) in tasks.items()}
    missing = [(task, name) for task in tasks for name in TRAINERS if (task, name) not in fitted]

    def fit(item):
        task, name = item
        return TRAINERS[name](rows[task], tasks[task][1], **options.get(name, {}))

    # Boosting needs all cores at once, so it does not share them with other fits.
    alone = [item for item in missing if TRAINERS[item[1]] is boosted_trees]
    beside = [item for item in missing if item not in alone]
    fitted.update((item, fit(item)) for item in alone)
    with ThreadPoolExecutor(parallelism) as pool:
        found = pool.map(inheritable_thread_target(train.sparkSession)(fit), beside)
        fitted.update(zip(beside, found))
    for task, (label, _) in tasks.items():
        for name in TRAINERS:
            guess = f"_guess{len(cells)}"
            wide = predict(fitted[task, name], wide).withColumnRenamed("pred_class", guess).drop(
                "probability", "pred_conf")
            cells.append(F.struct(F.lit(task).alias("task"), F.lit(name).alias("model"),
                                  F.col(label).alias("truth"), F.col(guess).alias("guess")))
    known = F.array(*[F.lit(c) for _, classes in tasks.values() for c in classes])
    long = wide.select("flow_id", F.explode(F.array(*cells)).alias("c")).select(
        "c.task", "c.model", "flow_id", "c.truth", "c.guess")
    return long.filter(F.array_contains(known, F.col("truth"))), fitted
