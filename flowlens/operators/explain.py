"""Path-dependent Shapley attributions of boosted trees.

Contributions are in the log-odds of each class. For a leaf whose path tests m distinct
features, feature i adds value * (o_i - z_i) * sum over subsets S of the other features of
|S|! (m - |S| - 1)! / m! * prod_{S} o * prod_{not S} z, where o says whether the row passes
all tests on a feature and z is the share of training weight that does. The factorials are the
integral of t^|S| (1 - t)^(m - |S| - 1), so the sum is the integral of the polynomial
prod_{j != i} (o_j t + z_j (1 - t)), which a few Gauss-Legendre points give exactly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.operators.classify import BoostedModel
from flowlens.operators.trees import LEAF, Trees

#: Stands for the features beyond the listed ones; no feature has a name in brackets.
REST = "(all others)"
#: Trees of one class that one task explains for its rows.
TREES_PER_BLOCK = 100


class Paths:
    """The leaves of one tree, by the distinct features on their paths.

    The tests of a path on one feature come down to an interval, lowest < x <= highest. Unused
    places of ``feature`` are -1, with a share of one.
    """

    def __init__(self, trees: Trees, tree: int):
        feature, cover = trees.feature[tree], trees.cover[tree]
        leaves, todo = [], [(0, {})]
        while todo:
            node, steps = todo.pop()
            f = int(feature[node])
            if f == LEAF:
                leaves.append((trees.value[tree, node], steps))
                continue
            low, high, share = steps.get(f, (-np.inf, np.inf, 1.0))
            limit = trees.threshold[tree, node]
            parts = [cover[child] / cover[node] if cover[node] else 0.0
                     for child in (2 * node + 1, 2 * node + 2)]
            todo.append((2 * node + 1, {**steps, f: (low, min(high, limit), share * parts[0])}))
            todo.append((2 * node + 2, {**steps, f: (max(low, limit), high, share * parts[1])}))
        width = max(1, max(len(steps) for _, steps in leaves))
        shape = (len(leaves), width)
        self.value = np.array([v for v, _ in leaves])
        self.feature, self.share = np.full(shape, -1), np.ones(shape)
        self.low, self.high = np.full(shape, -np.inf), np.full(shape, np.inf)
        for i, (_, steps) in enumerate(leaves):
            for j, (f, (low, high, share)) in enumerate(steps.items()):
                self.feature[i, j], self.share[i, j] = f, share
                self.low[i, j], self.high[i, j] = low, high
        points, weights = np.polynomial.legendre.leggauss((width + 1) // 2)
        self.points, self.weights = (points + 1) / 2, weights / 2

    def base(self) -> float:
        return float(self.value @ self.share.prod(axis=1))

    def gains(self, leaf: np.ndarray, passed: np.ndarray) -> np.ndarray:
        """Contribution of every place of a path, for pairs of a leaf and the tests passed."""
        share = self.share[leaf]
        total = np.zeros(passed.shape)
        for t, w in zip(self.points, self.weights):
            factor = np.where(passed, t + share * (1 - t), share * (1 - t))
            # others' product by prefixes and suffixes, as a share may be zero
            before = np.cumprod(np.insert(factor[:, :-1], 0, 1, axis=1), axis=1)
            after = np.cumprod(np.insert(factor[:, :0:-1], 0, 1, axis=1), axis=1)[:, ::-1]
            total += w * before * after
        return self.value[leaf][:, None] * (passed - share) * total

    def attributions(self, x: np.ndarray) -> np.ndarray:
        """(rows, features). Rows that pass the same tests of a leaf share their weights."""
        n, d = x.shape
        v = x[:, np.maximum(self.feature, 0)]
        passed = (v > self.low) & (v <= self.high) | (self.feature < 0)
        width = self.feature.shape[1]
        code = passed @ (1 << np.arange(width)) + (np.arange(len(self.value)) << width)
        pairs, back = np.unique(code, return_inverse=True)
        bits = (pairs[:, None] >> np.arange(width) & 1).astype(bool)
        leaf = pairs >> width
        gain = self.gains(leaf, bits)
        # places of one pair go to the slots of the row; unused places to a slot of their own
        slot = np.where(self.feature < 0, d, self.feature)[leaf]
        back = back.reshape(n, -1)
        at = (np.arange(n)[:, None, None] * (d + 1) + slot[back]).ravel()
        return np.bincount(at, gain[back].ravel(), n * (d + 1)).reshape(n, d + 1)[:, :d]


def attributions(trees: Trees, which: list[int], x: np.ndarray) -> tuple[float, np.ndarray]:
    """Base value and the (rows, features) contributions of some trees."""
    base, phi = 0.0, np.zeros(x.shape)
    for tree in which:
        paths = Paths(trees, tree)
        base += paths.base()
        phi += paths.attributions(x)
    return base, phi


def shap_values(model: BoostedModel, df: DataFrame, key: str = "flow_id") -> DataFrame:
    """``key, class_name, base_value, x, shap``: one row per flow and class.

    Every task explains some rows by one block of trees; Spark adds the blocks of a class. The
    ensemble is broadcast after its size was checked (``BoostedModel.trees``).
    """
    shared, target = model.shared, model.trees.target
    blocks = [[int(t) for t in own[at:at + TREES_PER_BLOCK]]
              for own in (np.flatnonzero(target == k) for k in np.unique(target))
              for at in range(0, len(own), TREES_PER_BLOCK)]

    def explain(batches):
        for batch in batches:
            for b, rows in batch.groupby("block"):
                x = np.stack(rows["x"].to_numpy())
                base, phi = attributions(shared.value, blocks[b], x)
                yield pd.DataFrame({key: rows[key], "class_idx": int(target[blocks[b][0]]),
                                    "base": base, "x": rows["x"], "phi": list(phi)})

    key_type = dict(df.dtypes)[key]
    cores = df.sparkSession.sparkContext.defaultParallelism
    grid = df.select(key, vector_to_array("features").alias("x"),
                     F.explode(F.sequence(F.lit(0), F.lit(len(blocks) - 1))).alias("block"))
    parts = grid.repartition(max(cores, len(blocks)), "block", F.pmod(F.hash(key), F.lit(cores))
                             ).mapInPandas(explain, f"`{key}` {key_type}, class_idx int, "
                                           "base double, x array<double>, phi array<double>")
    width = max(model.width, 1)
    names = F.array(*[F.lit(c) for c in model.classes])
    total = parts.groupBy(key, "class_idx").agg(
        F.sum("base").alias("base_value"), F.first("x").alias("x"),
        F.array(*[F.sum(F.get("phi", F.lit(i))) for i in range(width)]).alias("shap"))
    return total.select(key, F.element_at(names, F.col("class_idx") + 1).alias("class_name"),
                        "base_value", "x", "shap")


def long_form(shap: DataFrame, names: list[str], key: str = "flow_id") -> DataFrame:
    """``key, class_name, feature, value, shap``: one row per contribution."""
    cells = F.posexplode(F.arrays_zip("x", "shap")).alias("_i", "_c")
    labels = F.array(*[F.lit(n) for n in names])
    return shap.select(key, "class_name", "base_value", cells).select(
        key, "class_name", "base_value", F.element_at(labels, F.col("_i") + 1).alias("feature"),
        F.col("_c.x").alias("value"), F.col("_c.shap").alias("shap"))


def shap_importance(long: DataFrame) -> DataFrame:
    """Mean |contribution| per feature: first within each class, then over the classes."""
    per_class = long.groupBy("class_name", "feature").agg(F.avg(F.abs("shap")).alias("_m"))
    return per_class.groupBy("feature").agg(F.avg("_m").alias("mean_abs_shap"))


def shap_direction(long: DataFrame, k: int = 12, skip: str = "Normal") -> DataFrame:
    """The k strongest features per attack class and how their value moves the class.

    ``direction`` is the correlation of value and contribution, null for a constant one.
    """
    stats = (long.filter(F.col("class_name") != skip).groupBy("class_name", "feature")
                 .agg(F.avg(F.abs("shap")).alias("mean_abs_shap"),
                      F.try_divide(F.covar_pop("value", "shap"),
                                   F.stddev_pop("value") * F.stddev_pop("shap"))
                       .alias("direction")))
    # One row per feature and class is left, so the window is as small as the model.
    w = Window.partitionBy("class_name").orderBy(F.desc("mean_abs_shap"), "feature")
    return stats.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= k)


def explain_rows(model: BoostedModel, cases: DataFrame, names: list[str], k: int = 12,
                 key: str = "flow_id") -> DataFrame:
    """The k largest contributions to the predicted class of each case row, and their rest.

    The row at place k + 1 sums all others, so base value and rows add up to the margin.
    """
    long = long_form(shap_values(model, cases, key), names, key)
    own = long.join(cases.select(key, F.col("pred_class").alias("class_name")),
                    [key, "class_name"])
    w = Window.partitionBy(key).orderBy(F.desc(F.abs("shap")), "feature")
    placed = own.withColumn("place", F.least(F.row_number().over(w), F.lit(k + 1)))
    rest = F.col("place") > k
    return placed.groupBy(key, "class_name", "base_value", "place").agg(
        F.first("feature").alias("feature"), F.first("value").alias("value"),
        F.sum("shap").alias("shap")).withColumns({
            "feature": F.when(rest, F.lit(REST)).otherwise(F.col("feature")),
            "value": F.when(~rest, F.col("value"))})
