"""Isolation forest: trees grown as grouped tasks, scored over Arrow batches.

The fitted forest is a node table (a DataFrame), one row per node.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowlens.operators.selection import sample_hash, seeded_sample

NODE_SCHEMA = "tree int, node int, feature int, split double, path_length double, n_rows int"
EULER_GAMMA = 0.5772156649015329


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary search tree of n keys."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3)
    mean = 2 * (np.log(big - 1) + EULER_GAMMA) - 2 * (big - 1) / big
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, mean))


def grow_tree(x: np.ndarray, rng: np.random.Generator) -> list[tuple]:
    """Node rows of one tree: random feature, random cut, depth up to ceil(log2 n).

    The children of node i are 2i + 1 and 2i + 2.
    """
    limit = depth_limit(len(x))
    nodes, todo = [], [(0, np.arange(len(x)), 0)]
    while todo:
        node, rows, depth = todo.pop()
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or len(usable) == 0:
            nodes.append((node, -1, 0.0, depth + float(average_path(len(rows))), len(rows)))
            continue
        feature = int(rng.choice(usable))
        # Rounding may put the draw on the upper end; the right side must keep a row.
        split = min(rng.uniform(low[feature], high[feature]),
                    np.nextafter(high[feature], low[feature]))
        goes_left = x[rows, feature] <= split
        nodes.append((node, feature, float(split), 0.0, len(rows)))
        todo += [(2 * node + 1, rows[goes_left], depth + 1),
                 (2 * node + 2, rows[~goes_left], depth + 1)]
    return nodes


def depth_limit(n: int) -> int:
    return math.ceil(math.log2(max(n, 2)))


def full_tree(nodes: pd.DataFrame, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, split, path length) by node number, every branch drawn out to ``depth``.

    Below a leaf the cut is infinite, so rows keep left, where its path length is repeated.
    """
    size = 2 ** (depth + 1) - 1
    feature, split, length = np.zeros(size, np.int64), np.full(size, np.inf), np.zeros(size)
    inner, leaves = nodes[nodes["feature"] >= 0], nodes[nodes["feature"] < 0]
    feature[inner["node"]], split[inner["node"]] = inner["feature"], inner["split"]
    at, path = leaves["node"].to_numpy(), leaves["path_length"].to_numpy()
    while len(at):
        length[at] = path
        at, path = (2 * at + 1)[2 * at + 1 < size], path[2 * at + 1 < size]
    return feature, split, length


def path_lengths(x: np.ndarray, trees: list[tuple], depth: int) -> np.ndarray:
    """Mean path length of every row of ``x`` over the drawn-out trees."""
    n, d = x.shape
    cells, start = np.ascontiguousarray(x).ravel(), np.arange(n) * d
    total = np.zeros(n)
    for feature, split, length in trees:
        at = np.where(x[:, feature[0]] > split[0], 2, 1)
        for _ in range(depth - 1):
            right = cells.take(start + feature.take(at)) > split.take(at)
            at = 2 * at + 1 + right
        total += length.take(at)
    return total / len(trees)


@dataclass
class IsolationForestModel:
    nodes: DataFrame
    psi: int

    def _trees(self) -> list[tuple]:
        """Node arrays per tree; at most trees * 4 psi numbers each."""
        table = self.nodes.toPandas()
        return [full_tree(t, depth_limit(self.psi)) for _, t in table.groupby("tree")]

    def score(self, df: DataFrame, out: str = "anomaly_score",
              features: str = "features") -> DataFrame:
        """Add 2^(-E[h] / c(psi)); higher is stranger. Rows do not move."""
        forest = df.sparkSession.sparkContext.broadcast(self._trees())
        scale, depth = float(average_path(self.psi)), depth_limit(self.psi)

        @F.pandas_udf("double")
        def isolation(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            trees = forest.value
            for batch in batches:
                if len(batch) == 0:
                    yield pd.Series([], dtype=float)
                    continue
                x = np.stack(batch.to_numpy())
                yield pd.Series(np.exp2(-path_lengths(x, trees, depth) / scale))

        return df.withColumn(out, isolation(vector_to_array(features)))


@dataclass
class IsolationForest:
    """``trees`` trees on ``psi`` rows each, drawn without replacement per tree.

    A reservoir of at most trees * psi rows is sampled once. Draws and reservoir meet in an
    equi-join, so one grouped task receives the psi rows of its tree and nothing else.
    """

    trees: int = 300
    psi: int = 256
    seed: int = 42

    def fit(self, df: DataFrame, key: str = "flow_id",
            features: str = "features") -> IsolationForestModel:
        spark: SparkSession = df.sparkSession
        trees, seed = self.trees, self.seed
        pool = seeded_sample(df.select(key, features), trees * self.psi, seed, key)
        # The reservoir is bounded by trees * psi, so one window task numbers it.
        order = Window.orderBy(sample_hash(key, seed), key)
        pool = pool.select((F.row_number().over(order) - 1).cast("int").alias("idx"),
                           vector_to_array(features).alias("x")).persist()
        n = pool.count()
        psi = min(self.psi, n)

        def draw(batches):
            for batch in batches:
                for tree in batch["id"]:
                    rng = np.random.default_rng([seed, int(tree)])
                    yield pd.DataFrame({"tree": np.int32(tree),
                                        "idx": rng.choice(n, psi, replace=False).astype("int32")})

        def grow(key, rows):
            tree = int(key[0])
            x = np.stack(rows.sort_values("idx")["x"].to_numpy())
            nodes = grow_tree(x, np.random.default_rng([seed, tree, 1]))
            return pd.DataFrame([(tree, *node) for node in nodes],
                                columns=[c.split()[0] for c in NODE_SCHEMA.split(", ")])

        draws = spark.range(trees).mapInPandas(draw, "tree int, idx int")
        nodes = (draws.join(pool, "idx").groupBy("tree").applyInPandas(grow, NODE_SCHEMA)
                      .persist())
        nodes.count()
        pool.unpersist()
        return IsolationForestModel(nodes, psi)
