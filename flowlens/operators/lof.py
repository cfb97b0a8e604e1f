"""Local outlier factor in novelty mode: fit on a bounded sample, score any table."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.operators.selection import seeded_sample
from flowlens.session import stage

#: Rows that are compared with the pool at a time, and pool rows of which only the least counts
#: in a first look.
BLOCK_ROWS, GROUP_ROWS = 128, 32
#: Candidates of a row that are compared directly, as a multiple of k.
CROWD = 8
#: Pool rows that are worth a task.
LEAST_ROWS = 512
#: Longest pool row for which single precision tells candidates well apart.
LONGEST = 100.0


class Pool:
    """Rows among which the nearest are sought.

    The k least of the least squares of groups of pool rows bound the k-th square. Every pool row
    within that bound and twice the rounding error is a candidate, and the distances of candidates
    are taken directly. Where ties make them too many, a full partition finds the k nearest.
    """

    def __init__(self, rows: np.ndarray):
        self.rows, norms = rows, (rows ** 2).sum(axis=1)
        self.longest = float(np.sqrt(norms.max(initial=0.0)))
        self.kind = np.float32 if self.longest <= LONGEST else np.float64
        # with a one behind a row, its product is the square without the row's own length
        self.turned = np.ascontiguousarray(np.vstack([-2 * rows.T, norms]), self.kind)

    def nearest(self, x: np.ndarray, k: int,
                skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Positions and distances of the k nearest pool rows, nearest first.

        ``skip`` gives the pool position of each row itself, which is left out.
        """
        places, distances = np.zeros((len(x), k), np.int64), np.zeros((len(x), k))
        for at in range(0, len(x) if k > 0 else 0, BLOCK_ROWS):
            part = slice(at, at + BLOCK_ROWS)
            places[part], distances[part] = self._block(x[part], k, None if skip is None else skip[part])
        return places, distances

    def _block(self, x: np.ndarray, k: int, skip: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        n, d = self.rows.shape
        square = np.column_stack([x, np.ones(len(x))]).astype(self.kind) @ self.turned
        if skip is not None:
            square[np.arange(len(x)), skip] = np.inf
        per = max(1, min(GROUP_ROWS, n // (4 * k)))
        groups = n // per
        least = square[:, :groups * per].reshape(len(x), per, groups).min(axis=1)
        length = np.sqrt((x ** 2).sum(axis=1))
        error = np.finfo(self.kind).eps * self.longest * ((2 * d + 6) * length + (d + 4) * self.longest)
        bound = np.partition(least, k - 1, axis=1)[:, k - 1] + 2 * error
        # rounded up, so that no candidate is lost
        bound = np.nextafter(bound.astype(self.kind), self.kind(np.inf))
        row, place = np.divmod(np.flatnonzero(square <= bound[:, None]), n)
        counts = np.bincount(row, minlength=len(x))
        most = CROWD * k
        found = np.zeros((len(x), max(k, min(most, int(counts.max())))), np.int64)
        column = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        inside = column < found.shape[1]
        found[row[inside], column[inside]] = place[inside]
        exact = np.sqrt(((x[:, None, :] - self.rows[found]) ** 2).sum(axis=2))
        exact[np.arange(found.shape[1]) >= counts[:, None]] = np.inf
        order = np.argsort(exact, axis=1, kind="stable")[:, :k]
        near, distance = np.take_along_axis(found, order, axis=1), np.take_along_axis(exact, order, axis=1)
        for i in np.flatnonzero((counts > most) | (counts < k)):  # ties, or values that are not numbers
            near[i], distance[i] = self._crowded(x[i], k, None if skip is None else skip[i])
        return near, distance

    def _crowded(self, x: np.ndarray, k: int, skip: int | None) -> tuple[np.ndarray, np.ndarray]:
        exact = ((x - self.rows) ** 2).sum(axis=1)
        if skip is not None:
            exact[skip] = np.inf
        near = np.argpartition(exact, k - 1)[:k]
        near = near[np.argsort(exact[near], kind="stable")]
        return near, np.sqrt(exact[near])


def local_density(near: np.ndarray, distance: np.ndarray, reach: np.ndarray) -> np.ndarray:
    return 1 / (np.maximum(distance, reach[near]).mean(axis=1) + 1e-10)


@dataclass
class LofModel:
    pool: object  # broadcast: sample rows, k-distance and density of each
    k: int
    offset: float = -1.5

    def score(self, df: DataFrame, out: str = "anomaly_score",
              features: str = "x") -> DataFrame:
        """Add LOF - 1.5, so that 0 is the usual cut; higher is stranger."""
        pool, k, offset = self.pool, self.k, self.offset

        @F.pandas_udf("double")
        def factor(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            rows, reach, density = pool.value
            index = Pool(rows)
            for batch in batches:
                if len(batch) == 0:
                    yield pd.Series([], dtype=float)
                    continue
                near, distance = index.nearest(np.stack(batch.to_numpy()).astype(float), k)
                own = local_density(near, distance, reach)
                yield pd.Series(density[near].mean(axis=1) / own + offset)

        return df.withColumn(out, factor(features))


@dataclass
class LocalOutlierFactor:
    """k neighbours within a seeded sample of at most ``n_max`` rows.

    The sample bounds the neighbour index and hence what is broadcast: n_max rows.
    """

    k: int = 35
    n_max: int = 20_000
    seed: int = 42
    max_bytes: int = 1 << 30

    def fit(self, df: DataFrame, key: str = "flow_id", features: str = "x") -> LofModel:
        spark = df.sparkSession
        chosen = seeded_sample(df.select(key, features), self.n_max, self.seed, key)
        one = chosen.select(features).first()
        size = 8 * self.n_max * len(one[0]) if one else 0
        if size > self.max_bytes:
            raise ValueError(f"neighbour index of up to {size} bytes; lower n_max")
        rows = np.stack(chosen.toPandas()[features].to_numpy()).astype(float)
        n, k = len(rows), min(self.k, len(rows) - 1)
        pool = spark.sparkContext.broadcast(rows)

        def neighbours(batches):
            index = Pool(pool.value)
            for batch in batches:
                if len(batch):
                    idx = batch["id"].to_numpy()
                    near, distance = index.nearest(pool.value[idx], k, skip=idx)
                    yield pd.DataFrame({"id": idx, "near": list(near),
                                        "distance": list(distance)})

        slices = max(1, min(spark.sparkContext.defaultParallelism, n // LEAST_ROWS))
        found = spark.range(0, n, 1, slices).mapInPandas(
            neighbours, "id long, near array<long>, distance array<double>")
        found = stage(found, "neighbours")
        reach = found.select(F.col("id").alias("other"), F.element_at("distance", -1).alias("reach"))
        pairs = found.select("id", F.explode(F.arrays_zip("near", "distance")).alias("n")).select(
            "id", F.col("n.near").alias("other"), "n.distance")
        density = pairs.join(reach, "other").groupBy("id").agg(
            (1 / (F.avg(F.greatest("distance", "reach")) + 1e-10)).alias("density"))
        # two numbers for each of the n_max rows
        table = density.join(reach.withColumnRenamed("other", "id"), "id").toPandas().sort_values("id")
        reach, density = table["reach"].to_numpy(), table["density"].to_numpy()
        return LofModel(spark.sparkContext.broadcast((rows, reach, density)), k)
