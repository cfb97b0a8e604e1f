"""Autoencoder reconstruction error, trained by averaging over shards.

Each epoch every shard takes Adam steps on its own rows from the shared weights; Spark then
averages the shard weights by row count. Only one weight vector per shard leaves a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.operators.selection import sample_hash
from flowlens.session import stage


def layer_sizes(d: int) -> list[int]:
    return [d, 64, max(16, d // 6), 64, d]


def unpack(flat: np.ndarray, sizes: list[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    layers, at = [], 0
    for a, b in zip(sizes, sizes[1:]):
        w = flat[at:at + a * b].reshape(a, b)
        layers.append((w, flat[at + a * b:at + a * b + b]))
        at += a * b + b
    return layers


def initial_weights(sizes: list[int], seed: int) -> np.ndarray:
    """Uniform within sqrt(6 / (in + out)), biases 0."""
    rng = np.random.default_rng(seed)
    parts = []
    for a, b in zip(sizes, sizes[1:]):
        bound = np.sqrt(6 / (a + b))
        parts += [rng.uniform(-bound, bound, a * b), np.zeros(b)]
    return np.concatenate(parts)


def activations(x: np.ndarray, layers) -> list[np.ndarray]:
    out = [x]
    for i, (w, b) in enumerate(layers):
        z = out[-1] @ w + b
        out.append(z if i == len(layers) - 1 else np.maximum(z, 0))
    return out


def gradient(x: np.ndarray, flat: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Gradient of the mean squared reconstruction error, flat like the weights."""
    layers = unpack(flat, sizes)
    acts = activations(x, layers)
    delta = 2 * (acts[-1] - x) / x.size
    parts = []
    for i in reversed(range(len(layers))):
        parts += [delta.sum(axis=0), (acts[i].T @ delta).ravel()]
        if i:
            delta = (delta @ layers[i][0].T) * (acts[i] > 0)
    return np.concatenate(parts[::-1])


def adam_pass(batches: Iterator[np.ndarray], flat: np.ndarray, sizes: list[int], step: int,
              rate: float) -> tuple[np.ndarray, int]:
    first, second = np.zeros_like(flat), np.zeros_like(flat)
    flat, rows, t = flat.copy(), 0, 0
    for x in batches:
        for i in range(0, len(x), step):
            g = gradient(x[i:i + step], flat, sizes)
            t += 1
            first = 0.9 * first + 0.1 * g
            second = 0.999 * second + 0.001 * g * g
            flat -= rate * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.999 ** t)) + 1e-7)
        rows += len(x)
    return flat, rows


@dataclass
class AutoencoderModel:
    weights: np.ndarray
    sizes: list[int]
    validation: list[float] = field(default_factory=list)

    def score(self, df: DataFrame, out: str = "anomaly_score") -> DataFrame:
        """Add the mean squared reconstruction error."""
        model = df.sparkSession.sparkContext.broadcast((self.weights, self.sizes))

        @F.pandas_udf("double")
        def error(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            flat, sizes = model.value
            layers = unpack(flat, sizes)
            for batch in batches:
                if len(batch) == 0:
                    yield pd.Series([], dtype=float)
                    continue
                x = np.stack(batch.to_numpy())
                yield pd.Series(((activations(x, layers)[-1] - x) ** 2).mean(axis=1))

        return df.withColumn(out, error(vector_to_array("features")))


@dataclass
class Autoencoder:
    epochs: int = 15
    batch: int = 256
    rate: float = 0.001
    holdout: float = 0.1
    shards: int = 8  # part of the model: the weights follow it, and do not follow the cores
    seed: int = 42

    def fit(self, df: DataFrame, key: str = "flow_id") -> AutoencoderModel:
        spark = df.sparkSession
        shards = self.shards
        # Rows are dealt to shards by key hash, so a retry trains on the same rows, and the
        # order within a shard is fixed by the same hash.
        held = F.conv(F.substring("_hash", 1, 6), 16, 10).cast("int") < self.holdout * 2 ** 24
        rows = df.select(vector_to_array("features").alias("x"),
                         sample_hash(key, self.seed).alias("_hash"))
        rows = rows.select("x", "_hash", held.alias("held"))
        staged = stage(rows, "autoencoder-rows")
        train = (staged.filter("NOT held").repartition(shards, "_hash")
                       .sortWithinPartitions("_hash").select("x").persist())
        held_rows = staged.filter("held").select(array_to_vector("x").alias("features"))
        first = train.first()
        if first is None:
            raise ValueError("no training rows")
        sizes = layer_sizes(len(first.x))
        flat, step, rate = initial_weights(sizes, self.seed), self.batch, self.rate
        losses = []
        for _ in range(self.epochs):
            start = spark.sparkContext.broadcast(flat)

            def local_pass(batches):
                arrays = (np.stack(b["x"].to_numpy()) for b in batches if len(b))
                weights, n = adam_pass(arrays, start.value, sizes, step, rate)
                if n:
                    yield pd.DataFrame({"n": [float(n)], "w": [weights]})

            local = train.mapInPandas(local_pass, "n double, w array<double>")
            mean = local.select(Summarizer.metrics("mean").summary(
                array_to_vector("w"), F.col("n")).alias("s")).select("s.mean").first()
            flat = mean[0].toArray()
            start.unpersist()
            loss = AutoencoderModel(flat, sizes).score(held_rows).agg(F.avg("anomaly_score"))
            losses.append(loss.first()[0])
        train.unpersist()
        return AutoencoderModel(flat, sizes, losses)
