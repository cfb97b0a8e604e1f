"""PCA reconstruction error, fitted on normal rows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _literal(values) -> F.Column:
    return F.array(*[F.lit(float(v)) for v in values])


def _square_distance(a, b):
    gaps = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(gaps, F.lit(0.0), lambda s, v: s + v)


@dataclass
class PcaModel:
    model: PCAModel
    mean: np.ndarray

    def score(self, df: DataFrame, out: str = "anomaly_score") -> DataFrame:
        """Add (|x - m|^2 - |W'(x - m)|^2) / d, the mean squared reconstruction error.

        The components are orthonormal, so no reconstruction is needed. The MLlib
        transform does not centre; W'm is subtracted from W'x instead.
        """
        centre = self.model.pc.toArray().T @ self.mean
        projected = self.model.transform(df)
        whole = _square_distance(vector_to_array("features"), _literal(self.mean))
        kept = _square_distance(vector_to_array("_projected"), _literal(centre))
        error = F.greatest((whole - kept) / len(self.mean), F.lit(0.0))
        return projected.withColumn(out, error).drop("_projected")


@dataclass
class PcaReconstruction:
    k: int = 30

    def fit(self, df: DataFrame) -> PcaModel:
        mean = df.select(Summarizer.mean(F.col("features"))).first()[0].toArray()
        pca = PCA(k=min(self.k, len(mean)), inputCol="features", outputCol="_projected")
        return PcaModel(pca.fit(df.select("features")), mean)
