"""Fitted artifacts shared by the model queries of one session and data folder."""

from __future__ import annotations

from functools import cached_property

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.operators import classify, explain, features, novelty, selection
from flowlens.operators.autoencoder import Autoencoder
from flowlens.operators.iforest import IsolationForest
from flowlens.operators.lof import LocalOutlierFactor
from flowlens.operators.pca import PcaReconstruction
from flowlens.plans import report
from flowlens.schema import BINARY_ORDER, CATEGORY_ORDER
from flowlens.session import stage
from flowlens.sources import tables

# The full-size defaults of ``Settings``, except that the 22 feature slots of the test tables
# have no 30 components.
SETTINGS = report.Settings(components=5)
TASKS = {"binary": ("binary_text", BINARY_ORDER), "multiclass": ("category", CATEGORY_ORDER)}


class Workspace:
    """Each artifact is built on first use, from the whole training split."""

    _open: dict[tuple[str, str], Workspace] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Workspace:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in cls._open:
            cls._open[key] = cls(spark, sf_dir)
        return cls._open[key]

    @cached_property
    def typed(self) -> DataFrame:
        return stage(tables.typed(self.spark, self.sf_dir), "typed", ["split"],
                     spread_by="flow_id")

    @cached_property
    def encoded(self):
        train, test = (self.typed.filter(F.col("split") == s) for s in ("train", "test"))
        # Not persisted: features are cheap to make again from the stored table, and most passes
        # need them of a few rows only, while the cached table does not fit the executors.
        return report.encode(train, novelty.mark_novel(test, train))

    @property
    def features(self):
        return self.encoded[0]

    @property
    def train(self) -> DataFrame:
        return self.encoded[1]

    @property
    def test(self) -> DataFrame:
        return self.encoded[2]

    @property
    def normal(self) -> DataFrame:
        return self.train.filter("binary_label = 0")

    @cached_property
    def names(self) -> list[str]:
        return features.clean_names(self.spark, self.features)

    @cached_property
    def training_rows(self) -> DataFrame:
        return classify.training_rows(self.train, "category", CATEGORY_ORDER)

    @cached_property
    def tree(self):
        return classify.decision_tree(self.training_rows, CATEGORY_ORDER, SETTINGS.tree_depth)

    @cached_property
    def forest(self):
        return classify.random_forest(self.training_rows, CATEGORY_ORDER, SETTINGS.forest_trees,
                                      SETTINGS.forest_depth)

    @cached_property
    def boosted(self):
        return classify.boosted_trees(self.training_rows, CATEGORY_ORDER, SETTINGS.rounds,
                                      SETTINGS.boost_depth)

    @cached_property
    def comparison(self) -> DataFrame:
        ready = {("multiclass", "Decision Tree"): self.tree,
                 ("multiclass", "Random Forest"): self.forest,
                 ("multiclass", "Boosted Trees"): self.boosted}
        return classify.compare_models(self.train, self.test, TASKS,
                                       SETTINGS.trainer_options(), ready)[0].persist()

    @cached_property
    def isolation(self):
        return IsolationForest(SETTINGS.isolation_trees).fit(self.normal)

    @cached_property
    def factor(self):
        dense = self.normal.withColumn("x", vector_to_array("features"))
        return LocalOutlierFactor(SETTINGS.neighbours, SETTINGS.neighbour_rows).fit(dense)

    @cached_property
    def components(self):
        return PcaReconstruction(SETTINGS.components).fit(self.normal)

    @cached_property
    def autoencoder(self):
        return Autoencoder().fit(self.normal)

    @cached_property
    def bundle(self):
        return report.fit_bundle(self.features, self.train, self.test, SETTINGS,
                                 self.boosted, self.isolation)

    @cached_property
    def shap(self) -> DataFrame:
        sample = selection.seeded_sample(self.test, SETTINGS.shap_rows)
        spread = sample.repartition(self.spark.sparkContext.defaultParallelism)
        return explain.shap_values(self.boosted, spread).persist()
