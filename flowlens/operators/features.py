"""Feature pipeline: population scaling and one-hot, fitted on training rows only."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (OneHotEncoder, SQLTransformer, StringIndexer,
                                StringIndexerModel, VectorAssembler)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.functions.columns import clean_feature_name

MAX_CATEGORIES = 100_000


def train_stats(train: DataFrame, numeric: list[str], nominal: list[str] = ()):
    """One pass over ``train``: (mean, population deviation) of each numeric column and the
    approximate number of values of each nominal one. A constant column scales by 1."""
    aggs = [f(c).alias(f"{c}__{n}") for c in numeric
            for n, f in (("mean", F.avg), ("std", F.stddev_pop))]
    aggs += [F.approx_count_distinct(c).alias(f"{c}__size") for c in nominal]
    row = train.agg(*aggs).first()
    return ({c: (row[f"{c}__mean"], row[f"{c}__std"] or 1.0) for c in numeric},
            {c: row[f"{c}__size"] for c in nominal})


def _scaling_statement(stats: dict[str, tuple[float, float]]) -> str:
    scaled = ", ".join(
        f"(CAST(`{c}` AS DOUBLE) - CAST('{mean!r}' AS DOUBLE)) / CAST('{std!r}' AS DOUBLE) "
        f"AS `num__{c}`" for c, (mean, std) in stats.items())
    return f"SELECT *, {scaled} FROM __THIS__"


def scaler(train: DataFrame, numeric: list[str]) -> SQLTransformer:
    """(x - mean) / std as plain SQL, so it saves with the pipeline and streams."""
    return SQLTransformer(statement=_scaling_statement(train_stats(train, numeric)[0]))


def feature_pipeline(train: DataFrame, numeric: list[str], nominal: list[str],
                     max_categories: int = MAX_CATEGORIES) -> PipelineModel:
    """Scaled numerics first, then one-hot blocks in sorted category order.

    Categories missing from ``train`` encode as all zeros. The category lists live on the
    driver, so their number is checked before they are fetched.
    """
    stats, sizes = train_stats(train, numeric, nominal)
    if max(sizes.values()) > max_categories:
        raise ValueError(f"too many categories to one-hot encode: {sizes}")
    index_cols = [f"idx__{c}" for c in nominal]
    hot_cols = [f"cat__{c}" for c in nominal]
    indexer = StringIndexer(inputCols=nominal, outputCols=index_cols, handleInvalid="keep",
                            stringOrderType="alphabetAsc").fit(train.select(*nominal))
    encoder = OneHotEncoder(inputCols=index_cols, outputCols=hot_cols, dropLast=True,
                            handleInvalid="error").fit(indexer.transform(train.limit(0)))
    assembler = VectorAssembler(inputCols=[f"num__{c}" for c in numeric] + hot_cols,
                                outputCol="features", handleInvalid="error")
    scaling = SQLTransformer(statement=_scaling_statement(stats))
    return PipelineModel([scaling, indexer, encoder, assembler])


def transform(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` plus ``features``; helper columns are dropped."""
    return model.transform(df).select(*df.columns, "features")


def _indexer(model: PipelineModel) -> StringIndexerModel:
    return next(s for s in model.stages if isinstance(s, StringIndexerModel))


def raw_feature_names(model: PipelineModel) -> list[str]:
    indexer, assembler = _indexer(model), model.stages[-1]
    names = [c for c in assembler.getInputCols() if c.startswith("num__")]
    for c, labels in zip(indexer.getInputCols(), indexer.labelsArray):
        names += [f"cat__{c}_{value}" for value in labels]
    return names


def feature_names(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """``feature_idx, raw, clean`` for every slot of the feature vector."""
    raw = spark.createDataFrame(list(enumerate(raw_feature_names(model))),
                                "feature_idx int, raw string")
    nominal = _indexer(model).getInputCols()
    return raw.withColumn("clean", clean_feature_name(F.col("raw"), nominal))


def clean_names(spark: SparkSession, model: PipelineModel) -> list[str]:
    rows = feature_names(spark, model).orderBy("feature_idx").collect()
    return [r.clean for r in rows]


def class_index(category: Column, classes: list[str]) -> Column:
    """Position in the sorted class list; a class outside it fails the job."""
    ordered = F.array(*[F.lit(c) for c in sorted(classes)])
    place = F.array_position(ordered, category)
    error = F.raise_error(F.concat(F.lit("class not in the label list: "), category))
    return F.when(place > 0, place - 1).otherwise(error).cast("int")


def class_name(index: Column, classes: list[str]) -> Column:
    ordered = F.array(*[F.lit(c) for c in sorted(classes)])
    return F.element_at(ordered, (index + 1).cast("int"))
