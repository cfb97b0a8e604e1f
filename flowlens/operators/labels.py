"""Label cleaning, class mapping and data-set summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.functions import columns as C
from flowlens.operators.joins import lookup_join
from flowlens.schema import UNKNOWN_CATEGORY


def clean_label(df: DataFrame, col: str = "label", out: str = "attack_type") -> DataFrame:
    return df.withColumn(out, C.clean_label(F.col(col)))


def map_category(df: DataFrame, taxonomy: DataFrame, key: str = "attack_type",
                 default: str = UNKNOWN_CATEGORY) -> DataFrame:
    """Attach ``category``; Spark broadcasts the taxonomy if its statistics say it is small."""
    dim = taxonomy.select(F.col("attack_type").alias(key), "category")
    return df.join(dim, key, "left").withColumn(
        "category", F.coalesce("category", F.lit(default)))


def derive_labels(df: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """attack_type, category and binary_label in one projection chain."""
    mapped = map_category(clean_label(df), taxonomy)
    return mapped.select(*df.columns, "attack_type", "category",
                         C.binary_label(F.col("category")).alias("binary_label"))


def split_shapes(df: DataFrame) -> DataFrame:
    return (df.groupBy("split").agg(F.count("*").alias("n_rows"))
              .withColumn("n_columns", F.lit(len(df.columns)).cast("long")))


def category_counts(df: DataFrame) -> DataFrame:
    return (df.groupBy("split", "category").agg(F.count("*").alias("n"))
              .orderBy("split", F.desc("n"), "category"))


def attack_types(df: DataFrame) -> DataFrame:
    return df.select("split", "attack_type").distinct()


def null_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows that are null or NaN, one result row per column, in one pass."""
    def bad(c):
        kind = dict(df.dtypes)[c]
        missing = F.col(c).isNull()
        return missing | F.isnan(c) if kind in ("double", "float") else missing

    wide = df.agg(*[F.count_if(bad(c)).alias(c) for c in cols])
    return wide.unpivot([], cols, "feature", "n_missing")


def class_weights(df: DataFrame, label: str = "category") -> DataFrame:
    """Balanced weight n / (k * n_c) over the k classes that occur.

    One partial aggregate, cached; the totals then run over one row per class.
    """
    counts = df.groupBy(label).agg(F.count("*").alias("n")).persist()
    totals = counts.agg(F.struct(F.sum("n").alias("n"), F.count("*").alias("k"))).scalar()
    return counts.select(label, "n", (totals["n"] / (totals["k"] * F.col("n"))).alias("weight"))


def with_weights(df: DataFrame, label: str = "category", key: str = "flow_id") -> DataFrame:
    weights = class_weights(df, label).select(label, "weight")
    return lookup_join(df, weights, [label], "inner", spread_by=key)
