"""Rows and attack types that the training split has never seen."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlens.operators.joins import lookup_join


def seen_types(train: DataFrame, key: str = "attack_type") -> DataFrame:
    return train.select(key).distinct()


def mark_novel(df: DataFrame, train: DataFrame, key: str = "attack_type",
               row_key: str = "flow_id") -> DataFrame:
    """Add ``is_novel``: 1 for an attack whose type does not occur in ``train``."""
    seen = seen_types(train, key).withColumn("_seen", F.lit(True))
    joined = lookup_join(df, seen, [key], "left", spread_by=row_key)
    novel = F.col("_seen").isNull() & (F.col("binary_label") == 1)
    return joined.select(*df.columns, novel.cast("int").alias("is_novel"))


def zero_day_rows(df: DataFrame, train: DataFrame, key: str = "attack_type",
                  row_key: str = "flow_id") -> DataFrame:
    attacks = df.filter("binary_label = 1")
    return lookup_join(attacks, seen_types(train, key), [key], "left_anti", spread_by=row_key)


def known_attacks(df: DataFrame, train: DataFrame, key: str = "attack_type",
                  row_key: str = "flow_id") -> DataFrame:
    attacks = df.filter("binary_label = 1")
    return lookup_join(attacks, seen_types(train, key), [key], "left_semi", spread_by=row_key)


def novel_types(df: DataFrame, train: DataFrame, key: str = "attack_type") -> DataFrame:
    """Types of ``df`` that ``train`` lacks, sorted. Both sides shrink to distinct first."""
    return seen_types(df, key).subtract(seen_types(train, key)).orderBy(key)
