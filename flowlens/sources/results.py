"""Result tables as CSV and JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_csv(df: DataFrame, path: str) -> None:
    df.write.csv(path, header=True)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per row; structs and arrays nest."""
    df.write.json(path, ignoreNullFields=False)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.csv(path, schema=schema, header=True, mode="FAILFAST")


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.json(path, schema=schema, mode="FAILFAST")


def write_tables(tables: dict[str, DataFrame], path: str) -> None:
    """Each table below ``path``: CSV where it is flat, JSON where it nests."""
    for name, df in tables.items():
        nested = any(isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
                     for f in df.schema)
        (write_json if nested else write_csv)(df, f"{path}/{name}")
