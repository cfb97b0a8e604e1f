"""Joins of a large table with a lookup side of unknown size."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000


def lookup_join(facts: DataFrame, dim: DataFrame, on: list[str], how: str = "left",
                spread_by: str | None = None, max_rows: int = BROADCAST_ROWS,
                salts: int = 64) -> DataFrame:
    """Join ``facts`` to ``dim`` (narrow rows, one per key) without hot partitions.

    ``dim`` is counted first. Up to ``max_rows`` it is broadcast and ``facts`` does not
    move. Beyond that the fact rows of each key are spread over ``salts`` partitions by a
    hash of ``spread_by`` (a unique column) and ``dim`` is repeated once per salt, which
    gives the same rows for inner, left, left_semi and left_anti joins.
    """
    dim = dim.persist(StorageLevel.MEMORY_AND_DISK)
    if dim.limit(max_rows + 1).count() <= max_rows:
        return facts.join(F.broadcast(dim), on, how)
    spread = [F.col(spread_by)] if spread_by else [F.col(c) for c in facts.columns]
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)))
    copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    copies = copies.withColumn("_salt", F.col("_salt").cast("bigint"))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")
