"""Proportional stratified interleaving into shards, by DataFrame operations only.

Within each source the rows are shuffled by a seeded hash and ranked; rank r of n becomes the
fraction (r - 1/2) / n. Sorting all rows by that fraction mixes the sources evenly, so equal
cuts of the order give shards of equal counts and of the mixture of the whole table.

Both ranks are taken in two levels, so no source and no table is ever ordered in one task: rows
are ranked inside buckets (of the hash, then of the fraction), and bucket sizes are summed up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowlens.llm.common import staged

SHARDS, SEED = 24, 17
#: Bits of the buckets: 4,096 parts of each source, and of the order of all rows.
BUCKET_BITS = 12
ROW_OVERHEAD = 8


def _ranked(rows: DataFrame, bucket: list[str], order: list[str], rank: str) -> DataFrame:
    inside = Window.partitionBy(*bucket).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(inside))


def interleave(docs: DataFrame, n_shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``doc_id, source, size, text_crc32, shard, slot`` for every row of ``docs``.

    ``size`` is the UTF-8 bytes of the text (null: none) plus 8. Shard counts differ by one at
    most, for all rows and, up to one row a cut, for each source. Null sources form a source of
    their own; repeated rows are placed one by one; an empty table gives no rows; other columns
    are left out. Equal texts are spread like any rows, since equal counts leave no other choice.
    """
    text = F.coalesce("text", F.lit(""))
    slim = docs.select(
        "doc_id", "source", (F.octet_length(text) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    shuffled = F.xxhash64(F.lit(seed), "doc_id", "source", "size", "text_crc32")
    rows = staged(slim.withColumn("_h", shuffled), "shard-rows").withColumns({
        "_s": F.coalesce(F.concat(F.lit("="), "source"), F.lit("")),
        "_b": F.shiftright("_h", 64 - BUCKET_BITS)})

    sizes = rows.groupBy("_s", "_b").agg(F.count("*").alias("_n"))
    in_source = Window.partitionBy("_s")
    sizes = sizes.select(
        "_s", "_b", F.sum("_n").over(in_source).alias("_of"),
        (F.sum("_n").over(in_source.orderBy("_b")) - F.col("_n")).alias("_before"))
    order = ["_h", "doc_id", "size"]
    ranked = _ranked(rows, ["_s", "_b"], order, "_r").join(sizes, ["_s", "_b"])
    fraction = (F.col("_before") + F.col("_r") - 0.5) / F.col("_of")
    spread = ranked.select(
        "doc_id", "source", "size", "text_crc32", "_h", "_s", fraction.alias("_f"),
        F.floor(fraction * (1 << BUCKET_BITS)).alias("_c"))

    # 4,096 rows at most, whatever the table
    cuts = spread.groupBy("_c").agg(F.count("*").alias("_n"))
    whole = Window.orderBy("_c").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cuts = cuts.select("_c", (F.sum("_n").over(whole) - F.col("_n")).alias("_before"),
                       F.sum("_n").over(Window.partitionBy()).alias("_all"))
    placed = (_ranked(spread, ["_c"], ["_f", "_h", "_s", "doc_id", "size"], "_r")
              .join(F.broadcast(cuts), "_c")
              .withColumn("_at", F.col("_before") + F.col("_r") - 1))
    shard = F.expr(f"(_at * {n_shards}) div _all")
    first = F.expr(f"(_shard * _all + {n_shards - 1}) div {n_shards}")
    return placed.withColumn("_shard", shard).select(
        "doc_id", "source", "size", "text_crc32", F.col("_shard").cast("int").alias("shard"),
        (F.col("_at") - first).alias("slot"))


def write_shards(docs: DataFrame, path: str, n_shards: int = SHARDS, seed: int = SEED) -> None:
    """Write whole rows as Parquet, a folder for each shard; ``doc_id`` must be unique here."""
    at = interleave(docs, n_shards, seed).select("doc_id", "shard", "slot")
    rows = docs.drop("shard", "slot").join(at, "doc_id")
    (rows.repartition("shard", F.expr("slot div 100000"))
         .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))
