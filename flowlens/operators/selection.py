"""Sampling, argmax rows, presets and what-if edits. All picks order by a unique key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def sample_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(key), F.lit(f":{seed}")))


def seeded_sample(df: DataFrame, n: int, seed: int = 42, key: str = "flow_id") -> DataFrame:
    """Exactly min(n, rows) rows without replacement, the same under any partitioning.

    The sample is the n smallest hashes. Counts per 4-digit hash prefix find the prefix
    where the n-th one falls, so that only about n rows reach the final sort.
    """
    hashed = df.withColumn("_hash", sample_hash(key, seed))
    prefix = F.substring("_hash", 1, 4)
    counts = (df.select(key).withColumn("_hash", sample_hash(key, seed))
                .groupBy(prefix.alias("_prefix")).agg(F.count("*").alias("_n")))
    # At most 65,536 prefixes, so one window task holds them.
    upto = F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_prefix"))
    cut = (counts.withColumn("_upto", upto)
                 .agg(F.coalesce(F.min(F.when(F.col("_upto") >= n, F.col("_prefix"))),
                                 F.lit("ffff"))).scalar())
    return (hashed.filter(prefix <= cut).orderBy("_hash", key).limit(n).drop("_hash"))


def pick_case(df: DataFrame, predicate: Column, order: list[Column]) -> DataFrame:
    """The first row that meets ``predicate``; at most one row per task reaches the merge."""
    return df.filter(predicate).orderBy(*order).limit(1)


def best_hit(pred: DataFrame, category: str = "DoS", key: str = "flow_id") -> DataFrame:
    right = (F.col("category") == category) & (F.col("pred_class") == category)
    return pick_case(pred, right, [F.desc("pred_conf"), F.asc(key)])


def first_miss(pred: DataFrame, category: str = "R2L", key: str = "flow_id") -> DataFrame:
    missed = (F.col("category") == category) & (F.col("pred_class") != category)
    return pick_case(pred, missed, [F.asc(key)])


def confident_error(pred: DataFrame, key: str = "flow_id") -> DataFrame:
    """Most confident wrong zero-day row, else the least confident right one."""
    wrong = F.col("pred_class") != F.col("category")
    strength = F.when(wrong, -F.col("pred_conf")).otherwise(F.col("pred_conf"))
    return pick_case(pred, F.col("is_novel") == 1, [F.desc(wrong), strength.asc(), F.asc(key)])


def pick_presets(df: DataFrame, rules: list[tuple[str, list[Column], str | None]],
                 key: str = "flow_id") -> DataFrame:
    """One row per preset: the first row, by ``key``, of its first predicate with a match.

    ``rules`` holds (name, predicates in order of preference, column whose value is added
    to the name in brackets). Each preset is a minimum over structs, so tasks send one
    candidate each and no preset's rows gather anywhere.
    """
    columns = df.columns
    rest = [c for c in columns if c != key]

    def candidate(predicates):
        rank = F.lit(None).cast("int")
        for i, p in reversed(list(enumerate(predicates))):
            rank = F.when(p, i).otherwise(rank)
        return F.min(F.when(rank.isNotNull(), F.struct(rank.alias("_rank"), key, *rest)))

    wide = df.agg(*[candidate(p).alias(f"p{i}") for i, (_, p, _) in enumerate(rules)])
    entries = []
    for i, (name, _, suffix) in enumerate(rules):
        title = F.lit(name) if suffix is None else F.concat(
            F.lit(f"{name} ("), F.col(f"p{i}.{suffix}"), F.lit(")"))
        entries.append(F.struct(title.alias("preset_name"), F.col(f"p{i}").alias("row")))
    long = wide.select(F.explode(F.array(*entries)).alias("e")).filter("e.row IS NOT NULL")
    return long.select("e.preset_name", *[F.col(f"e.row.{c}").alias(c) for c in columns])


def standard_presets(service: str, dos: str, r2l: str, zero_day: str) -> list:
    """The six preset rules; ``df`` needs ``is_novel``."""
    novel = F.col("is_novel") == 1
    normal = F.col("category") == "Normal"
    # The titles are the keys of the records.
    return [
        ("Normal - HTTP Web Traffic", [normal & (F.col("service") == service), normal], None),
        ("DoS - Neptune SYN Flood", [F.col("attack_type") == dos], None),
        ("Probe - Port Scan", [F.col("category") == "Probe"], "attack_type"),
        ("R2L - Guess Password Attack", [F.col("attack_type") == r2l], None),
        ("U2R - Privilege Escalation", [F.col("category") == "U2R"], "attack_type"),
        ("True Zero-Day - Unseen Attack",
         [novel & (F.col("attack_type") == zero_day), novel], "attack_type"),
    ]


def apply_overrides(df: DataFrame, overrides: DataFrame, key: str = "flow_id") -> DataFrame:
    """Replace the fields that ``overrides`` sets (not null) on the rows it names."""
    fields = [c for c in overrides.columns if c != key]
    edits = overrides.select(key, *[F.col(c).alias(f"_new_{c}") for c in fields])
    joined = df.join(edits, key, "left")
    return joined.select(*[
        F.coalesce(f"_new_{c}", c).alias(c) if c in fields else F.col(c) for c in df.columns])


def top_features(importance: DataFrame, k: int = 15) -> DataFrame:
    """The k largest mean attributions, names breaking ties."""
    return importance.orderBy(F.desc("mean_abs_shap"), "feature").limit(k)
