"""Flow views over the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.operators.labels import derive_labels
from flowlens.operators.novelty import mark_novel
from flowlens.schema import taxonomy

NUMERIC = ["duration", "src_bytes", "dst_bytes", "cnt", "serror_rate", "same_srv_rate",
           "num_outbound_cmds"]
NOMINAL = ["protocol_type", "service", "flag"]


SPLIT_BYTES = 128 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fact_table(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table that is dealt over the cores by ``key`` if it is too small to fill them.

    A table of many files, or of few but large ones, is read as it lies, without a shuffle.
    """
    df = table(spark, sf_dir, name)
    cores, files = spark.sparkContext.defaultParallelism, df.inputFiles()
    if len(files) >= cores:
        return df
    lengths = spark.read.format("binaryFile").load(files).select("length")
    small = lengths.agg(F.sum("length")).first()[0] < cores * SPLIT_BYTES
    return df.repartition(cores, key) if small else df


def flows_from(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> DataFrame:
    """Order lines seen as flows; ``lineitem`` may be a stream."""
    joined = (lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey)
                      .join(part, lineitem.l_partkey == part.p_partkey))
    in_test = F.col("l_orderkey") % 5 == 0
    qty, size = F.col("l_quantity"), F.col("p_size")
    label = (F.when((qty >= 49) & (F.col("l_tax") >= 0.075) & in_test, "snmpguess")
              .when((qty >= 48) & (size >= 40) & in_test, "mailbomb")
              .when((qty >= 50) & (F.col("l_discount") >= 0.095), "rootkit")
              .when((qty >= 45) & (size >= 48), "guess_passwd")
              .when((qty >= 36) & (F.col("l_tax") < 0.025), " satan. ")
              .when((qty >= 30) & (size <= 30), "neptune.")
              .when((qty == 29) & (size == 31), "mystery")
              .otherwise("normal"))
    protocol = (F.when(F.col("o_orderstatus") == "F", "tcp")
                 .when(F.col("o_orderstatus") == "O", "udp")
                 .otherwise("icmp"))
    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    qty.cast("int")).alias("flow_id"),
        protocol.alias("protocol_type"),
        F.lower("p_type").alias("service"),
        F.concat("l_returnflag", "l_linestatus").alias("flag"),
        qty.alias("duration"),
        F.col("l_extendedprice").alias("src_bytes"),
        F.col("p_retailprice").alias("dst_bytes"),
        size.cast("double").alias("cnt"),
        F.col("l_tax").alias("serror_rate"),
        F.col("l_discount").alias("same_srv_rate"),
        F.lit(0.0).alias("num_outbound_cmds"),
        F.when(in_test, "test").otherwise("train").alias("split"),
        label.alias("label"))


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows_from(fact_table(spark, sf_dir, "lineitem", "l_orderkey"),
                      table(spark, sf_dir, "orders"), table(spark, sf_dir, "part"))


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_labels(flows(spark, sf_dir), taxonomy(spark))


def rule_scores(df: DataFrame) -> DataFrame:
    """A fixed rule in place of the fitted models: class, confidence and anomaly score."""
    pred = (F.when((F.col("duration") >= 36) & (F.col("serror_rate") < 0.035), "Probe")
             .when((F.col("duration") >= 30) & (F.col("cnt") <= 35), "DoS")
             .when((F.col("duration") >= 46) & (F.col("cnt") >= 45), "R2L")
             .when(F.col("duration") >= 50, "U2R")
             .otherwise("Normal"))
    step = (F.col("cnt").cast("int") * 7 % 50).cast("double") / 49
    score = (F.col("duration") + 20 * F.col("same_srv_rate") * 10 + F.col("cnt") / 5) / 100
    return (df.withColumn("pred_class", pred)
              .withColumn("pred_conf", 0.4 + 0.6 * step)
              .withColumn("anomaly_score", F.round(score, 3)))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    everything = typed(spark, sf_dir)
    test = everything.filter("split = 'test'")
    return mark_novel(rule_scores(test), everything.filter("split = 'train'"))


def detections(scored_df: DataFrame) -> DataFrame:
    """Long score table of three detectors: one row per (model, flow)."""
    one_scan = F.explode(F.array(
        F.struct(F.lit("rule").alias("model"), F.col("anomaly_score").alias("score")),
        F.struct(F.lit("volume").alias("model"), F.col("src_bytes").alias("score")),
        F.struct(F.lit("doubt").alias("model"), (1 - F.col("pred_conf")).alias("score"))))
    return (scored_df.withColumn("d", one_scan)
                     .select("d.model", "flow_id", "d.score", "binary_label", "is_novel"))


def predictions(scored_df: DataFrame) -> DataFrame:
    """Long prediction table of two models on two tasks.

    The binary task has every row; rows of unmapped class are left out of the five-class task.
    """
    guess_bin = F.when(F.col("pred_class") == "Normal", "Normal").otherwise("Attack")
    truth_bin = F.when(F.col("binary_label") == 1, "Attack").otherwise("Normal")

    def row(task, model, truth, guess):
        return F.struct(F.lit(task).alias("task"), F.lit(model).alias("model"),
                        truth.alias("truth"), guess.alias("guess"))

    one_scan = F.explode(F.array(
        row("binary", "rule", truth_bin, guess_bin),
        row("binary", "majority", truth_bin, F.lit("Normal")),
        row("multiclass", "rule", F.col("category"), F.col("pred_class")),
        row("multiclass", "majority", F.col("category"), F.lit("Normal"))))
    return (scored_df.withColumn("p", one_scan)
                     .filter("p.task = 'binary' OR category <> 'Unknown'")
                     .select("p.task", "p.model", "flow_id", "p.truth", "p.guess"))
