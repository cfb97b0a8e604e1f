"""Headerless comma files of flows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.operators.labels import derive_labels
from flowlens.schema import flow_schema, taxonomy
from flowlens.session import stage

#: Equal rows that one task numbers at a time.
EQUAL_ROWS = 10_000


def field_count_profile(spark: SparkSession, path: str) -> DataFrame:
    """Rows per number of comma-separated fields, blank lines left out."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    n_fields = F.size(F.split("value", ",", -1)).cast("long")
    return lines.groupBy(n_fields.alias("n_fields")).agg(F.count("*").alias("n_rows"))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).filter(F.trim("value") != "")


def detect_schema(spark: SparkSession, path: str) -> T.StructType:
    """Schema without or with the trailing difficulty, judged by one line.

    Every other line is held to it while it is scanned.
    """
    variants = {len(s): s for s in (flow_schema(), flow_schema(with_difficulty=True))}
    line = _lines(spark, path).first()
    found = len(line.value.split(",")) if line else 0
    if found not in variants:
        raise ValueError(f"unexpected field counts: {found} in {path}, "
                         f"expected one of {sorted(variants)}")
    return variants[found]


def read_flows(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Scan a flow file in one pass; a line that does not fit the schema fails the job.

    Fields are plain text between commas, without quotes; an empty field is null.
    """
    schema = schema or detect_schema(spark, path)
    fields = F.split("value", ",", -1)
    told = F.concat(F.lit(f"unexpected field counts: expected {len(schema)}, found "),
                    F.size(fields).cast("string"))
    # a filter, so that no projection can prune the check away
    fits = F.when(F.size(fields) == len(schema), F.lit(True)).otherwise(
        F.raise_error(told).cast("boolean"))
    rows = _lines(spark, path).filter(fits).select(fields.alias("_f"))
    return rows.select(*[F.nullif(F.ltrim(F.get("_f", F.lit(i))), F.lit("")).cast(f.dataType)
                         .alias(f.name) for i, f in enumerate(schema)])


def load_split(spark: SparkSession, train_path: str, test_path: str) -> DataFrame:
    """Both files as one frame with ``split`` and the derived label columns.

    Only one line of each file is read here; a filter on ``split`` prunes the other file's scan.
    """
    parts = [read_flows(spark, path).withColumn("split", F.lit(split))
             for split, path in (("train", train_path), ("test", test_path))]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return derive_labels(both, taxonomy(spark))


def with_keys(df: DataFrame, key: str = "flow_id", table: str = "") -> DataFrame:
    """Give every row a unique key that depends on its file, its values and nothing else.

    Flow files have no key. It is made of a digest of ``table``, the file name and all values,
    and of the number of the row among equal ones, so it is the same under any split size and
    differs between files; rows of frames without a file need a ``table`` of their own.
    Equal rows are counted before the shuffle, and many of them are dealt out in blocks.
    """
    values = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    digest = F.substring(F.sha2(F.concat_ws("|", F.lit(table), F.input_file_name(), values), 256),
                         1, 32)
    counted = df.select("*", digest.alias("_digest")).groupBy(*df.columns, "_digest").agg(
        F.count("*").alias("_n"))
    blocks = F.explode(F.sequence(F.lit(0), F.expr(f"(_n - 1) div {EQUAL_ROWS}")))
    many = (counted.filter(F.col("_n") > EQUAL_ROWS).withColumn("_block", blocks)
            .repartition("_digest", "_block"))
    few = counted.filter(F.col("_n") <= EQUAL_ROWS).withColumn("_block", F.lit(0).cast("long"))
    first = F.col("_block") * EQUAL_ROWS
    nth = F.explode(F.sequence(first, F.least(first + EQUAL_ROWS, F.col("_n")) - 1))
    rows = few.unionByName(many).withColumn("_nth", nth)
    return rows.select(F.concat_ws("-", "_digest", "_nth").alias(key), *df.columns)


def stage_flows(df: DataFrame, key: str = "flow_id", table: str = "") -> DataFrame:
    """Give every row a unique key (see ``with_keys``) and store the table, split by ``split``."""
    return stage(with_keys(df, key, table), "flows", ["split"], spread_by=key)


def write_flows(df: DataFrame, path: str) -> None:
    """Write flow rows headerless, keeping label padding as it is."""
    df.write.csv(path, header=False, ignoreLeadingWhiteSpace=False,
                 ignoreTrailingWhiteSpace=False)
