"""Session helpers: the shared work folder and table staging."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local-mode session without that setting gets a fresh folder of its own; a cluster
    session without it is an error, since a driver-local folder would be lost with the node.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    app = sc.applicationId
    if app not in _LOCAL_DIRS:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="flowlens-")
        sc.setCheckpointDir(_LOCAL_DIRS[app])
    return _LOCAL_DIRS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None,
          spread_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage for frames that several jobs or many training passes read; the table
    outlives any executor. A table of fewer files than cores is written once more, dealt
    evenly by ``spread_by``, so that later passes use every core.
    """
    spark, parts = df.sparkSession, partition_by or []

    def write(rows, path):
        rows.write.partitionBy(*parts).parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    table = write(df, scratch_path(spark, name))
    cores = spark.sparkContext.defaultParallelism
    if spread_by and len(table.inputFiles()) < cores * (2 if parts else 1):
        table = write(table.repartition(cores, spread_by), scratch_path(spark, name))
    return table
