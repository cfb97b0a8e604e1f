"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from flowlens.session import scratch_path

#: Rows and bytes of one Arrow batch that are turned into Python objects at a time; a row of
#: more bytes goes alone.
SLICE_ROWS, SLICE_BYTES = 512, 1 << 21
#: Bytes of one Arrow batch between the JVM and Python.
BATCH_BYTES = 4 << 20
_BATCH_KEY, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder, so that later reads prune columns."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, which bounds the Python objects alive at once."""
    for batch in batches:
        todo = [(at, min(SLICE_ROWS, batch.num_rows - at))
                for at in range(0, batch.num_rows, SLICE_ROWS)][::-1]
        while todo:
            at, n = todo.pop()
            part = batch.slice(at, n)
            if n > 1 and part.nbytes > SLICE_BYTES:
                todo += [(at + n // 2, n - n // 2), (at, n // 2)]
            else:
                yield part


def trim() -> None:
    """Give freed memory of this Python worker back, which the next stage's tasks share."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # a C library without it keeps what it freed
        pass


def in_batches(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` over batches of bounded bytes; workers give back what they freed.

    A session that sets a bound of its own keeps it.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH_KEY) == _BATCH_DEFAULT:
        conf.set(_BATCH_KEY, str(BATCH_BYTES))

    def bounded(batches):
        try:
            yield from run(slices(batches))
        finally:
            trim()

    return df.mapInArrow(bounded, schema)


def texts_of(column: pa.Array) -> list[str]:
    """Python strings; null counts as the empty text."""
    return [x or "" for x in column.to_pylist()]


def mapped(df: DataFrame, schema: str, per_slice: Callable[[pa.RecordBatch], dict]) -> DataFrame:
    """Apply ``per_slice`` (batch in, columns out) to all rows, batch by batch."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            columns = per_slice(batch)
            yield pa.RecordBatch.from_arrays(
                [x if isinstance(x, pa.Array) else pa.array(x, type=f.type)
                 for f, x in ((f, columns[f.name]) for f in out)], schema=out)

    return in_batches(df, run, schema)
