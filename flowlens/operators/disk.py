"""Arrays of a task that grow with its rows: kept in unnamed files on local disk.

They are mapped, so the system holds of them what memory is free and a task itself only the block
of rows that it works on. A file goes with the last array over it.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np

#: Rows that are worked on at a time.
BLOCK_ROWS = 1 << 16


def scratch_file():
    """An unnamed file in one of Spark's local folders, or else where Python keeps such files."""
    places = [p for p in os.environ.get("SPARK_LOCAL_DIRS", "").split(",") if os.path.isdir(p)]
    return tempfile.TemporaryFile(dir=places[os.getpid() % len(places)] if places else None)


def mapped(file, dtype, shape: tuple[int, ...]) -> np.ndarray:
    """The file as an array; it grows to the array's size."""
    if not all(shape):
        return np.zeros(shape, dtype)
    file.flush()
    return np.memmap(file, dtype, "r+", shape=shape)


def zeros(shape: tuple[int, ...], dtype) -> np.ndarray:
    return mapped(scratch_file(), dtype, shape)


def blocks(n: int, rows: int | None = None) -> Iterator[slice]:
    rows = rows or BLOCK_ROWS
    return (slice(at, min(at + rows, n)) for at in range(0, n, rows))
