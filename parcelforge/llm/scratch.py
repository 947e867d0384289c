"""Shared working space: intermediate tables that outlive any one executor."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ..sources.shared import new_path, released, written

__all__ = ["fits_broadcast", "materialise", "new_path", "released", "trimmed"]


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again, which cuts its lineage."""
    return written(df, name, compression="zstd")


#: A side of a join is broadcast only when its row count times row width stays below this many bytes.
BROADCAST_BYTES = 64 << 20
#: What one id takes in a broadcast hash table.
HASHED_ID_BYTES = 64


def fits_broadcast(rows: int, row_bytes: int = HASHED_ID_BYTES) -> bool:
    return rows * row_bytes <= BROADCAST_BYTES


def trimmed(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches; after the last one the worker process, which lives on for other tasks, gives the memory that it has
    freed back to the system, where its C library can."""
    yield from found
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass
