"""Intermediate tables in the shared folder: they cut lineage and outlive any one executor.

Tables written within ``released`` are deleted at its end, but for those that are told to be kept. The shuffle files of a
write are deleted at its end too: what was written is read from the shared folder, and Spark would keep them until the
driver happens to collect its garbage.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Whether Spark deletes a query's shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a temporary folder where it is unset and Spark runs on this machine
    alone, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        found = tempfile.mkdtemp(prefix="spark-shared-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(found)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` written as Parquet and read again, which cuts its lineage."""
    path = new_path(df.sparkSession, name)
    with _shuffles_deleted(df.sparkSession):
        df.write.options(**options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    if scopes := _scopes():
        scopes[-1].append((out, path))
    return out


@contextmanager
def _shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)


_thread = threading.local()


def _scopes() -> list[list[tuple[DataFrame, str]]]:
    """For each open ``released`` of this thread, innermost last, the tables written in it."""
    if not hasattr(_thread, "scopes"):
        _thread.scopes = []
    return _thread.scopes


@contextmanager
def released(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Gives a function that keeps a written table, and returns it; the other tables written meanwhile are deleted at the end.
    Nothing that is read later may be made of those. After an error all stay, for what has to be looked into."""
    scopes, kept = _scopes(), []
    scopes.append([])
    try:
        yield lambda df: kept.append(df) or df
    except BaseException:
        scopes.pop()
        raise
    own = scopes.pop()
    for df, path in own:
        if any(df is k for k in kept):
            if scopes:
                scopes[-1].append((df, path))
            continue
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
