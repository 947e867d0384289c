"""Writing frames: whole, appended, replaced after a backup, exported."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import exists, read_csv


def _system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_parquet(df: DataFrame, path: str) -> None:
    """Overwrite ``path``; the new files are whole before the old ones go, so a frame may read what it replaces."""
    replace(df, path, "parquet", backup=None)


def replace(df: DataFrame, path: str, kind: str = "parquet", backup: str | None = None, **options) -> None:
    """Write beside ``path``, then put it in its place; the old files move to ``backup`` if one is named.

    The old files are moved aside before the new ones come, and deleted last, so a crash at any point leaves one whole
    copy: at ``path``, or beside it as ``.fresh`` and ``.old``.
    """
    spark, place = df.sparkSession, path.rstrip("/")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    df.write.mode("overwrite").format(kind).options(**options).save(f"{place}.fresh")
    fs, target = _system(spark, place)
    aside = hadoop(backup or f"{place}.old")

    def moved(a, b) -> None:
        if not fs.rename(a, b):
            raise OSError(f"{a} can't be moved to {b}")

    if fs.exists(target):
        fs.delete(aside, True)
        moved(target, aside)
    moved(hadoop(f"{place}.fresh"), target)
    if not backup:
        fs.delete(aside, True)


def write_csv(df: DataFrame, path: str, mark: bool = False, mode: str = "overwrite") -> None:
    """CSV with a header; ``mark`` puts a byte order mark before the first name of each file."""
    if mark and df.columns:
        df = df.withColumnRenamed(df.columns[0], "﻿" + df.columns[0])
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def append_csv(df: DataFrame, path: str) -> None:
    """Add files; each has its own header, which readers of the folder skip."""
    write_csv(df, path, mode="append")


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines; nested values stay nested, other characters than ASCII stay as they are."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_json_array(df: DataFrame, path: str) -> None:
    """Files that are one JSON array each, a row to a line; nested values stay nested, other characters than ASCII stay."""

    def lines(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each line behind its comma or bracket; one line is held back until it is known whether another follows."""
        held, mark = None, "["
        for batch in batches:
            out = []
            for row in batch.column(0).to_pylist():
                if held is not None:
                    out.append(f"{mark}{held},")
                    mark = ""
                held = row
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array([f"{mark}{held or ''}]"], pa.string())], ["value"])

    text = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
    text.mapInArrow(lines, "value string").write.mode("overwrite").text(path)


def csv_to_parquet(spark: SparkSession, source: str, target: str) -> None:
    write_parquet(read_csv(spark, source), target)


def parquet_to_csv(spark: SparkSession, source: str, target: str) -> None:
    write_csv(spark.read.parquet(source), target)


def append_new(df: DataFrame, path: str, key: list[str]) -> DataFrame:
    """Append the rows whose key isn't saved yet, as a resumed run does; returns what the path then holds."""
    from ..operators.filters import not_in_set

    spark = df.sparkSession
    fresh = not_in_set(df, spark.read.parquet(path), key) if exists(spark, path) else df
    fresh.write.mode("append").parquet(path)
    return spark.read.parquet(path)


def shrunk(spark: SparkSession, old: str, new: str, least: float = 0.9) -> bool:
    """Whether the new Parquet folder has fewer than ``least`` times the rows of the old one; an empty old one has none."""
    n_old, n_new = (spark.read.parquet(p).agg(F.count(F.lit(1))).head()[0] for p in (old, new))
    return bool(n_old) and n_new < least * n_old
