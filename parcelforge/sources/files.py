"""Scans of files: CSV with fallbacks and repair, Parquet, JSON lines, the latest file of a pattern."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import written

CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, **options) -> DataFrame:
    """CSV with a header; without a schema every column is text."""
    reader = spark.read.option("header", True).options(**options)
    return (reader.schema(schema) if schema else reader).csv(path)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of one column without null; only that column is read."""
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def read_csv_leniently(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the schema, and the raw lines that don't: quoted as usual, or with backslash escapes and no
    quotes. Only each file's first line is its header. ``multi_line``: quoted fields may hold line breaks (a file is
    then read by one task). A path that isn't there gives two empty frames."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema), spark.createDataFrame([], f"{CORRUPT} string")
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    # Written, since Spark can't read the corrupt lines of a CSV file alone.
    usual = written(read_csv(spark, path, full, **options, multiLine=multi_line), "csv-rows")
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in full.fields)
    made = F.from_csv(CORRUPT, F.lit(names), {**options, "quote": "", "escape": "\\"})
    again = usual.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"), made.alias("p")).select("value", "p.*")
    good = usual.where(F.col(CORRUPT).isNull()).unionByName(again.where(F.col(CORRUPT).isNull()).drop("value")).drop(CORRUPT)
    return good, again.where(F.col(CORRUPT).isNotNull()).select(F.col("value").alias(CORRUPT))


def split_quoted(line: Column) -> Column:
    """Fields of a CSV line: commas within double quotes don't part fields, quotes stay."""
    return F.regexp_extract_all(F.concat(line, F.lit(",")), F.lit(r'((?:[^",]|"[^"]*")*),'), F.lit(1))


def repaired_fields(line: Column, width: int) -> Column:
    """Exactly ``width`` fields: what is too many is joined into the last one, what is missing is ``''``."""
    fields = split_quoted(line)
    tail = F.array_join(F.slice(fields, width, 1 << 20), ",")
    long = F.concat(F.slice(fields, 1, width - 1), F.array(tail))
    short = F.concat(fields, F.array_repeat(F.lit(""), F.greatest(F.lit(0), F.lit(width) - F.size(fields))))
    return F.when(F.size(fields) > width, long).otherwise(short)


def repair_csv(lines: DataFrame, header: str, column: str = "value") -> DataFrame:
    """Text lines as columns named by the header, all text; blank lines and the header itself are dropped."""
    names = [n.strip() for n in header.split(",")]
    rows = lines.where((F.trim(column) != "") & (F.col(column) != header)).select(repaired_fields(F.col(column), len(names)).alias("f"))
    return rows.select(*(F.get("f", k).alias(n) for k, n in enumerate(names)))


def _matches(spark: SparkSession, pattern: str) -> list:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return list(found or [])


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_matches(spark, path))


def latest(spark: SparkSession, pattern: str) -> str | None:
    """The path that was modified last, of equal times the greatest name; null without any."""
    return max(((f.getModificationTime(), f.getPath().toString()) for f in _matches(spark, pattern)), default=(0, None))[1]


def load_present(spark: SparkSession, sources: dict[str, tuple[str, T.StructType, Callable]]) -> dict[str, DataFrame]:
    """A frame for each name: read where its path is there, else empty with the declared schema."""
    return {n: read(spark, path) if exists(spark, path) else spark.createDataFrame([], schema) for n, (path, schema, read) in sources.items()}
