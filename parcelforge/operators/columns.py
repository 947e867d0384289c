"""Columns: required sets, renames, context, keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def add_missing(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Columns that the frame lacks, as nulls of the declared types."""
    return df.withColumns({n: F.lit(None).cast(t) for n, t in kinds.items() if n not in df.columns})


def reindex(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Exactly the declared columns, in their order."""
    return add_missing(df, kinds).select(*kinds)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Without the columns that hold nothing but nulls. One eager aggregation over all rows."""
    counts = df.agg(*(F.count(F.col(f"`{c}`")).alias(str(k)) for k, c in enumerate(df.columns))).head()
    return df.select(*(F.col(f"`{c}`") for k, c in enumerate(df.columns) if counts[str(k)]))


def first_of_each_name(columns: list[str]) -> list[int]:
    """Places of the columns that stay when of equal names the first one does."""
    return [k for k, c in enumerate(columns) if c not in columns[:k]]


def keep_first_names(df: DataFrame) -> DataFrame:
    """Without later columns of a name that came before."""
    unique = df.toDF(*(f"_{k}" for k in range(len(df.columns))))
    return unique.select(*(F.col(f"_{k}").alias(df.columns[k]) for k in first_of_each_name(df.columns)))


def with_context(df: DataFrame, **values) -> DataFrame:
    """Constant columns."""
    return df.withColumns({n: v if isinstance(v, Column) else F.lit(v) for n, v in values.items()})


def stamped(df: DataFrame, name: str = "LastScraped", now: Column | None = None) -> DataFrame:
    """The time of ingestion as ``yyyy-MM-dd HH:mm:ss`` text."""
    return df.withColumn(name, F.date_format(F.current_timestamp() if now is None else now, "yyyy-MM-dd HH:mm:ss"))
