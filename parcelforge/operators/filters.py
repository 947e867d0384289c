"""Filters that keep nulls as a data frame library does, and filters by date."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def differs_from(value: Column, constant) -> Column:
    """``!=`` that keeps nulls."""
    return ~value.eqNullSafe(F.lit(constant))


def is_blank(value: Column) -> Column:
    return F.coalesce(F.trim(value) == "", F.lit(True))


def in_set(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is among ``keys``; null equals null."""
    return _against(df, keys, on, "left_semi")


def not_in_set(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key isn't among ``keys``; null equals null."""
    return _against(df, keys, on, "left_anti")


def _against(df: DataFrame, keys: DataFrame, on: list[str], how: str) -> DataFrame:
    other = keys.select(*(F.col(c).alias(f"__{c}") for c in on)).distinct()
    return df.join(other, reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in on)), how)


def _truthy(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return column != ""
    if isinstance(kind, T.BooleanType):
        return column
    if isinstance(kind, T.NumericType):
        return column != 0
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.size(column) > 0
    return column.isNotNull()


def any_truthy(df: DataFrame) -> DataFrame:
    """Rows with a value other than null, zero, false, ``''`` and empty collections."""
    if not df.columns:
        return df
    return df.where(reduce(lambda a, b: a | b, (F.coalesce(_truthy(F.col(f"`{f.name}`"), f.dataType), F.lit(False)) for f in df.schema.fields)))


def since(date: Column, control: Column) -> Column:
    """Not before the control date; a null date passes."""
    return date.isNull() | (date >= control)


def take_until_old(df: DataFrame, area: list[str], position: str, date: str, control: Column) -> DataFrame:
    """Within each area, in order of position: rows up to the first one before the control date, without those whose
    date is null.

    The first old position of each area is aggregated and joined back, so an area of any size is spread over tasks.
    """
    old = df.where(F.col(date) < control).groupBy(*area).agg(F.min(position).alias("__stop"))
    names = {c: f"__{c}" for c in area}
    met = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()))
    joined = df.join(old.withColumnsRenamed(names), met, "left")
    return joined.where(F.col(date).isNotNull() & (F.col("__stop").isNull() | (F.col(position) < F.col("__stop")))).drop("__stop", *names.values())


def first_rows(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows in an order that the caller makes total."""
    return df.orderBy(*order).limit(n)


def top_of_each(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    place = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("__place", F.row_number().over(place)).where("__place = 1").drop("__place")
