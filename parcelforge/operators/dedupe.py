"""Keep-first and keep-last deduplication, unions by name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _ordered(kind: T.DataType) -> bool:
    """Whether Spark can compare values of a type: not maps, nor what has one within."""
    if isinstance(kind, T.ArrayType):
        return _ordered(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_ordered(f.dataType) for f in kind)
    return not isinstance(kind, T.MapType | T.VariantType)


def comparable(column: Column, kind: T.DataType) -> Column:
    """The column itself, or, where its type has no order, its JSON, a map's entries sorted by key."""
    if _ordered(kind):
        return column
    if isinstance(kind, T.MapType):
        entries = F.map_entries(column)
        told = F.transform(entries, lambda e: F.struct(comparable(e["key"], kind.keyType).alias("key"), comparable(e["value"], kind.valueType).alias("value")))
        return F.array_sort(told)
    return F.to_json(F.struct(column.alias("x")))


def _keep(df: DataFrame, key: list[str], order: list[str], pick, pick_by) -> DataFrame:
    # An aggregate with partial sums where a window would gather and sort each key's rows. Null keys are equal.
    by = [F.col(c).alias(f"o{k}") for k, c in enumerate(order)]
    if all(_ordered(f.dataType) for f in df.schema):
        return df.groupBy(*key).agg(pick(F.struct(*by, F.struct(*df.columns).alias("row")))["row"].alias("__row")).select("__row.*")
    ties = F.struct(*by, *(comparable(F.col(f.name), f.dataType).alias(f"t{k}") for k, f in enumerate(df.schema)))
    return df.groupBy(*key).agg(pick_by(F.struct(*df.columns), ties).alias("__row")).select("__row.*")


def keep_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Of rows of one key the first by ``order``, ties by all columns in turn; maps are compared by their sorted entries."""
    return _keep(df, key, order, F.min, F.min_by)


def keep_last(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    return _keep(df, key, order, F.max, F.max_by)


def union_all(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; a column that one lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def stacked(*frames: DataFrame, order: str = "__batch") -> DataFrame:
    """As ``union_all``, with the frame's number, so that earlier frames come first in ``keep_first``."""
    return union_all(*(f.withColumn(order, F.lit(k)) for k, f in enumerate(frames)))
