"""Joins: null-safe with suffixes, by counts, products of lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedupe import keep_first

def left_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, suffixes: tuple[str, str] = ("_left", "_right"), null_safe: bool = False) -> DataFrame:
    """A left join that keeps both keys and adds the suffixes to names that both sides have.

    ``null_safe``: a null key meets a null key, as data frame libraries have it.
    """
    both = set(left.columns) & set(right.columns)
    a = left.withColumnsRenamed({c: c + suffixes[0] for c in both if suffixes[0]})
    b = right.withColumnsRenamed({c: c + suffixes[1] for c in both})
    x = F.col("l." + (left_key + suffixes[0] if left_key in both else left_key))
    y = F.col("r." + (right_key + suffixes[1] if right_key in both else right_key))
    return a.alias("l").join(b.alias("r"), x.eqNullSafe(y) if null_safe else x == y, "left").select("l.*", "r.*")


def left_join_first(left: DataFrame, right: DataFrame, left_key: str, right_key: str, order: list[str], suffixes: tuple[str, str] = ("", "_estate")) -> DataFrame:
    """As ``left_join``, against the first right row of each key, so rows never multiply."""
    return left_join(left, keep_first(right, [right_key], order), left_key, right_key, suffixes, null_safe=True)


def with_count(df: DataFrame, counts: DataFrame, key: str, name: str = "n") -> DataFrame:
    """The count that a table has for each row's key, else 0."""
    other = counts.select(F.col(key).alias("__key"), F.col(name).alias("__n"))
    return df.join(other, F.col(key).eqNullSafe(F.col("__key")), "left").withColumn(name, F.coalesce("__n", F.lit(0))).drop("__key", "__n")


def product(a: DataFrame, b: DataFrame) -> DataFrame:
    """Every combination of two lists, such as districts and types. Spark sends a side to the other's tasks where it is
    small, and else pairs up partitions."""
    return a.crossJoin(b)
