"""Counts and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_size(df: DataFrame, keys: list[str], name: str = "count") -> DataFrame:
    """Rows of each key; rows with a null in the key are left out."""
    known = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    return df.where(known).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def value_counts(df: DataFrame, column: str, name: str = "count") -> DataFrame:
    """As ``group_size``, the most frequent first, ties by value."""
    return group_size(df, [column], name).orderBy(F.desc(name), column)


def report_by(df: DataFrame, value: Column, label: str, by_count: bool = True) -> DataFrame:
    """A count for each value, sorted by count downwards or by value."""
    found = group_size(df.select(value.alias(label)), [label])
    return found.orderBy(F.desc("count"), label) if by_count else found.orderBy(label)


def status_counts(df: DataFrame, status: str = "status") -> DataFrame:
    """One row: how many there are, and how many of each outcome."""
    of = lambda s: F.count_if(F.col(status) == s)
    return df.agg(F.count(F.lit(1)).alias("total"), of("MODIFIED").alias("changed"), of("SKIPPED").alias("unchanged"), of("ZERO").alias("zero"))


def best_of_each(df: DataFrame, key: list[str], score: str, order: str, threshold: float) -> DataFrame:
    """The row with the greatest score of at least ``threshold`` for each key; of ties the first by ``order``."""
    rest = [c for c in df.columns if c not in (*key, score, order)]
    best = F.max(F.struct(F.col(score), (-F.col(order)).alias("__order"), *rest)).alias("__best")
    found = df.where(F.col(score) >= threshold).groupBy(*key).agg(best)
    return found.select(*key, F.col(f"__best.{score}"), (-F.col("__best.__order")).alias(order), *(f"__best.{c}" for c in rest))


def observed(df: DataFrame, name: str, **metrics: Column):
    """The frame and an observation whose values are there after an action: running counters without a job of their own."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, *(m.alias(n) for n, m in metrics.items())), seen
