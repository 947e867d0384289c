"""Snapshots: what changed, what is to be done, upserts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import reindex
from .dedupe import keep_last, stacked
from .filters import in_set, not_in_set


def change_status(counts: DataFrame, previous: DataFrame, key: list[str], now: Column | None = None) -> DataFrame:
    """``key, previous, current, status`` (and the time of a change): ZERO where both are 0, SKIPPED where equal, else
    MODIFIED. Both inputs have the key and a count ``n``; a key without a previous count had 0."""
    before = previous.select(*(F.col(k).alias(f"__{k}") for k in key), F.col("n").alias("__n"))
    met = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in key))
    joined = counts.join(before, met, "left").select(*key, F.coalesce("__n", F.lit(0)).alias("previous"), F.coalesce("n", F.lit(0)).alias("current"))
    status = F.when((F.col("previous") == 0) & (F.col("current") == 0), "ZERO").when(F.col("previous") == F.col("current"), "SKIPPED").otherwise("MODIFIED")
    out = joined.withColumn("status", status)
    return out if now is None else out.withColumn("changed_at", F.when(status == "MODIFIED", now))


def fields_differ(fields: list[str], old: str = "old", new: str = "new") -> Column:
    """Whether any field differs as text between two aliases; null counts as ``''``."""
    text = lambda side, f: F.coalesce(F.col(f"{side}.{f}").cast("string"), F.lit(""))
    return reduce(lambda a, b: a | b, (text(old, f) != text(new, f) for f in fields))


def changed_rows(old: DataFrame, new: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """Rows of ``new`` that are new or differ in one of the fields."""
    met = reduce(lambda a, b: a & b, (F.col(f"new.{k}").eqNullSafe(F.col(f"old.{k}")) for k in key))
    joined = new.alias("new").join(old.withColumn("__there", F.lit(True)).alias("old"), met, "left")
    return joined.where(F.col("old.__there").isNull() | fields_differ(fields)).select("new.*")


def upsert(existing: DataFrame, changes: DataFrame, key: list[str], kinds: dict[str, str] | None = None, seen: DataFrame | None = None) -> DataFrame:
    """The snapshot after the changes: of one key the latest stays. ``seen`` limits old rows to keys still listed;
    ``kinds`` declares the snapshot's columns."""
    old = existing if seen is None else in_set(existing, seen, key)
    if kinds:
        old, changes = reindex(old, kinds), reindex(changes, kinds)
    return keep_last(stacked(old, changes), key, ["__batch"]).drop("__batch")


def to_do(wanted: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """What of ``wanted`` isn't done yet; null keys are equal."""
    return not_in_set(wanted, done, key)


def size_check(old: int | Column, new: int | Column, least: float = 0.9) -> Column:
    """The ratio of new to old size, and whether it is too small; an old size of 0 never is."""
    o, n = (x if isinstance(x, Column) else F.lit(x) for x in (old, new))
    ratio = F.when(o > 0, n / o)
    return F.struct(ratio.alias("ratio"), F.coalesce(ratio < least, F.lit(False)).alias("too_small"))
