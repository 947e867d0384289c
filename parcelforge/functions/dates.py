"""Dates: month slices, control dates, month stamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_slices(start: Column, end: Column) -> Column:
    """Array of ``struct(first, last)`` from the newest month to the month of ``start``, whose first day isn't clamped.

    The newest slice ends at ``end``. A start after the end gives an empty array, a null end or start null.
    """
    months = F.sequence(F.trunc(start, "MM"), F.trunc(end, "MM"), F.expr("INTERVAL 1 MONTH"))
    slices = F.transform(months, lambda m: F.struct(m.alias("first"), F.least(F.last_day(m), end).alias("last")))
    return F.when(start > end, F.slice(slices, 1, 0)).otherwise(F.reverse(slices))


def safe_month_slices(start: Column, end: Column) -> Column:
    """``month_slices`` where start and end may stand in either order."""
    return F.when(start <= end, month_slices(F.least(start, end), end)).otherwise(F.array().cast("array<struct<first:date,last:date>>"))


def month_stamp(value: Column) -> Column:
    return F.date_format(value, "yyyyMM")


def due_this_month(last_update: Column, today: Column) -> Column:
    """Whether a monthly update hasn't run yet in today's month; never run counts as due."""
    return F.coalesce(month_stamp(last_update) != month_stamp(today), F.lit(True))


def api_range(start: Column, end: Column) -> Column:
    """``dd/mm/yyyy-dd/mm/yyyy``, percent-encoded."""
    return F.url_encode(F.concat(F.date_format(start, "dd/MM/yyyy"), F.lit("-"), F.date_format(end, "dd/MM/yyyy")))


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")
