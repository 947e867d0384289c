"""Cleaning and type coercion. Every function maps a column to a column and gives null for what can't be read."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EDGES = r"(?U)^\s+|\s+$"


def _text(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def strip(value: Column | str) -> Column:
    """Without white space at either end, the ideographic space included."""
    return F.regexp_replace(_text(value), _EDGES, "")


def to_number(value: Column | str) -> Column:
    """A double; white space around it is ignored, ``''`` and what isn't a decimal number give null."""
    plain = strip(value)
    # The cast also takes type suffixes such as 1d, which aren't numbers here.
    return F.when(plain.rlike(r"(?i)^[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?$|^[+-]?(inf|infinity|nan)$"), plain.try_cast("double"))


def digits_to_number(value: Column | str) -> Column:
    """The number that all digits of the text spell; null without digits."""
    return F.regexp_replace(_text(value), "[^0-9]", "").try_cast("double")


def truth_of_text(value: Column | str) -> Column:
    """False for null and the empty text, true for any other (``'False'`` too)."""
    return F.coalesce(_text(value) != "", F.lit(False))


def truth_of_number(value: Column | str) -> Column:
    """False for null and zero; true for any other, NaN too."""
    number = F.col(value) if isinstance(value, str) else value
    return F.coalesce(number != 0, F.lit(False))


def to_timestamp(value: Column | str, pattern: str) -> Column:
    return F.try_to_timestamp(_text(value), F.lit(pattern))


def to_date(value: Column | str, pattern: str = "yyyy-MM-dd") -> Column:
    return to_timestamp(value, pattern).cast("date")


def or_empty(value: Column | str) -> Column:
    """The value as text, ``''`` for null."""
    return F.coalesce(_text(value), F.lit(""))


def empty_to_null(value: Column | str) -> Column:
    return F.nullif(_text(value), F.lit(""))


def drop_escaped_quotes(value: Column | str) -> Column:
    r"""Without every occurrence of the three characters ``\\"``."""
    return F.replace(_text(value), F.lit('\\\\"'), F.lit(""))


def count_from_text(value: Column | str) -> Column:
    """An int with thousands commas removed; 0 for what isn't all digits."""
    plain = F.replace(_text(value), F.lit(","), F.lit(""))
    return F.coalesce(F.when(plain.rlike("^[0-9]+$"), plain.try_cast("int")), F.lit(0))


def first_integer(value: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_text(value), r"\d+", 0), F.lit("")).try_cast("int")


def year_of(value: Column | str) -> Column:
    """The text as an int, or else its first four digits in a row."""
    return F.coalesce(strip(value).try_cast("int"), F.nullif(F.regexp_extract(_text(value), r"(\d{4})", 1), F.lit("")).try_cast("int"))


def first_token_integer(value: Column | str) -> Column:
    return F.get(F.split(strip(value), r"\s+"), 0).try_cast("int")


def id_text(value: Column | str) -> Column:
    """An id as text, so ids of different types compare."""
    return _text(value)
