"""Nested values: paths, arrays to rows or columns, literals as text, flattening."""

from __future__ import annotations

import ast
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def project_paths(df: DataFrame, paths: dict[str, str]) -> DataFrame:
    """One column for each ``name: a.b.c``; null where anything on the way is null, or the schema lacks it."""

    def at(path: str) -> Column:
        kind: T.DataType = df.schema
        for step in path.split("."):
            if not isinstance(kind, T.StructType) or step not in kind.fieldNames():
                return F.lit(None).cast("string")
            kind = kind[step].dataType
        return F.col(".".join(f"`{s}`" for s in path.split(".")))

    return df.select(*(at(p).alias(n) for n, p in paths.items()))


def json_path(text: Column, path: str, kind: str = "string") -> Column:
    """A value out of JSON text; null where the text isn't JSON or has no such path."""
    return F.get_json_object(text, path).try_cast(kind)


def repair_literal(text: Column) -> Column:
    """Quotes and nulls of a Python literal as JSON has them. An apostrophe inside a value makes it unreadable."""
    return F.replace(F.replace(text, F.lit("'"), F.lit('"')), F.lit("None"), F.lit("null"))


def explode_literal(df: DataFrame, column: str, fields: dict[str, str], out: dict[str, str]) -> DataFrame:
    """A row for each element of the list that ``column`` holds as text, with the chosen fields as new columns.

    Null, empty or unreadable text keeps one row without the fields; an empty list keeps none. ``fields``: name to
    type; ``out``: new column to field. The column itself goes.
    """
    schema = T.ArrayType(T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, t in fields.items()]))
    text = F.col(column)
    repaired = repair_literal(text)
    parsed = F.when(F.trim(repaired).startswith("["), F.from_json(repaired, schema))
    # from_json gives a list of null fields for some broken texts; an element that isn't an object counts as broken.
    one = F.array(F.lit(None).cast(schema.elementType))
    element = F.explode(F.coalesce(parsed, one))
    rows = df.withColumn("__element", element).drop(column)
    return rows.select(*(c for c in df.columns if c != column), *(F.col("__element")[f].alias(n) for n, f in out.items()))


def nested_loops(df: DataFrame, outer: list[str], levels: list[tuple[str, str]]) -> DataFrame:
    """Inner explosion of arrays within arrays: ``levels`` gives ``(path, alias)`` from the outside in."""
    rows = df.select(*outer, *(c for c in {levels[0][0].split(".")[0]} if c not in outer))
    for path, alias in levels:
        rows = rows.withColumn(alias, F.explode(F.col(path)))
    return rows


def numbered_columns(df: DataFrame, column: str, fields: list[str], most: int, prefix: str) -> DataFrame:
    """``prefix_1_field ...`` from an array of structs, up to a declared number of elements; the array goes."""
    made = [F.get(F.col(column), i)[f].alias(f"{prefix}_{i + 1}_{f}") for i in range(most) for f in fields]
    return df.select(*(c for c in df.columns if c != column), *made)


def flatten(df: DataFrame, columns: list[str] | None = None, list_width: int = 3) -> DataFrame:
    """Structs (and the first ``list_width`` elements of arrays of structs) as columns named by joined paths.

    Names are joined by ``_``; an element's place is a step of its path, after one more ``_`` at the top.
    """

    def walk(value: Column, kind: T.DataType, name: str, top: bool) -> list[Column]:
        if isinstance(kind, T.StructType):
            return [x for f in kind.fields for x in walk(value[f.name], f.dataType, f"{name}_{f.name}", False)]
        if isinstance(kind, T.ArrayType):
            gap = "__" if top else "_"
            return [x for i in range(list_width) for x in walk(F.get(value, i), kind.elementType, f"{name}{gap}{i}", False)]
        return [value.alias(name)]

    chosen = df.columns if columns is None else columns
    return df.select(*(x for f in df.schema.fields for x in (walk(F.col(f.name), f.dataType, f.name, True) if f.name in chosen else [F.col(f.name)])))


@F.pandas_udf(T.StringType())
def literal_to_json(text: pd.Series) -> pd.Series:
    """Any Python literal as JSON; null for blank text and for what isn't a literal."""

    def one(value: str | None) -> str | None:
        if value is None or not value.strip():
            return None
        try:
            return json.dumps(ast.literal_eval(value.strip()), ensure_ascii=False, default=str)
        except (ValueError, SyntaxError, MemoryError, RecursionError, TypeError):
            return None

    return text.map(one)


def literal_field(text: Column, field: str, default: Column | None = None) -> Column:
    """One field of a dict that is kept as literal text; the default (or null) where it isn't there."""
    found = F.get_json_object(literal_to_json(text), f"$.{field}")
    return found if default is None else F.coalesce(found, default)


def price_columns(df: DataFrame, column: str = "priceInfo") -> DataFrame:
    """The six prices of a struct as columns; the struct goes."""
    names = ["price", "pricePostTypeDisplayName", "avgPrice", "rental", "rentPostTypeDisplayName", "avgRental"]
    return df.withColumns({n: F.col(column)[n] for n in names}).drop(column)


def record_json(df: DataFrame, name: str = "original_record") -> DataFrame:
    """Each row with all its columns as JSON besides."""
    return df.withColumn(name, F.to_json(F.struct(*df.columns)))


def last_wins(pairs: Column) -> Column:
    """A map of ``struct(key, value)`` elements in which the last of equal keys wins; null keys are left out."""
    known = F.filter(pairs, lambda p: p["key"].isNotNull())
    keys = F.array_distinct(F.transform(known, lambda p: p["key"]))
    values = F.transform(keys, lambda k: F.try_element_at(F.filter(known, lambda p: p["key"] == k), F.lit(-1))["value"])
    return F.map_from_arrays(keys, values)


def share_any(a: Column, b: Column) -> Column:
    return F.coalesce(F.arrays_overlap(a, b), F.lit(False))
