"""Similarity of names: token-sort and token-set ratios, and the weighted score of two buildings.

A ratio is the sequence matcher's, times 100 and rounded. Texts are lower-cased, their punctuation becomes spaces,
their tokens are sorted. Two empty texts are equal (100); an empty and another text have 0.
"""

from __future__ import annotations

import re
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The weights of name, address, district and numbers, and the thresholds.
WEIGHTS = {"name": 0.6, "address": 0.2, "district": 0.1, "digits": 0.1}
ENTITY_THRESHOLD = 75
NAME_THRESHOLD = 85


@lru_cache(maxsize=1 << 16)
def ratio(a: str, b: str) -> int:
    if a == b:
        return 100
    return round(100 * SequenceMatcher(None, a, b, autojunk=False).ratio()) if a and b else 0


def tokens_of(text: str) -> list[str]:
    return re.sub(r"\W|_", " ", text.lower()).split()


def token_sort_of(a: str, b: str) -> int:
    return ratio(" ".join(sorted(tokens_of(a))), " ".join(sorted(tokens_of(b))))


def token_set_of(a: str, b: str) -> int:
    """The best of the shared tokens against either side's, and of the two sides; 100 where one side's tokens are all
    among the other's."""
    one, two = set(tokens_of(a)), set(tokens_of(b))
    if not one or not two:
        return 100 if one == two else 0
    both = " ".join(sorted(one & two))
    left, right = (" ".join(x for x in (both, " ".join(sorted(side))) if x) for side in (one - two, two - one))
    # A side begins with what is shared, so all of that matches.
    return max(*(round(100 * (2.0 * len(both) / (len(both) + len(x)))) for x in (left, right) if both), ratio(left, right), 0)


@F.pandas_udf(T.IntegerType())
def token_sort_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_sort_of(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype="int32")


@F.pandas_udf(T.IntegerType())
def token_set_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([token_set_of(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype="int32")


@F.pandas_udf(T.IntegerType())
def name_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """The better of the two ratios."""
    return pd.Series([max(token_sort_of(x or "", y or ""), token_set_of(x or "", y or "")) for x, y in zip(a, b, strict=True)], dtype="int32")


def _chars(text: str) -> tuple[int, list[int]]:
    """Its length and its characters, each with the number of its earlier ones, so that equal ones are told apart."""
    seen: dict[str, int] = {}
    out = []
    for c in text:
        seen[c] = k = seen.get(c, -1) + 1
        out.append(ord(c) << 32 | k)
    return len(text), out


_PARTS = {"tokens": T.ArrayType(T.StringType()), "sort_length": T.IntegerType(), "sort_chars": T.ArrayType(T.LongType()), "set_length": T.IntegerType(), "set_chars": T.ArrayType(T.LongType())}


@F.pandas_udf(T.StructType([T.StructField(n, kind) for n, kind in _PARTS.items()]))
def parts(text: pd.Series) -> pd.DataFrame:
    """What the bounds below need of a text: its distinct tokens, and length and numbered characters of all and of its
    distinct tokens, joined."""
    rows = []
    for x in text:
        own = tokens_of(x or "")
        once = sorted(set(own))
        rows.append((once, *_chars(" ".join(own)), *_chars(" ".join(once))))
    return pd.DataFrame(rows, columns=list(_PARTS))


def _most(shared: Column, one: Column, other: Column) -> Column:
    """The greatest rounded ratio of two texts of such lengths with ``shared`` characters in common."""
    return F.when(one + other > 0, 200.0 * shared / (one + other) + 0.5).otherwise(100.0)


def sort_bound(a: Column, b: Column) -> Column:
    """At least the token-sort ratio of two texts, from their ``parts``: what matches are characters of both."""
    return _most(F.size(F.array_intersect(a["sort_chars"], b["sort_chars"])), a["sort_length"], b["sort_length"])


def name_bound(a: Column, b: Column) -> Column:
    """At least the better of the two ratios, from the texts' ``parts``."""
    both = F.char_length(F.array_join(F.array_intersect(a["tokens"], b["tokens"]), " "))
    one_side = lambda side: F.when(both > 0, _most(both, both, side["set_length"])).otherwise(0.0)
    whole = _most(F.size(F.array_intersect(a["set_chars"], b["set_chars"])), a["set_length"], b["set_length"])
    return F.least(F.greatest(sort_bound(a, b), whole, one_side(a), one_side(b)), F.lit(100.0))


def building_score(name: tuple[Column, Column], address: tuple[Column, Column], district: tuple[Column, Column], digits: tuple[Column, Column]) -> Column:
    """0 to 100. Names and addresses are normalised before; ``digits`` are the digit groups of the addresses as they
    were. A null or empty address or district adds nothing."""
    filled = lambda pair: F.coalesce((pair[0] != "") & (pair[1] != ""), F.lit(False))
    by_address = F.when(filled(address), token_sort_ratio(*address)).otherwise(0)
    by_district = F.when(filled(district) & (F.lower(district[0]) == F.lower(district[1])), 100).otherwise(0)
    by_digits = F.when(F.coalesce(F.arrays_overlap(*digits), F.lit(False)), 100).otherwise(0)
    return score_of(name_ratio(*name), by_address, by_district == 100, by_digits == 100)


def score_of(name: Column, address: Column, same_district: Column, shared_digits: Column) -> Column:
    """The weighted score of a name's and an address's ratio, and of what agrees."""
    whole = lambda flag: F.when(flag, 100).otherwise(0)
    return WEIGHTS["name"] * name + WEIGHTS["address"] * address + WEIGHTS["district"] * whole(same_district) + WEIGHTS["digits"] * whole(shared_digits)
