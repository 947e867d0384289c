"""Text: slugs, addresses of pages, normalised names, parsed addresses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .clean import strip

# Abbreviations and what they stand for, in the order in which they are replaced.
NAME_WORDS = [
    ("bldg", "building"), ("ctr", "center"), ("centre", "center"), ("plz", "plaza"), ("twr", "tower"), ("indl", "industrial"),
    ("comm", "commercial"), ("ltd", "limited"), ("hse", "house"), ("intl", "international"), ("dev", "development"),
    ("fty", "factory"), ("gdn", "garden"), ("rd", "road"), ("st", "street"), ("ave", "avenue"),
]
# As above, for addresses. They are patterns: the dot stands for any character.
ADDRESS_PATTERNS = [("rd", "road"), ("rd.", "road"), ("st", "street"), ("st.", "street"), ("ave", "avenue"), ("ave.", "avenue")]
# What marks the parts of an address, tried in this order.
ADDRESS_KEYS = {
    "Phase": ["Phase", "Site", "(Block"],
    "Tower/Block": ["Tower", "Block", "Path", "Street", "Browdway", "Celestial Avenue", "Carpark", "Road", "Lane", "Drive", "Vista Avenue", "Mansion", "House", "Sky One"],
    "Floor": ["Floor", "/F", "LG", "B/M", "U/L", "UCP", "P3", "P2", "Podium", "PODIUM", "U/G", "P7", "P4", "UG1"],
    "Flat": ["Flat", "Apartment", "Duplex"],
}
FLOOR_TYPES = ["Upper Floor", "Middle Floor", "Lower Floor"]
PART_MARK = "・"


def slug(text: Column) -> Column:
    """Lower case, every run of what isn't A-Z, a-z, 0-9 one hyphen, none at the ends."""
    return F.lower(F.regexp_replace(F.regexp_replace(text, "[^A-Za-z0-9]+", "-"), "^-+|-+$", ""))


def slug_lower_first(text: Column) -> Column:
    """As ``slug``, lower-cased before, so capitals outside A-Z that lower to a-z count as letters."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def slug_spaces(text: Column) -> Column:
    """Apostrophes go, runs of white space become hyphens."""
    return F.regexp_replace(strip(F.replace(text, F.lit("'"), F.lit(""))), r"(?U)\s+", "-")


def slug_words(text: Column) -> Column:
    """White space becomes hyphens, what is neither a word character nor a hyphen goes, hyphens in a row are one."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"(?U)\s+", "-"), r"(?U)[^\w\-]", ""), "-+", "-")


def lower_without_spaces(text: Column, by: str = "-") -> Column:
    return F.lower(F.replace(text, F.lit(" "), F.lit(by)))


def join_list(items: Column) -> Column:
    """Comma-joined; a null array gives ``''``."""
    return F.concat_ws(", ", items)


def building_page(base: str, zone: Column, district: Column, building: Column, tail: Column) -> Column:
    """The page of a building: base, then zone (left out where null), district and building as slugs, then an id."""
    return F.concat(F.lit(base), F.concat_ws("-", slug_lower_first(zone), slug_lower_first(district), slug_lower_first(building)), F.lit("_"), tail.cast("string"))


def typed_page(base: str, kind: Column, name: Column, tail: Column) -> Column:
    return F.concat(F.lit(base), F.lower(kind), F.lit("/"), slug_spaces(name), F.lit("-"), tail.cast("string"))


def id_in_address(url: Column) -> Column:
    """The first B with digits after it; null where there is none."""
    return F.nullif(F.regexp_extract(url, r"B\d+", 0), F.lit(""))


def digit_groups(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"\d+"), F.lit(0))


def sale_or_rent(markup: Column, marker: str) -> Column:
    """``S`` where the markup has the marker, else ``L`` (null too)."""
    return F.when(F.contains(markup, F.lit(marker)), "S").otherwise("L")


def joined_links(labels: Column) -> Column:
    """The first two labels with a bar between, of two or more; else the first one."""
    return F.when(F.size(labels) >= 2, F.concat_ws(" | ", F.slice(labels, 1, 2))).otherwise(F.get(labels, 0))


def key_of(*parts: Column) -> Column:
    """Parts joined by underscores; null where any is null."""
    return F.concat(*(x for k, p in enumerate(parts) for x in ([F.lit("_")] if k else []) + [p.cast("string")]))


def _words(text: Column) -> Column:
    """Lower-cased runs of word characters. ASCII is split by a pattern of its own, which is many times faster."""
    low = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    plain = F.octet_length(low) == F.char_length(low)
    spaced = F.when(plain, F.regexp_replace(low, "[^a-z0-9_]+", " ")).otherwise(F.regexp_replace(low, r"(?U)\W+", " "))
    return F.split(F.trim(spaced), " ")


def _replaced(words: Column, by) -> Column:
    return F.array_join(F.transform(words, by), " ")


def normal_name(text: Column) -> Column:
    """A building name for comparison: lower case, abbreviations written out, no punctuation. Null gives ``''``."""
    names = F.create_map(*(F.lit(x) for pair in NAME_WORDS for x in pair))
    return _replaced(_words(text), lambda w: F.when(w.isin([a for a, _ in NAME_WORDS]), F.try_element_at(names, w)).otherwise(w))


def normal_address(text: Column) -> Column:
    """An address for comparison; null gives ``''``. A pattern's dot stands for any character of the word."""
    short = {a: b for a, b in ADDRESS_PATTERNS if "." not in a}
    starts = [(a.rstrip("."), len(a), b) for a, b in ADDRESS_PATTERNS if "." in a]

    def by(w: Column) -> Column:
        found = w
        for start, length, full in reversed(starts):
            found = F.when(w.startswith(start) & (F.char_length(w) == length), full).otherwise(found)
        for word, full in short.items():
            found = F.when(w == word, full).otherwise(found)
        return F.when(F.char_length(w) > max(n for _, n, _ in starts), w).otherwise(found)

    return _replaced(_words(text), by)


def _marks(part: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(part, F.lit(w)) for w in words))


def _key(part: Column) -> Column:
    found = F.lit(None).cast("string")
    for key, words in reversed(ADDRESS_KEYS.items()):
        found = F.when(_marks(part, words), F.lit(key)).otherwise(found)
    return found


def parse_address(address: Column) -> Column:
    """Struct of Building, Phase, Tower/Block, Floor, Flat, Floor_Type from an address of marked parts.

    Part 0 is the building. Of the others each belongs to the first key that one of its words is found for (with
    case); the last part of a key wins. The last part that names a floor type is Floor_Type besides. A null address
    gives nulls.
    """
    parts = F.split(address, PART_MARK)
    rest = F.slice(parts, 2, 1 << 20)
    last = lambda chosen: F.try_element_at(chosen, F.lit(-1))

    def of(key: str) -> Column:
        return last(F.filter(rest, lambda p: _key(p) == key)).alias(key)

    kind = last(F.filter(rest, lambda p: _marks(p, FLOOR_TYPES)))
    return F.struct(F.get(parts, 0).alias("Building"), *(of(k) for k in ADDRESS_KEYS), kind.alias("Floor_Type"))


def parse_address_filling(address: Column) -> Column:
    """As ``parse_address`` but exactly five parts are taken by position (no Floor_Type), and otherwise parts without a
    key fill what is empty, from left to right into Flat, Floor, Tower/Block, Phase."""
    parts = F.split(address, PART_MARK)
    by_key = parse_address(address)
    spare = F.filter(F.slice(parts, 2, 1 << 20), lambda p: _key(p).isNull() & ~_marks(p, FLOOR_TYPES))
    order = ["Flat", "Floor", "Tower/Block", "Phase"]
    empty = lambda k: by_key.getField(k).isNull()
    filled = {}
    for n, k in enumerate(order):
        before = reduce(lambda a, b: a + b, (empty(x).cast("int") for x in order[:n]), F.lit(0))
        filled[k] = F.coalesce(by_key.getField(k), F.get(spare, before))
    names = ["Building", *ADDRESS_KEYS]
    positional = F.struct(*(F.get(parts, n).alias(k) for n, k in enumerate(names)), F.lit(None).cast("string").alias("Floor_Type"))
    keyed = F.struct(by_key.getField("Building").alias("Building"), *(filled[k].alias(k) for k in ADDRESS_KEYS), by_key.getField("Floor_Type").alias("Floor_Type"))
    return F.when(F.size(parts) == 5, positional).otherwise(keyed)
