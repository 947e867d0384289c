"""Order MinHash fingerprints: signatures that follow edit distance, with DataFrame functions alone.

A text is a sequence of tokens: runs without white space, but every character from U+0800 on is a token of its own, as
such scripts don't part words. Its k-mers are numbered by occurrence, so that a repeated k-mer is a new element each
time. Each of ``orders`` orders selects its ``tuple_size`` least; they are put back in text order, and the tuple is hashed: one
component of the signature. Likeness is the share of equal components.

An order is by hash XOR a seeded mask. Every element is as likely as any other to be the least of it, and the least need not be
sought among all: elements that share leading bits with the mask come before the others, and stand together once
elements are sorted by hash. So each order takes two binary searches and a look at the few elements in between; where
they are too few, at all. Orders of one hash aren't fully independent: that matters where a text has fewer elements
than there are orders, whose likeness is then told in coarser steps.

Every step is a function of one row's arrays; no rows are multiplied and nothing is shuffled. While k-mers are
numbered, an element is a long: 36 bits of hash above 28 bits of position, which is more than an array of longs can have
elements. Elements of equal hashes come in the order of their places.

Defined cases: a null text counts as empty; texts without tokens share one fingerprint; texts of fewer than ``k``
tokens have one k-mer, all of them; a text with fewer elements than ``tuple_size`` has them all in each tuple; equal and
repeated rows have equal fingerprints; other columns pass through and an existing output column is replaced; an empty
table gives no rows.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Tokens of a k-mer; k-mers of a tuple; orders, that is components of a signature.
K, TUPLE_SIZE, ORDERS = 2, 2, 32
POSITION_BITS = 28
_PLACE = (1 << POSITION_BITS) - 1
_HASH = ~_PLACE
_WHITE = " \t\n\x0b\f\r"


def tokens(text: Column) -> Column:
    """The tokens of a text that isn't null; none of white space alone."""
    alone = F.regexp_replace(text, r"[\x{800}-\x{10FFFF}]", " $0 ")
    parted = F.btrim(F.when(F.octet_length(text) == F.char_length(text), text).otherwise(alone), F.lit(_WHITE))
    return F.when(parted == "", F.array().cast("array<string>")).otherwise(F.split(parted, r"[ \t-\r]+"))


def _hash_of(element: Column) -> Column:
    return F.shiftright(element, POSITION_BITS)


def _element(hashed: Column, place: Column) -> Column:
    return hashed.bitwiseAND(F.lit(_HASH)).bitwiseOR(place)


def _steps(count: Column) -> Column:
    """The powers of two up to ``count``, greatest first, for searching ``count`` sorted elements bit by bit."""
    return F.filter(F.array(*(F.lit(1 << b) for b in reversed(range(31)))), lambda step: step <= count)


def _numbered(mers: str) -> Column:
    """Sorted elements with their k-mers numbered: the first of equal ones stays, later ones are hashed anew."""
    same = lambda p, back: _hash_of(F.get(F.col(mers), p - back)) == _hash_of(F.get(F.col(mers), p))

    def before(p: Column) -> Column:
        # How many equal elements stand before place p: bit by bit, as equal ones stand together.
        return F.aggregate(_steps(p), F.lit(0), lambda n, step: F.when(same(p, n + step), n + step).otherwise(n))

    def number(x: Column, p: Column) -> Column:
        repeated = _hash_of(x) == _hash_of(F.get(F.col(mers), p - 1))
        few = F.when(~F.coalesce(same(p, 2), F.lit(False)), 1).when(~F.coalesce(same(p, 3), F.lit(False)), 2).otherwise(before(p))
        return F.when(repeated, _element(F.xxhash64(_hash_of(x), few), x.bitwiseAND(F.lit(_PLACE)))).otherwise(x)

    return F.transform(F.col(mers), number)


def masks(orders: int) -> list[int]:
    """The orders' masks: random hash bits, and the sign bit turned over, so that signed longs compare as unsigned ones."""
    r = random.Random("orders")
    found = [(r.getrandbits(64) & ~_PLACE) ^ (1 << 63) for _ in range(orders)]
    return [m - (1 << 64) if m >> 63 else m for m in found]


def _let(value: Column, then) -> Column:
    """``then`` of a value that is made once."""
    return F.get(F.transform(F.array(value), then), 0)


def _before(placed: Column, n: Column, bound: Column) -> Column:
    """How many of ``n`` sorted elements are less than ``bound``."""
    return F.aggregate(_steps(n), F.lit(0), lambda at, step: F.when(F.get(placed, at + step - 1) < bound, at + step).otherwise(at))


def _nearest(placed: Column, low: Column, mask: Column, tuple_size: int) -> Column:
    """Elements among which are the ``tuple_size`` least by hash XOR the mask, as values of that order: those that share the
    leading bits that ``low`` (a long with these bits set) has with the mask; all, where these are too few or ``low`` is 0."""
    signed = mask.bitwiseXOR(F.lit(-(1 << 63)))
    least = signed.bitwiseAND(low)
    after = lambda first: _before(placed, F.size(placed), least.bitwiseOR(F.bitwise_not(low)).cast("long")) - first
    share = _let(_before(placed, F.size(placed), least), lambda first: F.slice(placed, first + 1, after(first)))
    found = F.when(low == 0, placed).otherwise(_let(share, lambda some: F.when(F.size(some) >= tuple_size, some).otherwise(placed)))
    return F.transform(found, lambda e: e.bitwiseXOR(mask))


def _component(values: Column, tuple_size: int) -> Column:
    """The hash of the ``tuple_size`` least values, in the order of their places."""
    place = lambda x: x.bitwiseAND(F.lit(_PLACE))

    def pick(left: Column, taken: list[Column]) -> Column:
        if len(taken) == tuple_size:
            return in_order(taken)
        # Where no value is left the tuple ends: the least one stands in, and falls together with itself.
        return _let(F.coalesce(F.array_min(left), taken[0] if taken else F.lit(None).cast("long")), lambda least: pick(F.array_remove(left, least), [*taken, least]))

    def in_order(taken: list[Column]) -> Column:
        if len(taken) == 2:
            one, other = taken
            return F.when(place(one) <= place(other), F.xxhash64(_hash_of(one), _hash_of(other))).otherwise(F.xxhash64(_hash_of(other), _hash_of(one)))
        placed = F.array_sort(F.array_distinct(F.array(*(F.struct(place(x).alias("place"), _hash_of(x).alias("value")) for x in taken))))
        return F.xxhash64(F.transform(placed, lambda x: x["value"]))

    return pick(values, [])


def signature(df: DataFrame, text_col: str, out_col: str, k: int = K, tuple_size: int = TUPLE_SIZE, orders: int = ORDERS) -> DataFrame:
    """Add ``out_col``, an array of ``orders`` 31-bit components (empty for a text without tokens)."""
    words, mers, placed, low = (f"__{out_col}_{x}" for x in ("words", "mers", "placed", "low"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    place = lambda i: i.cast("long")
    if k == 1:
        packed = F.transform(tokens(text), lambda t, i: _element(F.xxhash64(t), place(i)))
    else:
        df = df.withColumn(words, F.transform(tokens(text), lambda t: F.xxhash64(t)))
        whole = F.transform(F.col(words), lambda h, i: _element(F.xxhash64(h, *(F.get(F.col(words), i + o) for o in range(1, k))), place(i)))
        packed = F.slice(whole, F.lit(1), F.greatest(F.size(words) - (k - 1), F.least(F.size(words), F.lit(1))))
    df = df.withColumn(mers, F.sort_array(packed)).drop(words)
    df = df.withColumn(placed, F.sort_array(_numbered(mers))).drop(mers)
    # So many leading bits that some eight to sixteen elements share them with a mask.
    bits = F.greatest(F.floor(F.log2(F.greatest(F.size(placed), F.lit(1)).cast("double"))) - 3, F.lit(0)).cast("int")
    df = df.withColumn(low, F.when(bits > 0, F.call_function("shiftleft", F.lit(-1).cast("long"), 64 - bits)).otherwise(F.lit(0).cast("long")))
    each = F.transform(F.array(*(F.lit(m).cast("long") for m in masks(orders))), lambda m: _let(_nearest(F.col(placed), F.col(low), m, tuple_size), lambda v: _component(v, tuple_size)).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"))
    return df.withColumn(out_col, F.when(F.size(placed) > 0, each).otherwise(F.array().cast("array<int>"))).drop(placed, low)


def fingerprint(components: Column) -> Column:
    """A signature as text: eight hexadecimal digits for each component."""
    return F.array_join(F.transform(components, lambda c: F.lpad(F.lower(F.hex(c)), 8, "0")), "")


def likeness(one: Column, other: Column) -> Column:
    """The share of equal components, 0 to 1: of two texts without tokens 1, of one such text and another 0."""
    equal = F.size(F.filter(F.zip_with(one, other, lambda a, b: a.eqNullSafe(b)), lambda same: same))
    return F.when((F.size(one) == 0) & (F.size(other) == 0), F.lit(1.0)).otherwise(equal / F.greatest(F.size(one), F.size(other)))


def with_next(docs: DataFrame, columns: list[str], id_col: str = "doc_id", blocks: int | None = None) -> DataFrame:
    """Add ``next_<column>`` of the row that follows by ascending id; after the last comes the first.

    Ids are cut into ranges at about even quantiles, so each range is one window of its own, and the first rows of a
    range are sent to the end of the range before as well. Rows of equal ids follow each other in the order of
    ``columns``. Rows without an id stand in no order: their next columns are null.
    """
    spark = docs.sparkSession
    blocks = blocks or 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = docs.where(F.col(id_col).isNotNull())
    # Quantiles are doubles, which can't tell long ids apart; the least id from each one on is an id that there is.
    about = sorted(set(known.stat.approxQuantile(id_col, [k / blocks for k in range(blocks)], 0.2 / blocks)))
    above = F.size(F.filter(F.array(*map(F.lit, about)), lambda c: c <= F.col(id_col).cast("double")))
    cuts = sorted(r["least"] for r in known.groupBy(above).agg(F.min(id_col).alias("least")).collect()) if about else []
    if not cuts:
        return docs.withColumns({f"next_{c}": F.lit(None).cast(docs.schema[c].dataType) for c in columns})
    edges = F.array(*map(F.lit, cuts))
    block = F.size(F.filter(edges, lambda c: c <= F.col(id_col))) - 1
    before = F.pmod(F.col("__block") - 1, F.lit(len(cuts)))
    # A range's first row stands also at the end of the range before; the only range's first row at its own end.
    lap = F.when(F.array_contains(edges, F.col(id_col)), F.array(F.struct(F.col("__block").alias("b"), F.lit(0).alias("carried")), F.struct(before.alias("b"), F.lit(1).alias("carried"))))
    dealt = known.withColumn("__block", block).withColumn("__at", F.explode(F.coalesce(lap, F.array(F.struct(F.col("__block").alias("b"), F.lit(0).alias("carried"))))))
    order = Window.partitionBy("__range").orderBy("__carried", id_col, *columns)
    flat = dealt.withColumns({"__range": F.col("__at.b"), "__carried": F.col("__at.carried")}).drop("__at", "__block")
    found = flat.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns}).where("__carried = 0").drop("__range", "__carried")
    unknown = docs.where(F.col(id_col).isNull()).withColumns({f"next_{c}": F.lit(None).cast(docs.schema[c].dataType) for c in columns})
    return found.unionByName(unknown)


def edit_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row its signature, that of its edited text (the last quarter replaced by the next text's start), and
    that of the next text: ``id_col, n_chars, edited, signature, edited_signature, next_signature``."""
    own = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    signed = with_next(signature(own, "text", "signature"), ["text", "signature"], id_col)
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - quarter), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), quarter))
    found = signed.select(id_col, n.cast("long").alias("n_chars"), edited.alias("edited"), "signature", F.coalesce("next_signature", F.array().cast("array<int>")).alias("next_signature"))
    return signature(found, "edited", "edited_signature")


