"""Candidate pairs of alike names from an inverted index: every pair of a sufficient name ratio is among them.

A ratio of at least r needs twice as many characters in common as r of both lengths, so of one name's characters (numbered,
so that equal ones are told apart) at least r / (2 - r) are the other's. Put all characters in one order, the rarest first:
two such names share ``k`` characters of their first few, all but that share and ``k`` more. The keys are the sets of
``k`` characters of those few, two or three by how strict r is. A token-set ratio may also rest on the shared tokens alone,
which then make up at least that share of one side: a token from the beginning of that side's own tokens, the
rarest first, is among all tokens of the other.

Names are paired within a scope (a district, a number, or one for all), and only distinct names are: a name of many rows is
tried once. As pairs meet, their lengths and 64-bit parity sketches of their characters rule most of them out: names of r have
at most 1 - r of both lengths in characters that aren't in common, and the sketches differ in no more bits. The bounds of
``similarity`` go over what is left before any ratio is made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import name_bound, parts
from ..sources.shared import written

#: What is left for rounding between a ratio and its bounds.
SLACK = 1e-6
#: Least ratios for keys of two and of three characters: below, names too short to share as many could be alike.
BY_TWO, BY_THREE = 0.67, 0.81


def _rounded_down(threshold: float) -> float:
    """The least ratio that is rounded to the threshold or more."""
    return (threshold - 0.5) / 100 - SLACK


def _combinations(elements: Column, k: int) -> Column:
    """The hashes of all sets of ``k`` elements of a sorted array."""
    after = lambda x, i: F.slice(x, i + 2, F.greatest(F.size(x) - i - 1, F.lit(0)))
    if k == 2:
        return F.flatten(F.transform(elements, lambda a, i: F.transform(after(elements, i), lambda b: F.xxhash64(a, b))))
    return F.flatten(F.transform(elements, lambda a, i: F.flatten(F.transform(after(elements, i), lambda b, j: F.transform(after(elements, i + j + 1), lambda d: F.xxhash64(a, b, d))))))


def _first_tokens(tokens: Column, share: float) -> Column:
    """Of tokens, rarest first, those from which on the rest is still long enough to be the shared share."""
    weight = lambda xs: F.aggregate(xs, F.lit(0), lambda n, t: n + F.char_length(t) + 1) - 1
    return F.filter(tokens, lambda t, i: weight(F.slice(tokens, i + 1, F.size(tokens))) >= F.lit(share) * weight(tokens))


def _sketch(chars: Column) -> Column:
    """A long whose bits are the parities of the characters that fall on them."""
    return F.aggregate(chars, F.lit(0).cast("long"), lambda bits, x: bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(x), F.lit(64)).cast("int"))))


def indexed(names: DataFrame, others: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For the distinct, non-empty names (``name``) of two tables: ``name, own`` (the ``parts``), ``chars`` (of the sorted tokens
    and of the distinct ones) and ``tokens``, each in one order for both tables, rarest first."""
    c = F.col
    both = names.select("name", F.lit(0).alias("side")).unionByName(others.select("name", F.lit(1).alias("side"))).where("name <> ''").distinct()
    told = written(both.withColumn("own", parts("name")), "name-parts")
    lists = {"sort": F.transform("own.sort_chars", lambda x: x.cast("string")), "set": F.transform("own.set_chars", lambda x: x.cast("string")), "token": c("own.tokens")}
    lists["set"] = F.when(F.size("own.set_chars") < F.size("own.sort_chars"), lists["set"])  # of a token said twice
    each = [told.select("name", "side", F.lit(kind).alias("kind"), F.explode(values).alias("x")) for kind, values in lists.items()]
    flat = written(each[0].unionByName(each[1]).unionByName(each[2]), "name-elements")
    often = flat.groupBy("kind", "x").agg(F.count(F.lit(1)).alias("n"))
    # The two kinds of characters have one order.
    chars = often.where("kind <> 'token'").groupBy("x").agg(F.sum("n").alias("n"))
    ranks = often.where("kind = 'token'").unionByName(chars.withColumn("kind", F.lit("sort"))).unionByName(chars.withColumn("kind", F.lit("set")))
    ordered = flat.join(ranks, ["kind", "x"]).groupBy("name", "side", "kind").agg(F.transform(F.sort_array(F.collect_list(F.struct("n", "x"))), lambda e: e["x"]).alias("xs"))
    wide = ordered.groupBy("name", "side").agg(*(F.first(F.when(c("kind") == kind, c("xs")), ignorenulls=True).alias(kind) for kind in lists))
    whole = written(told.join(wide, ["name", "side"], "left"), "names-indexed")
    return tuple(whole.where(c("side") == k).drop("side") for k in (0, 1))


def alike(left: DataFrame, right: DataFrame, scopes: DataFrame, other_scopes: DataFrame, threshold: float) -> DataFrame:
    """``name, other``: all pairs that share a scope (``name, scope``) and whose name ratio may be ``threshold`` or more, from names as
    ``indexed`` gives them. Without scopes in common there are none."""
    r = _rounded_down(threshold)
    share, k = r / (2 - r), 3 if r >= BY_THREE else 2
    c = F.col

    def postings(names: DataFrame, own: DataFrame) -> tuple[DataFrame, DataFrame]:
        """``scope, key, name`` for what is shared as such, and for the tokens of either part."""
        first = lambda chars: F.slice(chars, F.lit(1), F.least(F.size(chars), F.size(chars) - F.ceil(F.lit(share) * F.size(chars) - SLACK).cast("int") + k))
        none = F.array().cast("array<string>")
        equal = lambda xs: F.array(F.xxhash64(F.lit("="), F.array_sort(xs)))
        told = names.join(own, "name")

        def of(kind: str) -> DataFrame:
            xs = F.coalesce(c("sort"), none) if kind == "sort" else c("set")
            rows = told.withColumn("xs", xs).where("xs IS NOT NULL").select("name", "scope", F.size("xs").alias("size"), _sketch(c("xs")).alias("sketch"), "xs")
            keys = F.array_distinct(F.concat(_combinations(F.array_sort(first(c("xs"))), k), equal(c("xs"))))
            return rows.select("name", "scope", "size", "sketch", F.explode(keys).alias("key"))

        mine = F.coalesce(c("token"), none)
        tokens = told.select("name", "scope", mine.alias("all"), _first_tokens(mine, share).alias("first"))
        tokens = tokens.select("name", "scope", F.explode(F.transform("all", lambda t: F.struct(t.alias("key"), F.array_contains("first", t).alias("leads")))).alias("t")).select("name", "scope", "t.*")
        return of("sort").unionByName(of("set")), written(tokens, "name-tokens")

    (a, a_tokens), (b, b_tokens) = postings(left, scopes), postings(right, other_scopes)
    meeting = lambda one, two: one.join(two.select("scope", "key", c("name").alias("other")), ["scope", "key"]).select("name", "other")
    apart = F.bit_count(c("sketch").bitwiseXOR(c("other_sketch")))
    met = a.join(b.withColumnsRenamed({x: f"other_{x}" for x in ("size", "sketch")} | {"name": "other"}), ["scope", "key"])
    near = met.where(apart <= F.lit(1 - r) * (c("size") + c("other_size")) + SLACK).select("name", "other")
    by_token = meeting(a_tokens.where("leads"), b_tokens).unionByName(meeting(a_tokens, b_tokens.where("leads")))
    pairs = written(near.unionByName(by_token).distinct(), "name-pairs")
    return _bounded(pairs, left, right, threshold)


def within(left: DataFrame, right: DataFrame, scopes: DataFrame, other_scopes: DataFrame, threshold: float) -> DataFrame:
    """The same without an index: all pairs of a scope that pass the bounds, for thresholds that keys can't serve."""
    pairs = written(scopes.join(other_scopes.withColumnRenamed("name", "other"), "scope").select("name", "other").distinct(), "scope-pairs")
    return _bounded(pairs, left, right, threshold)


def _bounded(pairs: DataFrame, left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    own, others = left.select("name", "own"), right.select(F.col("name").alias("other"), F.col("own").alias("others"))
    return pairs.join(own, "name").join(others, "other").where(name_bound(F.col("own"), F.col("others")) >= F.lit(threshold - SLACK)).select("name", "other")


def candidates(left: DataFrame, right: DataFrame, scopes: DataFrame, other_scopes: DataFrame, threshold: float) -> DataFrame:
    """``alike`` where the threshold allows for keys, else ``within``; nothing reaches more than 100."""
    if threshold > 100:
        return scopes.select("name", F.col("name").alias("other")).limit(0)
    return (alike if _rounded_down(threshold) >= BY_TWO else within)(left, right, scopes, other_scopes, threshold)
