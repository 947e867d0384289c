"""Components of verified links among texts that share keys, without all pairs of a key's group.

``postings`` says which nodes hold which key. Two nodes can be linked only if they share a key. Hub rounds try every
node of a key against two hubs chosen at random for that key, which is linear in the postings, and verify for each node the nearest by sketch; a last round tries all
that is left: pairs of a key whose nodes still lie in different components. Before texts are fetched, pairs must pass
a size bound, a bound from where the shared key stands among their ordered elements, and a parity-sketch bound, all of
which every link passes. Joins whose sides grow with the input are merge joins at every size, so plans don't change
with it. So each link between nodes of different components is verified, and none is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import absorbed
from .scratch import HASHED_ID_BYTES, fits_broadcast, materialise, released, trimmed
from .shingles import SLICE_CHARS, WIDTH, exact_sets, mix

#: Jaccard similarity of links, in percent.
PERCENT = 80
HUB_ROUNDS = 2
#: Longs of the smallest parity sketch.
SKETCH_LONGS = 16


def parity_sketch(elements: np.ndarray) -> np.ndarray:
    """Longs whose bits are the parities of the elements that fall on them, at least twice as many bits as elements.

    Sketches of two sets differ in no more bits than the sets differ in elements. One of twice the length is compared
    after its halves have been laid over each other.
    """
    bits = max(SKETCH_LONGS * 64, 1 << (2 * len(elements) - 1).bit_length() if len(elements) else 0)
    place = mix(elements ^ np.uint64(0x5851F42D4C957F2D)) & np.uint64(bits - 1)
    return np.packbits((np.bincount(place.astype(np.int64), minlength=bits) & 1).astype(np.uint8)).view("<i8")


def prefix_length(size: int, percent: int = PERCENT) -> int:
    """Elements of which two sets of such similarity share at least one, when sets are put in one order."""
    return size - -(-percent * size // 100) + 1 if size else 0


def size_bound(a: Column, b: Column, percent: int = PERCENT) -> Column:
    return F.lit(100) * F.least(a, b) >= F.lit(percent) * F.greatest(a, b)


def unequal_bound(a: Column, b: Column, percent: int = PERCENT) -> Column:
    """Sets that aren't equal differ in two elements at least where their sizes are the same."""
    return (a != b) | (F.lit(2 * (100 + percent)) <= F.lit(100 - percent) * (a + b))


def overlap_bound(a: Column, b: Column, place_a: Column, place_b: Column, percent: int = PERCENT) -> Column:
    """Whether the elements from the first shared one on suffice for the overlap that a link needs."""
    most = 1 + F.least(a - place_a - 1, b - place_b - 1)
    return most * F.lit(100 + percent) >= F.lit(percent) * (a + b)


def differing_bits(one: Column, other: Column) -> Column:
    """Null for sketches of other lengths than one or two times each other's, which no linked sets have."""
    folded = lambda x: F.zip_with(F.slice(x, F.lit(1), (F.size(x) / 2).cast("int")), F.slice(x, (F.size(x) / 2 + 1).cast("int"), (F.size(x) / 2).cast("int")), lambda p, q: p.bitwiseXOR(q))
    even = lambda x, y: F.when(F.size(x) == F.size(y), x).when(F.size(x) == 2 * F.size(y), folded(x)).when(2 * F.size(x) == F.size(y), x)
    one, other = even(one, other), even(other, one)
    return F.aggregate(F.zip_with(one, other, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, x: total + x)


def sketch_bound(a: Column, b: Column, differing: Column, percent: int = PERCENT) -> Column:
    return F.coalesce(differing * F.lit(100 + percent) <= F.lit(100 - percent) * (a + b), F.lit(True))


def small_side(df: DataFrame, row_bytes: int = HASHED_ID_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows are few enough."""
    return F.broadcast(df) if fits_broadcast(df.count(), row_bytes) else df


def verified(pairs: DataFrame, texts: Callable[[DataFrame], DataFrame], percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """Of the pairs ``a, b`` those whose texts link: exact Jaccard of their shingle sets. ``texts`` gives ``node, text``
    for a table of nodes. Further columns, which are longs, pass through."""
    ends = [pairs.select(F.col(x).alias("node"), F.lit(x == "a").alias("as_a"), F.lit(x == "b").alias("as_b")) for x in "ab"]
    involved = materialise(ends[0].unionByName(ends[1]).groupBy("node").agg(F.max("as_a").alias("as_a"), F.max("as_b").alias("as_b")), "involved")
    held = materialise(texts(small_side(involved.select("node"))).select("node", "text"), "involved-texts")
    # A text goes to the side that asks for it alone: hubs, which many pairs share, are few.
    side = lambda x: held.toDF(x, f"text_{x}").join(small_side(involved.where(f"as_{x}").select(F.col("node").alias(x))), x, "left_semi")
    own = ["a", "b", *(c for c in pairs.columns if c not in ("a", "b"))]
    both = pairs.join(side("b").hint("merge"), "b").join(side("a").hint("merge"), "a")

    def linked(rows: list[tuple]) -> pa.RecordBatch:
        sets = list(exact_sets([t for row in rows for t in row[-2:]], width))
        keep = []
        for row, x, y in zip(rows, sets[::2], sets[1::2], strict=True):
            shared = len(np.intersect1d(x, y, assume_unique=True))
            if len(x) and len(y) and 100 * shared >= percent * (len(x) + len(y) - shared):
                keep.append(row)
        return pa.RecordBatch.from_arrays([pa.array([row[k] for row in keep], pa.int64()) for k in range(len(own))], own)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for row in zip(*(batch.column(c).to_pylist() for c in (*own, "text_a", "text_b")), strict=True):
                held.append(row)
                size += sum(len(t or "") for t in row[-2:])
                if size >= SLICE_CHARS:
                    yield linked(held)
                    held, size = [], 0
            if held:
                yield linked(held)

    return both.select(*own, "text_a", "text_b").mapInArrow(lambda batches: trimmed(run(batches)), ", ".join(f"{c} bigint" for c in own))


def linked_components(postings: DataFrame, nodes: DataFrame, texts: Callable[[DataFrame], DataFrame], percent: int = PERCENT, width: int = WIDTH, hub_rounds: int = HUB_ROUNDS) -> DataFrame:
    """``node, component`` (least node) for every node that shares a key or a group with another.

    ``postings``: ``key, grp, size, place`` (where the key stands among the group's ordered elements); ``nodes``:
    ``node, grp, size, sketch``, no two of the same set, where nodes of equal sizes and prefixes form a group named after one of them;
    ``texts`` gives ``node, text`` for a table of nodes. A sketch is an array of longs, or one
    long; a null one bounds nothing. A group posts a key once.
    """
    with released(nodes.sparkSession) as keep:
        return keep(_linked(postings, nodes, texts, percent, width, hub_rounds)).select("node", F.col("comp").alias("component"))


def _linked(postings: DataFrame, nodes: DataFrame, texts: Callable[[DataFrame], DataFrame], percent: int, width: int, hub_rounds: int) -> DataFrame:
    # A key that two alone hold is of no use where their sizes rule a link out.
    use = (F.count(F.lit(1)) > 1) & ((F.count(F.lit(1)) > 2) | size_bound(F.min("size"), F.max("size"), percent))
    lists = materialise(postings.groupBy("key").agg(use.alias("use")).where("use").select("key"), "shared-keys")
    shared = materialise(postings.join(lists.hint("merge"), "key").select("key", "grp", "size", "place"), "postings")
    met = shared.select("grp").unionByName(nodes.where("node <> grp").select("grp")).distinct()
    nodes = materialise(nodes.join(small_side(materialise(met, "met")), "grp", "left_semi").dropDuplicates(["node"]), "nodes")
    single = isinstance(nodes.schema["sketch"].dataType, T.LongType)
    differ = (lambda x, y: F.bit_count(x.bitwiseXOR(y))) if single else differing_bits
    state = nodes.select("node", "grp", F.col("node").alias("comp"))

    def nearest(pairs: DataFrame, held: DataFrame) -> DataFrame:
        """Of the distinct pairs across components that pass the size and sketch bounds the nearest by sketch for each
        ``a`` (the others are left to later rounds, should they still lie apart)."""
        a, b = (held.select(*(F.col(c).alias(f"{c}_{side}") for c in held.columns)) for side in "ab")
        both = pairs.distinct().join(a.hint("merge"), F.col("a") == F.col("node_a")).join(b.hint("merge"), F.col("b") == F.col("node_b"))
        c = F.col
        close = both.where((c("comp_a") != c("comp_b")) & size_bound(c("size_a"), c("size_b"), percent)).withColumn("bits", differ(c("sketch_a"), c("sketch_b")))
        passed = close.where(sketch_bound(c("size_a"), c("size_b"), c("bits"), percent)).select("a", "bits", "b", "comp_a", "comp_b")
        best = passed.groupBy("a", "comp_a").agg(F.min(F.struct("bits", "b", "comp_b")).alias("best"))
        return materialise(best.select("a", "best.b", "comp_a", "best.comp_b"), "pairs")

    def merged(pairs: DataFrame) -> DataFrame:
        """The state after the pairs that link have been merged."""
        links = materialise(verified(pairs, texts, percent, width), "links")
        roots = absorbed(links.select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b"))).toDF("comp", "root")
        return materialise(state.join(small_side(roots), "comp", "left").select("node", "grp", F.coalesce("root", "comp").alias("comp")), "state")

    for k in range(hub_rounds):
        # Components of groups: two of a key's groups, or two nodes of a group, may still lie apart.
        # At first every node is its own.
        tagged = shared.join(state.where("node = grp").select("grp", "comp").hint("merge"), "grp") if k else shared.withColumn("comp", F.col("grp"))
        held = nodes.join(state.select("node", "comp").hint("merge"), "node") if k else nodes.withColumn("comp", F.col("node"))
        mask = F.xxhash64("key", F.lit(k))
        hubs = tagged.groupBy("key").agg(F.min(F.col("grp").bitwiseXOR(mask)).alias("one"), F.max(F.col("grp").bitwiseXOR(mask)).alias("two"), F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
        tried = tagged.join(hubs.hint("merge"), "key").select("grp", F.explode(F.array(F.col("one").bitwiseXOR(mask), F.col("two").bitwiseXOR(mask))).alias("hub")).where("grp <> hub")
        pairs = tried.select(F.col("grp").alias("a"), F.col("hub").alias("b"))
        if k == 0:
            pairs = pairs.unionByName(state.where("node <> grp").select(F.col("node").alias("a"), F.col("grp").alias("b")))
        state = merged(nearest(pairs, held.select("node", "comp", "size", "sketch")))
    with released(nodes.sparkSession) as keep:
        members = shared.join(state.hint("merge"), "grp").select("key", "node", "comp", "size", "place")
        # Nodes of one group share all its keys: the group's name serves as one more key.
        within = nodes.join(state.select("node", "comp").hint("merge"), "node").select(F.xxhash64(F.lit("group"), "grp").alias("key"), "node", "comp", "size", F.lit(0).alias("place"))
        members = materialise(members.unionByName(within), "members")
        split = members.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("key")
        left = keep(materialise(members.join(split.hint("merge"), "key").join(nodes.select("node", "sketch").hint("merge"), "node"), "left"))
    a, b = (left.select("key", *(F.col(c).alias(f"{c}_{side}") for c in ("node", "comp", "size", "place", "sketch"))) for side in "ab")
    c = F.col
    met = (a["key"] == b["key"]) & (c("node_a") < c("node_b")) & (c("comp_a") != c("comp_b")) & size_bound(c("size_a"), c("size_b"), percent) & unequal_bound(c("size_a"), c("size_b"), percent) & overlap_bound(c("size_a"), c("size_b"), c("place_a"), c("place_b"), percent)
    met = met & sketch_bound(c("size_a"), c("size_b"), differ(c("sketch_a"), c("sketch_b")), percent)
    rest = a.join(b, met).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), "comp_a", "comp_b").distinct()
    state = merged(materialise(rest, "pairs"))
    return state
