"""N-gram Jaccard join of documents, by grouped prefixes.

A document's shingles are put in one order for all documents: first those that aren't known to be frequent, by hash,
then the frequent ones, rarest first. Sets that link (Jaccard of at least 80 percent) share an element of their
prefixes, the first fifth in that order. Documents of equal sets (by keyed 128-bit digest) count as one node, nodes of equal prefixes and sizes
as one group; pairs of groups that share a prefix element are filtered, then expanded and their members verified
(see ``linking``).

Any order gives exact results; the frequent shingles only keep lists short. They are found in one pass over all
documents that adds up what is repeated within a batch, and at most ``FREQUENT`` of them, the most frequent, take
their own places in the order.

Defined cases: null, empty and word-less texts have no shingles and link with nothing; texts of fewer than five words
have one; a row without an id gets its size and a null component; rows of one id get the least component of their texts;
every row is returned, repeated ones too; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linking import PERCENT, linked_components, parity_sketch, prefix_length, small_side
from .scratch import materialise, released, trimmed
from .shingles import WIDTH, digested_sets, shingle_sets

#: Frequent shingles that have places of their own in the order (8 bytes each), and the count from which they do.
FREQUENT = 1 << 17
FREQUENT_FROM = 30


def frequent_shingles(docs: DataFrame, width: int = WIDTH, text_col: str = "text") -> np.ndarray:
    """The most frequent shingles, most frequent last (ties by hash)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(held: list[np.ndarray]) -> pa.RecordBatch:
            found, counts = np.unique(np.concatenate(held or [np.zeros(0, np.uint64)]), return_counts=True)
            again = counts > 1
            return pa.RecordBatch.from_arrays([pa.array(found[again].view(np.int64)), pa.array(counts[again])], ["key", "n"])

        held, size = [], 0
        for batch in batches:
            for s in shingle_sets(batch.column(text_col).to_pylist(), width):
                held.append(s)
                size += len(s)
                if size >= 1 << 22:  # 32 MB
                    yield told(held)
                    held, size = [], 0
        yield told(held)

    counted = docs.select(text_col).mapInArrow(lambda batches: trimmed(run(batches)), "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    top = counted.where(F.col("n") >= FREQUENT_FROM).orderBy(F.desc("n"), "key").limit(FREQUENT).collect()
    return np.array([r["key"] for r in reversed(top)], np.int64).view(np.uint64)


def prefixes(docs: DataFrame, frequent: np.ndarray, percent: int = PERCENT, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, size, set_digest, prefix_digest, sketch, prefix`` for every row."""
    by = np.argsort(frequent, kind="stable")
    shared = docs.sparkSession.sparkContext.broadcast((frequent[by], (by + 1).astype(np.int32)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = shared.value
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("size", "set_digest", "prefix_digest", "sketch", "prefix")}
            for s, digest in digested_sets(batch.column("text").to_pylist(), width):
                n = prefix_length(len(s), percent)
                first = s
                if len(known) and len(s):
                    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    late = np.where(known[at] == s, rank[at], 0)
                    if late.any():
                        first = s[np.lexsort((s, late))]
                first = first[:n]
                out["size"].append(len(s))
                out["set_digest"].append(digest)
                out["prefix_digest"].append(hashlib.blake2b(first.tobytes(), digest_size=16).digest())
                out["sketch"].append(parity_sketch(s).tobytes())
                out["prefix"].append(first.tobytes())
            flat = [pa.array(out["size"], pa.int32()), pa.array(out["set_digest"], pa.binary()), pa.array(out["prefix_digest"], pa.binary())]
            lists = []
            for c in ("sketch", "prefix"):
                values = np.frombuffer(b"".join(out[c]), np.int64)
                offsets = np.concatenate(([0], np.cumsum([len(x) // 8 for x in out[c]])))
                lists.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *flat, *lists], ["id", *out])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lambda batches: trimmed(run(batches)), "id bigint, size int, set_digest binary, prefix_digest binary, sketch array<bigint>, prefix array<bigint>")


def jaccard_components(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_shingles, component_id`` for every row of ``docs``."""
    with released(docs.sparkSession) as keep:
        return keep(_components(docs, percent, width, id_col, text_col))


def _components(docs: DataFrame, percent: int, width: int, id_col: str, text_col: str) -> DataFrame:
    sets = materialise(prefixes(docs, frequent_shingles(docs, width, text_col), percent, width, id_col, text_col), "sets")
    real = sets.where("size > 0 AND id IS NOT NULL")
    same = real.groupBy("set_digest").agg(F.min("id").alias("node"), F.first("size").alias("size"), F.first("prefix_digest").alias("prefix_digest"))
    grouped = same.groupBy("prefix_digest", "size").agg(F.min("node").alias("grp"))
    named = materialise(same.join(grouped.hint("merge"), ["prefix_digest", "size"]).select("set_digest", "node", "grp"), "named")
    rows = real.select("id", "set_digest").join(named.hint("merge"), "set_digest").select("id", "node")
    whole = real.withColumnRenamed("id", "node")
    nodes = whole.select("node", "set_digest", "size", "sketch").join(named.hint("merge"), ["node", "set_digest"]).select("node", "grp", "size", "sketch")
    leaders = small_side(named.where("node = grp").select("node").distinct())
    # A leader's own row: repeated rows give repeated postings, which change nothing.
    postings = whole.join(leaders, "node", "left_semi").select(F.col("node").alias("grp"), "size", F.posexplode("prefix").alias("place", "key"))
    texts = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).alias("text"))
    found = linked_components(postings, nodes, lambda asked: texts.join(asked, "node", "left_semi"), percent, width)
    # An id that has several sets gets the least of their components.
    by_id = rows.join(found.hint("merge"), "node", "left").groupBy("id").agg(F.min(F.coalesce("component", "node")).alias("component_id"))
    out = sets.select("id", F.col("size").cast("long").alias("n_shingles")).join(by_id.hint("merge"), "id", "left")
    return materialise(out.select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component_id", "id").alias("component_id")), "components")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay when one of each component does, the one of the least id; all columns are kept. Repeated
    rows of one id stay or go together; null and empty texts and rows without an id stay."""
    found = jaccard_components(docs, id_col=id_col, text_col=text_col)
    gone = found.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("gone")).distinct()
    own = {n: f"c{k}" for k, n in enumerate(docs.columns)}
    left = docs.toDF(*own.values()).join(small_side(gone), F.col(own[id_col]) == F.col("gone"), "left_anti")
    return left.select(*(F.col(c).alias(n) for n, c in own.items()))
