"""All pairs of alike names of two tables, tile by tile: no pair is left out, at any threshold.

Names of few letters defeat an index: a fixed share of all pairs meets under any of its keys. So all pairs are bounded, as
cheaply as they can be. Names are dealt to blocks, each pair of blocks is one task's tile, and what crosses the network is each
name once for every block of the other table. In a tile one product of matrices gives how many characters (numbered, so that
equal ones are told apart) any two names share; it rules out all but some 0.2 % of pairs that are near enough in length. Of texts with M
matching characters, in order and T characters in all, a break in the match costs one character that doesn't, so with a space at both ends
they share at least 3 M - T + 1 pairs of neighbouring characters; tokens in another order have the same ones. The longest common
subsequence goes before any ratio is made, as it is at least what a ratio matches. A token-set ratio may also rest on the shared tokens alone:
such names are found by their tokens.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import token_set_of, token_sort_of, tokens_of

#: What is left for rounding between a ratio and its bounds; products are of single precision.
SLACK, PRODUCT_SLACK = 1e-6, 0.1
#: Names and characters in a block at most, and names in one that is made for the sake of more tasks.
BLOCK_NAMES, BLOCK_CHARS, SMALL_BLOCK = 1 << 16, 1 << 22, 1 << 10
#: Columns of the product: the most frequent characters have their own up to so many, the others share some.
OWN, OWN_SHARE, FOLDED = 128, 0.95, 16
#: Columns of counts of neighbouring characters, and the length up to which they fit a byte.
GRAMS, GRAM_LENGTH = 512, 250
#: Rows and columns of a product, pairs whose counts are compared at once, pairs that are looked at together, and rows of a result's batch.
ROWS, COLUMNS, CACHED, TOGETHER, BATCH = 1 << 8, 1 << 10, 1 << 10, 1 << 15, 1 << 14
#: Characters of a text that fit the bits of a word.
WORD = 64


def _weight(tokens) -> int:
    """The length of tokens joined by spaces, and one more; 0 of none."""
    return sum(map(len, tokens)) + len(tokens)


class _Block:
    """Names with their tokens, and their ``forms`` by length: all tokens joined, and the distinct ones where a token is said twice."""

    def __init__(self, names: list[str]):
        self.names = names
        told = [tokens_of(n) for n in names]
        self.once = [frozenset(t) for t in told]
        self.weight = [_weight(o) for o in self.once]
        self.repeats = [len(o) < len(t) for t, o in zip(told, self.once, strict=True)]
        texts = [" ".join(sorted(t)) for t in told]
        self.size, self.table = np.array([*map(len, texts)], np.int64), _table(texts)
        forms = [(len(x), k, x) for k, x in enumerate(texts)]
        forms += [(len(x := " ".join(sorted(o))), k, x) for k, o in enumerate(self.once) if self.repeats[k]]
        forms.sort()
        self.length = np.array([x[0] for x in forms], np.int64)
        self.owner = np.array([x[1] for x in forms], np.int64)
        form = np.repeat(np.arange(len(forms)), self.length)
        both = np.sort(form << 21 | _codes("".join(x[2] for x in forms)))
        at = np.arange(len(both))
        first = np.maximum.accumulate(np.where(np.diff(both, prepend=-1) != 0, at, 0))
        self.form, self.chars = both >> 21, (both & (1 << 21) - 1) << 32 | at - first
        padded, ends = _codes("".join(f" {x[2]} " for x in forms)), np.repeat(np.arange(len(forms)), self.length + 2)
        inner = (ends[1:] == ends[:-1]) & (self.length[ends[1:]] <= GRAM_LENGTH)
        hashed = (padded[:-1] * 0x9E3779B1 + padded[1:] * 0x85EBCA77 & 0xFFFFFFFF) * GRAMS >> 32
        self.grams = np.zeros((len(forms), GRAMS), np.uint8)
        np.add.at(self.grams, (ends[1:][inner], hashed[inner]), 1)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)


def _matrices(a: _Block, b: _Block, r: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose product is 0 or more where two forms share enough characters."""
    _, kind, often = np.unique(np.concatenate([a.chars, b.chars]), return_inverse=True, return_counts=True)
    rank = np.empty(len(often), np.int64)
    rank[np.argsort(-often, kind="stable")] = np.arange(len(often))
    own = min(OWN, 1 + int(np.searchsorted(np.cumsum(np.sort(often)[::-1]), OWN_SHARE * often.sum())))
    column = np.where(rank < own, rank, own + rank % FOLDED)[kind]
    out = []
    for block, columns, constant in ((a, column[: len(a.chars)], 0), (b, column[len(a.chars) :], 1)):
        m = np.zeros((len(block.length), own + FOLDED + 2), np.float32)
        # Of characters in one column the product counts at least as many as are shared.
        np.add.at(m, (block.form, columns), 1)
        m[:, own + FOLDED + constant] = -r / 2 * block.length
        m[:, own + FOLDED + 1 - constant] = 1
        out.append(m)
    return out[0], out[1]


def _by_characters(a: _Block, b: _Block, r: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of names that share enough characters and neighbours. Those of two forms may come more than once."""
    left, right = _matrices(a, b, r)
    right = np.ascontiguousarray(right.T)
    share = r / (2 - r)
    room, met, n = np.empty(ROWS * COLUMNS, np.float32), [], 0
    for i in range(0, len(left), ROWS):
        rows = left[i : i + ROWS]
        shortest, longest = a.length[i], a.length[i + len(rows) - 1]
        start, end = np.searchsorted(b.length, [share * shortest - SLACK, longest / share + SLACK]) if share > 0 else (0, len(b.length))
        for j in range(start, end, COLUMNS):
            columns = right[:, j : min(j + COLUMNS, end)]
            product = np.matmul(rows, columns, out=room[: len(rows) * columns.shape[1]].reshape(len(rows), -1))
            x, y = np.divmod(np.flatnonzero(product.ravel() >= -PRODUCT_SLACK), columns.shape[1])
            met.append((x + i, y + j))
            n += len(x)
            if n >= TOGETHER:
                yield from _neighbours(a, b, r, met)
                met, n = [], 0
    if n:
        yield from _neighbours(a, b, r, met)


def _neighbours(a: _Block, b: _Block, r: float, met: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Names of the forms that share enough neighbours."""
    xs, ys = (np.concatenate(side) for side in zip(*met, strict=True))
    n, m = a.length[xs], b.length[ys]
    shared = np.empty(len(xs), np.int64)
    for k in range(0, len(xs), CACHED):
        shared[k : k + CACHED] = np.minimum(a.grams[xs[k : k + CACHED]], b.grams[ys[k : k + CACHED]]).sum(1, dtype=np.int32)
    near = np.flatnonzero((shared >= (1.5 * r - 1) * (n + m) + 1 - SLACK) | (np.maximum(n, m) > GRAM_LENGTH))
    for k in range(0, len(near), TOGETHER):
        yield a.owner[xs[near[k : k + TOGETHER]]], b.owner[ys[near[k : k + TOGETHER]]]


def _by_tokens(a: _Block, b: _Block, share: float) -> Iterator[tuple[int, set[int]]]:
    """Names of ``a`` with those of ``b`` whose shared tokens alone can be ``share`` of one side: of tokens in one order, the rarest
    first, the first that is shared and all after it on either side weigh at least as much."""
    often = Counter(t for block in (a, b) for once in block.once for t in once)
    need = lambda weight: share * (weight - 1) + 1 - SLACK

    def rests(once: frozenset, weight: int) -> list[tuple[str, int]]:
        """Tokens with the weight of them and all after them."""
        out = []
        for t in sorted(once, key=lambda t: (often[t], t)):
            out.append((t, weight))
            weight -= len(t) + 1
        return out

    every, leading = defaultdict(list), defaultdict(list)
    for j, (once, weight) in enumerate(zip(b.once, b.weight, strict=True)):
        for t, rest in rests(once, weight):
            every[t].append((-rest, j))
            if rest >= need(weight):
                leading[t].append((need(weight), j))
    for lists in (*every.values(), *leading.values()):
        lists.sort()
    up_to = lambda lists, most: islice(lists, bisect_right(lists, (most, math.inf)))
    for k, (once, weight) in enumerate(zip(a.once, a.weight, strict=True)):
        found = set()
        for t, rest in rests(once, weight):
            found.update(j for _, j in up_to(leading.get(t, ()), rest))
            if rest >= need(weight):
                found.update(j for _, j in up_to(every.get(t, ()), -need(weight)))
        yield k, found


def _table(texts: list[str]) -> np.ndarray:
    """The first characters of each text in a row, as bytes: what stands for another character only adds to what is in common."""
    return np.array(texts, f"U{WORD}").view(np.uint32).reshape(len(texts), WORD).astype(np.uint8)


def _in_common(x: np.ndarray, n: np.ndarray, y: np.ndarray, m: np.ndarray) -> np.ndarray:
    """At least the length of the longest common subsequence of each row of two tables, of texts of lengths ``n`` and ``m``."""
    width = WORD // 2 if (n <= WORD // 2).all() else WORD
    kind = np.dtype(f"u{width // 8}")
    own = np.where(n < width, (np.uint64(1) << n.clip(0, width - 1).astype(np.uint64)) - np.uint64(1), np.uint64(2**width - 1)).astype(kind)
    rows, x = own.copy(), np.ascontiguousarray(x[:, :width])
    for t in range(min(int(m.max(initial=0)), WORD)):
        at = np.packbits(x == y[:, t : t + 1], axis=1, bitorder="little").view(kind).ravel()
        at &= np.where(t < m, rows, kind.type(0)) & own
        rows = (rows + at) | (rows - at)
    return np.where(np.maximum(n, m) > WORD, np.minimum(n, m), n - np.bitwise_count(rows & own))


def _alike(a: _Block, b: _Block, threshold: float) -> Iterator[tuple[int, int, int]]:
    """Each pair of names whose ratio is the threshold or more, once, with it."""
    r = (threshold - 0.5) / 100 - SLACK
    share = r / (2 - r)

    def ratio(k: int, j: int) -> int:
        once, other = a.once[k], b.once[j]
        if once and other and (once <= other or once >= other):
            return 100  # the token-set ratio's
        return max(token_sort_of(a.names[k], b.names[j]), token_set_of(a.names[k], b.names[j]))

    by_tokens = lambda k, j: _weight(a.once[k] & b.once[j]) - 1 >= share * (min(a.weight[k], b.weight[j]) - 1) - SLACK
    for k, found in _by_tokens(a, b, share):
        for j in found:
            if by_tokens(k, j) and (n := ratio(k, j)) >= threshold:
                yield k, j, n
    seen = set()
    for x, y in _by_characters(a, b, r):
        n, m = a.size[x], b.size[y]
        near = 2 * _in_common(a.table[x], n, b.table[y], m) >= r * (n + m)
        close = list(zip(x[near].tolist(), y[near].tolist(), strict=True))
        # Sides of the token-set ratio begin with what is shared; without, they are the same texts if no token is said twice.
        others = []
        for k, j in zip(x[~near].tolist(), y[~near].tolist(), strict=True):
            shared = a.once[k] & b.once[j]
            if shared or a.repeats[k] or b.repeats[j]:
                one, two = " ".join(sorted(a.once[k] - shared)), " ".join(sorted(b.once[j] - shared))
                before = _weight(shared) - (not one or not two) if shared else 0
                others.append((k, j, one, two, before, max(a.weight[k] - 1, 0) + max(b.weight[j] - 1, 0)))
        if others:
            k, j, one, two, before, lengths = zip(*others, strict=True)
            common = _in_common(_table(one), np.array([*map(len, one)]), _table(two), np.array([*map(len, two)]))
            near = 2 * (np.array(before) + common) >= r * np.array(lengths)
            close += [(k[i], j[i]) for i in np.flatnonzero(near)]
        for k, j in close:
            if (a.once[k] & b.once[j] and by_tokens(k, j)) or (n := ratio(k, j)) < threshold or (k, j) in seen:
                continue
            if a.repeats[k] or b.repeats[j]:
                seen.add((k, j))  # such names have two forms, and may meet more than once
            yield k, j, n


def _tile(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for names, others in zip(batch["names"], batch["others"], strict=True):
                a, b = _Block(names.as_py()), _Block(others.as_py())
                found = _alike(a, b, threshold)
                while rows := list(islice(found, BATCH)):
                    columns = [[a.names[k] for k, _, _ in rows], [b.names[j] for _, j, _ in rows], [float(n) for _, _, n in rows]]
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.string(), pa.string(), pa.float64()), strict=True)], ["name", "other", "confidence"])

    return run


def alike(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """``name, other, confidence``: all pairs of names (``name``, each once) whose name ratio is ``threshold`` or more."""
    spark = left.sparkSession
    cores = spark.sparkContext.defaultParallelism
    sizes = [df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.char_length("name")), F.lit(0))).head() for df in (left, right)]
    p, q = (max(-(-n // BLOCK_NAMES), -(-chars // BLOCK_CHARS), min(-(-n // SMALL_BLOCK), math.isqrt(6 * cores) + 1), 1) for n, chars in sizes)
    # Tiles are few and long: each is a partition of its own.
    dealt = lambda names, tile, to: names.select(tile.cast("int").alias("tile"), "name").repartitionById(p * q, "tile").groupBy("tile").agg(F.collect_list("name").alias(to))
    block = lambda n: F.pmod(F.xxhash64("name", F.lit("tile")), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    a = dealt(left.select("name", every(q).alias("j")), block(p) * q + F.col("j"), "names")
    b = dealt(right.select("name", every(p).alias("i")), F.col("i") * q + block(q), "others")
    return a.join(b.hint("merge"), "tile").select("names", "others").mapInArrow(_tile(threshold), "name string, other string, confidence double")
