"""Hard negatives by product quantisation with stored residual norms, exact in the end.

Vectors become integers (the floor of ``SCALE`` times each component). Codebooks are fitted on a bounded sample; every row
is coded in ``LEVELS`` levels: for each part of the vector the nearest centroid, then for each part of what that misses,
and so on; for each level the norm of what is still missed is stored. An anchor's inner product with a row is the sum of its
lookup tables' entries, plus or minus at most the anchor's norm times the row's residual norm (Cauchy-Schwarz). So each row
has a lower and an upper bound, and filters by bounds lose nothing: a row stays unless enough others are certain to go before
it, or it is certain to lie outside the window. Most rows go by the first level's bounds; the next levels' are made for those
that stay alone. What stays at the end is scored exactly with integers, and each window is completed from those scores.

Anchors and coded rows are dealt out in blocks of bounded size; each task sets one block of anchors against one of rows,
a slice at a time, and keeps what the bounds of its block leave. A second look sets the bounds of all blocks against each
other. Rows of one vector and label have equal scores, so of them only the first few ids can be among the first of
any anchor; the others are set aside before. Whole vectors go only to what is scored exactly.

The sample (``SAMPLE`` rows of the least hash of their id) fits the codebooks alone: a poor fit makes bounds wide and the
work more, never a result wrong.

Defined cases: rows with a null id, label or vector, or any null or non-finite component, take no part; repeated rows (same
id, label and vector) count once; a vector that is shorter than the longest counts as filled up with zeros, an empty one
as all zeros; rows of one id that differ are rows of their own; further columns are ignored; no anchors, or none with a
positive, no rows. Scores are 64-bit integers: where components are so large that a score overflows, the job fails.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import materialise, released

SCALE = 256
#: Components of a part, centroids of a part, levels, rows that fit them, rounds of fitting.
PART, CENTROIDS, LEVELS, SAMPLE, ROUNDS = 2, 256, 3, 4096, 4
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these percentages of the positive's.
LOW, HIGH = 30, 90
#: Anchors of a block, most rows of a block, rows that are scored at a time.
ANCHOR_BLOCK, ROW_BLOCK, SLICE = 2048, 1 << 18, 1024
#: What is left for rounding between a score and its bounds, and of it in proportion.
SLACK, SHARE = 1e-3, 1e-9
CODED = "key bigint, label bigint, codes binary, missed array<double>"
NEAR = pa.schema([("anchor", pa.int64()), ("key", pa.int64()), ("low", pa.float64()), ("high", pa.float64())])


def usable(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", label: Column | None = None) -> DataFrame:
    """``id, label, vector`` (integers) of the rows that take part, repeated ones once."""
    c = F.col
    odd = F.exists(c(vector_col), lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    whole = rows.where(c(id_col).isNotNull() & c(label_col).isNotNull() & c(vector_col).isNotNull() & ~odd)
    vector = F.transform(vector_col, lambda x: F.floor(F.lit(SCALE) * x.cast("double")).cast("long"))
    return whole.select(c(id_col).cast("long").alias("id"), (c(label_col) if label is None else label).cast("long").alias("label"), vector.alias("vector")).distinct()


def fit(sample: np.ndarray, part: int = PART, centroids: int = CENTROIDS, levels: int = LEVELS, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks ``levels x parts x centroids x part`` for vectors whose length is a multiple of ``part``: k-means from every
    nth of the sample in the order of a part's components, each level over what the one before misses."""
    left, out = (sample if len(sample) else np.zeros((1, sample.shape[1]))).copy(), []
    for _ in range(levels):
        books = []
        for at in range(0, left.shape[1], part):
            own = np.unique(left[:, at : at + part], axis=0)
            book = own[np.linspace(0, len(own) - 1, centroids).astype(int)]
            for _ in range(rounds if len(own) > centroids else 0):
                near = _nearest(own, book)
                n = np.bincount(near, minlength=centroids)
                sums = np.stack([np.bincount(near, own[:, k], minlength=centroids) for k in range(own.shape[1])], 1)
                book = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], book)
            books.append(book)
            left[:, at : at + part] -= book[_nearest(left[:, at : at + part], book)]
        out.append(books)
    return np.array(out)


def _nearest(own: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.argmin((book * book).sum(1)[None, :] - 2 * own @ book.T, axis=1)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as rows, filled up with zeros."""
    out = np.zeros((len(column), width))
    lengths = np.asarray(column.value_lengths())
    out[np.repeat(np.arange(len(column)), lengths), np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = column.flatten().to_numpy()
    return out


def code(own: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each vector the centroids, ``levels x parts``, and the norm of what each level misses."""
    left, codes, missed = own.copy(), np.zeros((len(own), *books.shape[:2]), np.uint8), np.zeros((len(own), len(books)))
    for k, level in enumerate(books):
        for m, book in enumerate(level):
            part = left[:, m * book.shape[1] : (m + 1) * book.shape[1]]
            codes[:, k, m] = near = _nearest(part, book)
            part -= book[near]
        missed[:, k] = np.sqrt((left * left).sum(1))
    return codes, missed


def coded(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``CODED`` for every row."""
    width = books.shape[1] * books.shape[3]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(k, SLICE) for k in range(0, whole.num_rows, SLICE)):
                codes, missed = code(_matrix(batch.column("vector"), width), books)
                norms = pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1) * len(books), pa.int32()), pa.array(missed.reshape(-1)))
                yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("label"), pa.array([c.tobytes() for c in codes], pa.binary()), norms], ["key", "label", "codes", "missed"])

    return rows.mapInArrow(run, CODED)


class _Tables:
    """The anchors' lookup tables: what each centroid of each level and part adds to their scores."""

    def __init__(self, anchors: np.ndarray, books: np.ndarray):
        self.norms = np.sqrt((anchors * anchors).sum(1))
        self.each = [np.einsum("amp,mcp->mac", anchors.reshape(len(anchors), *level.shape[::2]), level) for level in books]

    def all(self, codes: np.ndarray) -> np.ndarray:
        """First-level scores of all anchors (rows) and coded rows (columns)."""
        about = np.zeros((len(self.norms), len(codes)))
        for m, table in enumerate(self.each[0]):
            about += table.take(codes[:, 0, m], axis=1)
        return about

    def more(self, level: int, x: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """What a further level adds for anchors ``x`` and as many rows."""
        about = np.zeros(len(x))
        for m, table in enumerate(self.each[level]):
            about += table[x, codes[:, level, m]]
        return about


def _slack(about: np.ndarray, norms: np.ndarray, missed: np.ndarray) -> np.ndarray:
    """How far exact scores may lie from ``about``, with room for rounding."""
    return norms * missed * (1 + SHARE) + np.abs(about) * SHARE + SLACK


class _Window:
    """For each anchor the scores that count, ``least`` to ``most``, and the ``k`` greatest lower bounds so far of rows that
    are certain to be among them: what can't reach the last of those is out."""

    def __init__(self, least: np.ndarray, most: np.ndarray, k: int):
        self.least, self.most, self.best = least, most, np.full((len(least), k), -np.inf)
        self.floor = least.copy()

    def may(self, x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (low <= self.most[x]) & (high >= self.floor[x])

    def add(self, x: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """Take in rows of their own, given by anchor and bounds."""
        sure = np.flatnonzero((low >= self.floor[x]) & (high <= self.most[x]))
        sure = sure[np.lexsort((-low[sure], x[sure]))]
        own, k = x[sure], self.best.shape[1]
        place = np.arange(len(own)) - np.searchsorted(own, own)
        first = place < k
        new = np.full(self.best.shape, -np.inf)
        new[own[first], place[first]] = low[sure][first]
        both = np.concatenate((self.best, new), axis=1)
        self.best = np.partition(both, k, axis=1)[:, -k:]
        self.floor = np.maximum(self.least, self.best.min(axis=1))


def _survivors(a: dict, parts: Iterable[dict], books: np.ndarray, same: bool, k: int) -> tuple[np.ndarray, ...]:
    """Anchors (by number), row keys and bounds of what a block's bounds leave: of rows of the anchor's own label (``same``), or
    of other labels, all that may be among the first ``k`` with scores from ``lows`` to ``highs``, for any of the anchor's windows."""
    tables = _Tables(a["vector"], books)
    windows = [_Window(least, most, k) for least, most in zip(a["lows"].T, a["highs"].T, strict=True)]
    may = lambda x, low, high: np.logical_or.reduce([w.may(x, low, high) for w in windows])
    out = []
    for part in parts:
        about = tables.all(part["codes"])
        slack = _slack(about, tables.norms[:, None], part["missed"][None, :, 0])
        # First by what all windows of an anchor span together.
        stay = about - slack <= np.max([w.most for w in windows], axis=0)[:, None]
        stay &= about + slack >= np.min([w.floor for w in windows], axis=0)[:, None]
        stay &= ((a["label"][:, None] == part["label"][None, :]) == same) & (a["key"][:, None] != part["key"][None, :])
        x, y = np.nonzero(stay)
        about, slack = about[x, y], slack[x, y]
        for level in range(1, len(books) + 1):
            keep = may(x, about - slack, about + slack)
            x, y, about, slack = x[keep], y[keep], about[keep], slack[keep]
            if level < len(books):
                about = about + tables.more(level, x, part["codes"][y])
                slack = _slack(about, tables.norms[x], part["missed"][y, level])
        low, high = about - slack, about + slack
        for w in windows:
            w.add(x, low, high)
        out.append((x, part["key"][y], low, high))
    x, key, low, high = (np.concatenate(v) for v in zip(*out, strict=True)) if out else (np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
    keep = may(x, low, high)
    return x[keep], key[keep], low[keep], high[keep]


def _near(anchors: DataFrame, rows: DataFrame, books: np.ndarray, same: bool, k: int) -> DataFrame:
    """``NEAR``: what the blocks' bounds leave of anchors (``key, label, vector, lows, highs``) and coded rows."""
    spark = rows.sparkSession
    width, shared = books.shape[1] * books.shape[3], spark.sparkContext.broadcast(books)
    n, held, tasks = anchors.count(), rows.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))
    a_blocks = max(1, -(-n // ANCHOR_BLOCK))
    r_blocks = max(1, -(-held // ROW_BLOCK), -(-tasks // a_blocks))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return NEAR.empty_table()
        books = shared.value
        one = lambda table, c: table.column(c).combine_chunks()
        a = {"key": one(left, "key").to_numpy(), "label": one(left, "label").to_numpy(), "vector": _matrix(one(left, "vector"), width)}
        a |= {c: one(left, c).flatten().to_numpy().reshape(left.num_rows, -1) for c in ("lows", "highs")}
        labels = one(right, "label").to_numpy()

        def parts(rows: pa.Table) -> Iterator[dict]:
            for at in range(0, rows.num_rows, SLICE):
                part = rows.slice(at, SLICE)
                told = {c: part.column(c).to_numpy() for c in ("key", "label")}
                told["missed"] = one(part, "missed").flatten().to_numpy().reshape(part.num_rows, -1)
                yield told | {"codes": np.frombuffer(b"".join(part.column("codes").to_pylist()), np.uint8).reshape(part.num_rows, *books.shape[:2])}

        found = []
        for label in np.unique(a["label"]) if same else [None]:  # rows of an anchor's own label are set against it alone
            own = np.flatnonzero(a["label"] == label) if same else np.arange(left.num_rows)
            rows = right.take(np.flatnonzero(labels == label)) if same else right
            x, *rest = _survivors({c: v[own] for c, v in a.items()}, parts(rows), books, same, k)
            found.append(pa.table([pa.array(v) for v in (a["key"][own][x], *rest)], schema=NEAR))
        return pa.concat_tables(found)

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = lambda n: F.pmod(F.xxhash64("key"), F.lit(n)).cast("int")
    left = anchors.withColumn("a_block", own(a_blocks)).withColumn("r_block", every(r_blocks))
    right = rows.withColumn("r_block", own(r_blocks)).withColumn("a_block", every(a_blocks))
    return left.groupBy("a_block", "r_block").cogroup(right.groupBy("a_block", "r_block")).applyInArrow(run, "anchor bigint, key bigint, low double, high double")


def _exact(pairs: DataFrame, anchors: DataFrame, rows: DataFrame) -> DataFrame:
    """``anchor, key, id, score`` for each pair ``anchor, key``: the integer inner product."""
    near = pairs.join(rows.select("key", "id", F.col("vector").alias("other")).hint("merge"), "key").join(anchors.select(F.col("key").alias("anchor"), "vector").hint("merge"), "anchor")
    products = F.zip_with("vector", "other", lambda x, y: F.coalesce(x * y, F.lit(0).cast("long")))
    return near.select("anchor", "key", "id", F.aggregate(products, F.lit(0).cast("long"), lambda s, x: s + x).alias("score"))


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, sample: int = SAMPLE) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` from rows as ``usable`` gives them.

    Anchors are the rows of which ``is_anchor`` (of ``id``) holds. An anchor's positives are the ``positives`` other rows of
    its label with the greatest scores; a positive's negatives are the first ``negatives`` rows of other labels, greatest score
    first, with ``low`` to ``high`` percent of its score. Ties go by smaller id.
    """
    with released(rows.sparkSession) as keep:
        return keep(_mined(rows, is_anchor, positives, negatives, low, high, sample))


def _mined(rows: DataFrame, is_anchor: Column, positives: int, negatives: int, low: int, high: int, sample: int) -> DataFrame:
    c = F.col
    # Keys are made once and written, so that they are the same for every reader.
    whole = materialise(rows.withColumn("key", F.monotonically_increasing_id()), "vectors")
    anchors = materialise(whole.where(is_anchor), "anchors")
    copies = F.row_number().over(Window.partitionBy("label", "vector").orderBy("id", "key"))
    first = materialise(whole.withColumn("copy", copies).where(c("copy") <= max(positives + 1, negatives)).drop("copy"), "first-copies")
    held = whole.orderBy(F.xxhash64("id"), "key").limit(sample).select("vector").toArrow()
    width = whole.agg(F.max(F.size("vector"))).head()[0] or 1
    books = fit(_matrix(held.column("vector").combine_chunks(), -(-width // PART) * PART))
    codes = materialise(coded(first.select("key", "label", "vector"), books), "codes")

    every = lambda x: F.array(F.lit(x)).cast("array<double>")
    near = materialise(_near(anchors.select("key", "label", "vector", every(float("-inf")).alias("lows"), every(float("inf")).alias("highs")), codes, books, True, positives), "near-positives")
    kth = F.nth_value("low", positives).over(Window.partitionBy("anchor").orderBy(F.desc("low")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    scored = _exact(near.withColumn("kth", kth).where(c("kth").isNull() | (c("high") >= c("kth"))).select("anchor", "key"), anchors, first)
    order = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "id", "key"))
    chosen = materialise(scored.withColumn("place", order).where(c("place") <= positives).select("anchor", "place", c("id").alias("positive_id"), c("score").alias("positive_score")), "positives")

    # A window's ends as doubles, with room for rounding; the exact test is of integers.
    share = lambda percent: c("positive_score").cast("double") * percent / 100
    room = lambda x: F.abs(x) * SHARE + SLACK
    ends = chosen.select("anchor", "place", "positive_id", "positive_score", (share(low) - room(share(low))).alias("least"), (share(high) + room(share(high))).alias("most"))
    windows = materialise(ends, "windows")
    filled = lambda n, x: F.transform(F.sequence(F.lit(1), F.lit(positives)), lambda k: F.coalesce(F.get(c(n), k - 1), F.lit(x)))
    # An anchor of fewer positives has windows that nothing lies in.
    asked = windows.groupBy("anchor").agg(F.sort_array(F.collect_list("least")).alias("lows"), F.sort_array(F.collect_list("most")).alias("highs"))
    asked = asked.select(c("anchor").alias("key"), filled("lows", float("inf")).alias("lows"), filled("highs", float("-inf")).alias("highs"))
    near = materialise(_near(anchors.select("key", "label", "vector").join(asked, "key"), codes, books, False, negatives), "near-negatives")
    inside = near.join(windows.select("anchor", "place", "least", "most").hint("merge"), "anchor").where((c("low") <= c("most")) & (c("high") >= c("least")))
    sure = F.when((c("low") >= c("least")) & (c("high") <= c("most")), c("low"))
    kth = F.nth_value("sure", negatives).over(Window.partitionBy("anchor", "place").orderBy(F.desc_nulls_last("sure")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    left = inside.withColumn("sure", sure).withColumn("kth", kth).where(c("kth").isNull() | (c("high") >= c("kth"))).select("anchor", "key").distinct()
    scored = materialise(_exact(left, anchors, first), "scores")
    both = scored.join(windows.hint("merge"), "anchor").where((low * c("positive_score") <= 100 * c("score")) & (100 * c("score") <= high * c("positive_score")))
    rank = F.row_number().over(Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id", "key"))
    ranked = both.withColumn("rank", rank).where(c("rank") <= negatives)
    named = ranked.join(anchors.select(c("key").alias("anchor"), c("id").alias("anchor_id")).hint("merge"), "anchor")
    return materialise(named.select("anchor_id", "positive_id", "rank", c("id").alias("negative_id"), "positive_score", c("score").alias("negative_score")), "negatives")
