"""Prefix trie of conversations by Patricia construction over sorted sequences.

A conversation is the sequence of its turns, each known by a digest of role and text. Equal conversations are one
sequence, with the digest of the ids that end there. Distinct sequences are dealt out by ranges, so that a first turn
that a third of the conversations share is split over many tasks, and sorted. One pass over each range keeps a
stack of the points that matter (branches, ends and leaves) with compressed edges between them: a point that is
passed adds what it has gathered to the one above. Then each edge is expanded into its nodes of one child, whose sums
are suffix sums along the edge.

A node that goes on beyond its range is open: what a range tells about it (members, children that begin there, leaves, tokens)
is a part, and parts add up, as a range knows from its neighbours' nearest sequences what has begun before it. Only
open nodes, of which a range has at most twice the depth of its longest sequence, are put together by key.

Defined cases: a null role or text counts as empty; rows without a conversation id take no part; turns stand by ``turn``,
null first, ties by digest; repeated rows are turns of their own; conversations without turns end at the root; texts of any
length count whole; further columns are ignored; no conversations, no nodes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .linking import small_side
from .scratch import materialise, released

#: Bytes of a turn's digest, ids that are put together in one string, children that wait for their parent's id.
TURN, BLOCK, WAITING = 16, 4096, 50_000
NODES = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, key binary, parent_key binary"
_NODES = pa.schema([(n, {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[k]) for n, k in (x.split() for x in NODES.split(", "))])
NO_ENDS = sha256(b"").hexdigest()


def turn_digest(role: Column, text: Column) -> Column:
    """SHA-256 (hex) of a turn: the role's length tells where the text begins."""
    role, text = (F.coalesce(x, F.lit("")) for x in (role, text))
    return F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)


def numbered_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, place`` (from 1), ``digest, words`` for every turn. Texts stay where they are; digests are sorted."""
    c = F.col
    told = conversations.where(c(id_col).isNotNull()).select(
        c(id_col).cast("long").alias("conv_id"), c(turn_col).alias("turn"), turn_digest(c(role_col), c(text_col)).alias("digest"), F.regexp_count(F.coalesce(c(text_col), F.lit("")), F.lit(r"\S+")).alias("words")
    )
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy(c("turn").asc_nulls_first(), "digest"))
    return told.select("conv_id", place.alias("place"), "digest", "words")


def sequences(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """``conv_id, path`` (the turns' digests, end to end) and ``words`` (of each turn) for every id, from turns as above."""
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", F.substring("digest", 1, 2 * TURN).alias("digest"), "words"))).alias("t"))
    path = F.unhex(F.array_join(F.transform("t", lambda x: x["digest"]), ""))
    held = ids.select(F.col("conv_id").cast("long").alias("conv_id")).where("conv_id IS NOT NULL").distinct().join(whole, "conv_id", "left")
    return held.select("conv_id", F.coalesce(path, F.lit(b"")).alias("path"), F.coalesce(F.transform("t", lambda x: x["words"]), F.array().cast("array<int>")).alias("words"))


def _ends(rows: DataFrame) -> DataFrame:
    """``sequence, n, first, ends`` for each distinct sequence: how many conversations it is, the smallest, and the digest of
    their ids in order. Ids are put together by blocks first; the blocks are hashed one after the other."""
    blocks = rows.groupBy("sequence", F.floor(F.col("conv_id") / BLOCK).alias("block")).agg(F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("ids"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, n, first = None, sha256(), 0, 0
        for batch in batches:
            out = []
            for sequence, ids, count, least in zip(*(batch.column(c).to_pylist() for c in ("sequence", "ids", "n", "first")), strict=True):
                if sequence != now:
                    if now is not None:
                        out.append((now, n, first, state.hexdigest()))
                    now, state, n, first = sequence, sha256(), 0, least
                state.update(b"," * bool(n) + ids.encode())
                n += count
            yield told(out)
        if now is not None:
            yield told([(now, n, first, state.hexdigest())])

    def told(out: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], ["sequence", "n", "first", "ends"])

    ordered = blocks.repartition("sequence").sortWithinPartitions("sequence", "block").select("sequence", "ids", "n", "first")
    return ordered.mapInArrow(run, "sequence binary, n bigint, first bigint, ends string")


def _shared(one: bytes, other: bytes) -> int:
    """How many turns two sequences have in common."""
    n = min(len(one), len(other)) // TURN
    if one[: n * TURN] == other[: n * TURN]:
        return n
    low, high = 0, n  # the first ``low`` are equal, the first ``high`` aren't
    while high - low > 1:
        half = (low + high) // 2
        if one[low * TURN : half * TURN] == other[low * TURN : half * TURN]:
            low = half
        else:
            high = half
    return low


class _Point:
    """A branch, end or leaf: what the sequences below it have told so far."""

    __slots__ = ("below", "children", "depth", "end", "ends", "first", "head", "keyed", "leaves", "n", "parent_of", "path", "waiting", "words")

    def __init__(self, depth: int, path: bytes, words: list[int], head: bool):
        self.depth, self.path, self.words, self.head = depth, path, words, head  # head: it holds the range's first sequence
        self.n, self.first, self.leaves, self.children, self.below, self.ends = 0, None, 0, 0, 0, None
        self.end, self.parent_of, self.keyed, self.waiting = False, False, False, []


class _Range:
    """The nodes of one range of sorted sequences. ``emit`` takes rows of ``NODES``."""

    def __init__(self, before: bytes | None, emit):
        self.before, self.emit, self.stack, self.last = before, emit, [], None
        self.began = -1  # nodes down to this depth, on the way to the first sequence, have begun in a range before
        self.going = -1  # nodes down to this depth, on the way to the last sequence, go on in the next range

    def add(self, path: bytes, words: list[int], n: int, first: int, ends: str) -> None:
        if self.last is None:
            self.began = -1 if self.before is None else _shared(self.before, path)
            self.stack = [_Point(0, path, words, True)]
            common = 0
        else:
            common = _shared(self.last, path)
        self._close_to(common, False)
        depth = len(path) // TURN
        if depth > self.stack[-1].depth:
            self.stack.append(_Point(depth, path, words, self.last is None))
        point = self.stack[-1]
        point.n, point.first, point.ends, point.end = n, first, ends, True
        self.last = path

    def finish(self, after: bytes | None) -> None:
        if self.last is None:
            return
        self.going = -1 if after is None else _shared(self.last, after)
        self._close_to(0, True)
        self._nodes(self.stack.pop(), None, True)

    def _close_to(self, depth: int, last: bool) -> None:
        while self.stack[-1].depth > depth:
            point = self.stack.pop()
            if self.stack[-1].depth < depth:
                self.stack.append(_Point(depth, point.path, point.words, point.head))
            self._nodes(point, self.stack[-1], last)

    def _key(self, path: bytes, depth: int) -> bytes:
        return blake2b(path[: depth * TURN], digest_size=16).digest()

    def _nodes(self, point: _Point, parent: _Point | None, last: bool) -> None:
        """Expand the edge above a point that is complete, and add its sums to the parent's."""
        begun = lambda k: point.head and k <= self.began
        is_open = lambda k: begun(k) or (last and k <= self.going)
        if not point.parent_of and not (last and self.going >= point.depth):
            point.leaves = 1
        whole, keyed = point.below, point.keyed or is_open(point.depth)
        key = self._key(point.path, point.depth) if keyed else None
        for row in point.waiting:
            self.emit((*row[:2], None if keyed else point.first, *row[3:9], key))
        top = parent.depth if parent else -1
        for k in range(point.depth, top, -1):
            own = point.words[k - 1] if k else 0
            whole += point.n * own - (0 if begun(k) else own)
            children = point.children if k == point.depth else 1 - begun(k + 1)
            row = (point.first, k, None, point.n, children, point.leaves, whole, point.ends if k == point.depth else None, key, None)
            if k == 0:
                self.emit(row)
            elif k == top + 1:
                parent.waiting.append(row)
            else:
                key = self._key(point.path, k - 1) if is_open(k - 1) else None
                self.emit((*row[:2], None if key else point.first, *row[3:9], key))
        if parent is None:
            return
        parent.n, parent.leaves, parent.below = parent.n + point.n, parent.leaves + point.leaves, parent.below + whole
        parent.first = point.first if parent.first is None else min(parent.first, point.first)
        parent.children, parent.parent_of = parent.children + 1 - begun(top + 1), True
        if len(parent.waiting) >= WAITING:  # they look their parent up instead
            parent.keyed, key = True, self._key(parent.path, parent.depth)
            for row in parent.waiting:
                self.emit((*row[:9], key))
            parent.waiting = []


def _range_nodes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``NODES`` from rows by ``part, path``; ``kind`` is 0 for the sequence before the range, 2 for the one after."""
    out: list[tuple] = []
    told = lambda: pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(_NODES)], schema=_NODES)
    now, here, after = None, None, None
    for batch in batches:
        for part, kind, path, words, n, first, ends in zip(*(batch.column(c).to_pylist() for c in ("part", "kind", "path", "words", "n", "first", "ends")), strict=True):
            if part != now:
                if here:
                    here.finish(after)
                now, here, after = part, _Range(path if kind == 0 else None, out.append), None
            if kind == 1:
                here.add(path, words, n, first, ends)
            elif kind == 2:
                after = path
            if len(out) >= 20_000:
                yield told()
                out.clear()
    if here:
        here.finish(after)
    yield told()


def prefix_trie(turns: DataFrame, ids: DataFrame, ranges: int | None = None) -> DataFrame:
    """Every node of the trie of the conversations ``ids`` (``conv_id``), whose ``turns`` are as ``numbered_turns`` has them:
    ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs`` (members), ``n_children, n_leaves`` (childless nodes
    below or itself), ``saved_tokens`` (words that are saved when each turn below or here is kept once), ``ends_sha256``."""
    with released(turns.sparkSession) as keep:
        return keep(_trie(turns, ids, ranges or int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def _trie(turns: DataFrame, ids: DataFrame, ranges: int) -> DataFrame:
    c = F.col
    rows = materialise(sequences(turns, ids).withColumn("sequence", F.unhex(F.sha2("path", 256))), "sequences")
    once = rows.groupBy("sequence").agg(F.first("path").alias("path"), F.first("words").alias("words"))
    distinct = once.join(materialise(_ends(rows.select("sequence", "conv_id")), "ends").hint("merge"), "sequence").drop("sequence")
    dealt = materialise(distinct.repartitionByRange(ranges, "path").withColumn("part", F.spark_partition_id()), "ranges")
    # A row for each range: what its neighbours have nearest to it.
    edges = materialise(dealt.groupBy("part").agg(F.min("path").alias("least"), F.max("path").alias("most")), "edges")
    by_part = Window.orderBy("part")
    beside = edges.select("part", F.lag("most").over(by_part).alias("before"), F.lead("least").over(by_part).alias("after"))
    empty = [F.lit(None).cast(kind).alias(n) for n, kind in (("words", "array<int>"), ("n", "bigint"), ("first", "bigint"), ("ends", "string"))]
    near = [beside.where(c(n).isNotNull()).select("part", F.lit(kind).alias("kind"), c(n).alias("path"), *empty) for kind, n in ((0, "before"), (2, "after"))]
    whole = dealt.select("part", F.lit(1).alias("kind"), "path", "words", "n", "first", "ends").unionByName(near[0]).unionByName(near[1])
    nodes = materialise(whole.repartition(ranges, "part").sortWithinPartitions("part", "path").mapInArrow(_range_nodes, NODES), "nodes")
    sums = [F.sum(n).alias(n) for n in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    parts = nodes.where("key IS NOT NULL").groupBy("key", "depth").agg(F.min("conv_id").alias("conv_id"), F.min("parent_conv_id").alias("parent_conv_id"), *sums, F.max("ends_sha256").alias("ends_sha256"), F.min("parent_key").alias("parent_key"))
    joined = materialise(parts, "open-nodes")
    told = nodes.where("key IS NULL").unionByName(joined.select(*nodes.columns))
    parents = small_side(joined.select(c("key").alias("up"), c("conv_id").alias("up_id")), 128)
    found = told.join(parents, c("parent_key") == c("up"), "left")
    return materialise(found.select("conv_id", "depth", F.coalesce("parent_conv_id", "up_id").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")), "trie")


def shared_starts(turns: DataFrame, group: int, most: int) -> DataFrame:
    """The turns of conversations rebuilt to share starts: the first h turns of conversation c - c % ``group``, then c's own
    after its first h, where h is the CRC-32 of c's decimal digits modulo ``most``."""
    c = F.col
    own = materialise(turns, "turns")
    sizes = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    ids = sizes.select("conv_id", (F.crc32(c("conv_id").cast("string")) % most).alias("h"), (c("conv_id") - c("conv_id") % group).alias("base"))
    based = materialise(ids.join(sizes.select(c("conv_id").alias("base"), c("n").alias("held")), "base", "left").withColumn("taken", F.least("h", F.coalesce("held", F.lit(0)))), "bases")
    starts = own.where(c("place") < most).select(c("conv_id").alias("base"), "place", "digest", "words")
    first = based.join(starts, "base").where(c("place") <= c("h")).select("conv_id", "place", "digest", "words")
    rest = own.join(based.select("conv_id", "h", "taken"), "conv_id").where(c("place") > c("h"))
    return first.unionByName(rest.select("conv_id", (c("taken") + c("place") - c("h")).cast("int").alias("place"), "digest", "words"))
