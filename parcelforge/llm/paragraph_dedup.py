"""Substring dedup by MinHash banding of paragraphs.

A paragraph is a stretch between two content-defined places: words whose pair hash is the least of ``WINDOW``
consecutive ones, so a passage of twice that many words holds whole paragraphs wherever it stands in a document.
``BANDS`` bands of ``ROWS`` minima each find a pair of similarity 0.8 with a probability of 1 - (1 - 0.8**2)**3 = 95 percent (0.9:
99.3), and equal paragraphs always. Colliding paragraphs are joined and verified by the exact Jaccard similarity of their
shingles (see ``linking``). Of a component the first occurrence (least document, then place) is kept and the others are
removals; where two neighbouring paragraphs also occur together before, both are set against that place, so a line that stands in
many documents doesn't part a longer passage. Neighbouring removals with neighbouring kept copies form a run. Its ends
are moved outwards word by word to the first word that isn't the kept copy's, or to the next long run. Only runs of ``MIN_WORDS`` words or more are
reported, overlapping ones as one, so short lines that many documents share stay.

Defined cases: null and empty texts have no paragraphs; paragraphs of under five words or
of one word over and over are never removed for themselves; rows without an id are passed over; of repeated
rows (one id) the text is one document's; further columns pass through; an empty table gives no rows.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .linking import PERCENT, linked_components, small_side
from .piece_bpe import text_slices
from .scratch import materialise, released, trimmed
from .shingles import SLICE_CHARS, WIDTH, mix, shingle_hashes, words_of

WINDOW = 24
BANDS, ROWS = 3, 2
MIN_WORDS = 50
#: Characters on either side of a run that are compared first with the kept copy's surroundings, and how many times more
#: are compared next for runs that used theirs up.
CONTEXT = 600
CONTEXT_GROWTH = 16
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Shingle hashes times an odd number are a minimum's order.
_ORDERS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)
_LATE = np.uint64(1 << 63)
PARAGRAPHS = "id bigint, idx int, first int, words int, start int, end int, digest bigint, size int, sketch bigint, keys array<bigint>"


def cut_places(words: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Where paragraphs begin: 0, and every place whose pair hash is the least of some window."""
    pair = mix(words[:-1] * np.uint64(0x9FB21C651E98DF25) + words[1:])
    if len(pair) < window:
        return np.zeros(min(1, len(words)), np.int64)
    pair[1:][pair[1:] == pair[:-1]] = ~np.uint64(0)  # one word over and over isn't cut
    views = np.lib.stride_tricks.sliding_window_view(pair, window)
    least = np.unique(views.argmin(1) + np.arange(len(views)))
    return np.unique(np.append(least[pair[least] != ~np.uint64(0)], 0))


def paragraphs_of(texts: list[str]) -> dict[str, np.ndarray]:
    """Columns of all paragraphs of five words or more: text number, place, words, characters, digest, size, band keys."""
    found = words_of(texts)
    code = np.frombuffer(found.data, np.uint8)
    chars = np.concatenate(([0], np.cumsum((code & 0xC0) != 0x80)))
    shingle = shingle_hashes(found.hashes, WIDTH)
    again = np.concatenate((found.hashes[1:] == found.hashes[:-1], [False])) if len(found.hashes) else np.zeros(0, bool)
    dull = np.logical_and.reduce([again[k : len(shingle) + k] for k in range(WIDTH - 1)]) if len(found.hashes) >= WIDTH else np.zeros(0, bool)
    text, first, last, idx = [], [], [], []
    for k, (a, b) in enumerate(zip(found.firsts[:-1].tolist(), found.firsts[1:].tolist(), strict=True)):
        cuts = cut_places(found.hashes[a:b]) + a
        ends = np.append(cuts[1:], b)[: len(cuts)]
        keep = ends - cuts >= WIDTH
        first.append(cuts[keep])
        last.append(ends[keep])
        text.append(np.full(int(keep.sum()), k))
        idx.append(np.arange(int(keep.sum())))
    text, first, last, idx = (np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (text, first, last, idx))
    if not len(first):
        return {c: np.zeros(0, np.int64) for c in ("text", "idx", "first", "words", "start", "end", "digest", "size", "sketch")} | {"keys": np.zeros((0, BANDS), np.int64)}
    counts = last - first - WIDTH + 1
    owner = np.repeat(np.arange(len(first)), counts)
    at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts - first, counts)
    flat = shingle[at]
    by = np.lexsort((flat, owner))
    new = np.concatenate(([True], (flat[by][1:] != flat[by][:-1]) | (owner[by][1:] != owner[by][:-1])))
    starts = np.cumsum(counts) - counts
    # One word five times over says nothing of a paragraph, so such shingles aren't chosen while there are others.
    late, keys = dull[at], np.zeros((len(first), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(first), band, np.uint64)
        for order in _ORDERS[band * ROWS : (band + 1) * ROWS]:
            value = flat * order
            key = mix(key * np.uint64(3) + np.minimum.reduceat(np.where(late, value | _LATE, value >> np.uint64(1)), starts))
        keys[:, band] = key
    bit = np.uint64(1) << (mix(flat[by] + np.uint64(1)) & np.uint64(63))
    sketch = np.bitwise_xor.reduceat(np.where(new, bit, np.uint64(0)), starts)
    # Paragraphs of equal shingle sets are one node: a word said a few times more makes no other paragraph.
    digest = mix(np.add.reduceat(np.where(new, mix(flat[by] ^ np.uint64(0x2545F4914F6CDD1D)), np.uint64(0)), starts))
    bases = chars[found.bases[text]]
    found_all = {
        "text": text, "idx": idx, "first": first - found.firsts[text], "words": last - first, "start": chars[found.starts[first]] - bases, "end": chars[found.ends[last - 1]] - bases,
        "digest": digest.view(np.int64), "size": np.bincount(owner[by][new], minlength=len(first)), "sketch": sketch.view(np.int64), "keys": keys.view(np.int64),
    }
    said = ~np.logical_and.reduceat(dull[at], starts)  # not one word over and over
    told = {c: v[said] for c, v in found_all.items()}
    told["idx"] = np.arange(len(told["text"])) - np.searchsorted(told["text"], told["text"])
    return told


def paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The paragraphs that can be removals: ``id``, number ``idx``, first word, words, characters from ``start`` to
    ``end`` (exclusive), digest of the shingle set, its size, their parity sketch of one long, and band keys."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, done = batch.column("id").to_numpy(zero_copy_only=False), 0
            for part in text_slices(batch.column("text").to_pylist(), SLICE_CHARS):
                x = paragraphs_of(part)
                keys = pa.ListArray.from_arrays(pa.array(np.arange(len(x["keys"]) + 1) * BANDS, pa.int32()), pa.array(x["keys"].reshape(-1)))
                names = ("idx", "first", "words", "start", "end")
                columns = [pa.array(ids[done + x["text"]], pa.int64()), *(pa.array(x[c], pa.int32()) for c in names), pa.array(x["digest"], pa.int64()), pa.array(x["size"], pa.int32()), pa.array(x["sketch"]), keys]
                yield pa.RecordBatch.from_arrays(columns, ["id", *names, "digest", "size", "sketch", "keys"])
                done += len(part)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL")
    return rows.mapInArrow(lambda batches: trimmed(run(batches)), PARAGRAPHS)


def shared_words(one: str, other: str, backwards: bool, cut: tuple[bool, bool] = (False, False)) -> tuple[int, int, int, bool]:
    """How many words two stretches have in common from one end, how many characters those take in either, and whether
    it takes more text to tell: ``cut`` says which stretch ends, at its far end, before its text does."""
    one, other = one.translate(_LOWER), other.translate(_LOWER)
    if backwards:  # words are equal just where they are when read backwards
        one, other = one[::-1], other[::-1]
    a, b, n, ends = _WORD.finditer(one), _WORD.finditer(other), 0, (0, 0)
    while True:
        x, y = next(a, None), next(b, None)
        # The last word of a cut stretch may go on beyond it.
        over = [w is None or short and w.end() == len(text) for w, text, short in ((x, one, cut[0]), (y, other, cut[1]))]
        if any(over):
            return n, *ends, all(short for done, short in zip(over, cut, strict=True) if done)
        if x.group() != y.group():
            return n, *ends, False
        n, ends = n + 1, (x.end(), y.end())


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """One row for each passage to remove: ``id_col, start, end, n_words, keep_id, keep_start`` (characters from 0,
    ``end`` exclusive; ``keep_id`` and ``keep_start`` tell where the copy that stays is)."""
    with released(docs.sparkSession) as keep:
        return keep(_repeated(docs, id_col, text_col, percent, min_words))


def _repeated(docs: DataFrame, id_col: str, text_col: str, percent: int, min_words: int) -> DataFrame:
    found = materialise(paragraphs(docs, id_col, text_col), "paragraphs")
    # Copies of a paragraph are one node, so a key's list holds each text once.
    one = [F.first(c).alias(c) for c in ("size", "sketch")] + [F.first(F.col("keys")[k]).alias(f"key{k}") for k in range(BANDS)]
    same = materialise(found.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), *one), "digests")
    # Smaller sets link with equal ones alone, and those have one digest.
    linking = same.where(F.col("size") * F.lit(100 - percent) >= F.lit(percent))
    postings = linking.select(F.explode(F.array(*(f"key{k}" for k in range(BANDS)))).alias("key"), F.col("digest").alias("grp"), "size", F.lit(0).alias("place"))
    nodes = same.select(F.col("digest").alias("node"), F.col("digest").alias("grp"), "size", "sketch")
    linked = linked_components(postings, nodes, _texts_of(found, docs, id_col, text_col), percent, hub_rounds=1)
    tagged = same.join(linked, same["digest"] == linked["node"], "left").select("digest", F.coalesce("component", "digest").alias("cluster"), "n")
    several = tagged.groupBy("cluster").agg(F.sum("n").alias("copies")).where("copies > 1").select("cluster")
    clusters = materialise(tagged.join(several, "cluster").select("digest", "cluster"), "clusters")
    copies = materialise(found.select("id", "idx", "first", "words", "start", "end", "digest").join(clusters.hint("merge"), "digest").drop("digest"), "copies")
    runs = materialise(_runs(materialise(_with_kept(copies), "kept")), "runs")
    found_runs = _extended(runs, docs, min_words, id_col, text_col).where(F.col("last") - F.col("first") >= min_words)
    return materialise(_merged(found_runs).withColumnRenamed("id", id_col), "passages")


def _with_kept(copies: DataFrame) -> DataFrame:
    """The removals among the copies, with the place ``keep`` (``id, idx, start, end``) of the copy that stays.

    A paragraph together with the next, or the one before, that occurs so before goes with that place; else it goes with
    the first copy of its own. Where that is in the same document it goes with the copy before it there, so that a line
    that is said over and over makes one run.
    """
    c, by_doc = F.col, Window.partitionBy("id").orderBy("idx")
    place = F.struct("id", "idx", "start", "end")
    beside = lambda f, step: F.when(f("idx").over(by_doc) == c("idx") + step, f("cluster").over(by_doc))
    after = F.when(F.lead("idx").over(by_doc) == c("idx") + 1, F.lead(place).over(by_doc))
    # Where there is no neighbour a number of its own stands in, which no pair has.
    alone = F.xxhash64(F.lit("alone"), "id", "idx")
    again = F.lag(place).over(Window.partitionBy("id", "cluster").orderBy("idx")).alias("again")
    seen = materialise(copies.select("*", again, F.coalesce(beside(F.lead, 1), alone).alias("next"), F.coalesce(beside(F.lag, -1), alone).alias("prior"), after.alias("after")), "neighbours")
    single = materialise(seen.groupBy("cluster").agg(F.min(place).alias("one")), "first-copies")
    double = seen.where("after IS NOT NULL").groupBy("cluster", "next").agg(F.min(F.struct(place.alias("left"), c("after").alias("right"))).alias("two"), F.count(F.lit(1)).alias("n"))
    double = materialise(double.where("n > 1").drop("n"), "first-pairs")
    ahead = double.select("cluster", "next", c("two.left").alias("ahead"))
    behind = double.select(c("cluster").alias("prior"), c("next").alias("cluster"), c("two.right").alias("behind"))
    joined = seen.join(single.hint("merge"), "cluster").join(ahead.hint("merge"), ["cluster", "next"], "left").join(behind.hint("merge"), ["prior", "cluster"], "left")
    other = lambda x: F.when((c(f"{x}.id") != c("id")) | (c(f"{x}.idx") != c("idx")), c(x))
    keep = F.coalesce(F.least(other("ahead"), other("behind")), other("one"))
    told = joined.withColumn("keep", keep).where("keep IS NOT NULL").withColumn("keep", F.when(c("keep.id") == c("id"), c("again")).otherwise(c("keep")))
    return told.select("id", "idx", "first", "words", "start", "end", "keep").where("keep IS NOT NULL")


def _texts_of(found: DataFrame, docs: DataFrame, id_col: str, text_col: str):
    """A function that gives ``node, text`` for a table of nodes: the text of each one's first paragraph."""
    whole = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("whole"))

    def texts(asked: DataFrame) -> DataFrame:
        own = found.select(F.col("digest").alias("node"), "id", "start", "end").join(asked, "node", "left_semi")
        first = materialise(own.groupBy("node").agg(F.min(F.struct("id", "start", "end")).alias("at")).select("node", "at.*"), "first-places")
        near = whole.join(small_side(first.select("id").distinct()), "id", "left_semi").dropDuplicates(["id"])
        return first.join(near.hint("merge"), "id").select("node", F.substring("whole", F.col("start") + 1, F.col("end") - F.col("start")).alias("text"))

    return texts


def _runs(gone: DataFrame) -> DataFrame:
    """Consecutive removals whose kept copies are consecutive too, as one row: places in words (``first`` to ``last``) and
    characters, here and at the kept copy."""
    by_place = Window.partitionBy("id").orderBy("idx")
    follows = (F.col("idx") == F.lag("idx").over(by_place) + 1) & (F.col("keep.id") == F.lag("keep.id").over(by_place)) & (F.col("keep.idx") == F.lag("keep.idx").over(by_place) + 1)
    marked = gone.withColumn("fresh", F.when(follows, 0).otherwise(1)).withColumn("run", F.sum("fresh").over(by_place))
    ends = [F.min("start").alias("start"), F.max("end").alias("end"), F.min("first").alias("first"), F.max(F.col("first") + F.col("words")).alias("last")]
    return marked.groupBy("id", "run").agg(*ends, F.min("keep.id").alias("keep_id"), F.min("keep.start").alias("keep_start"), F.max("keep.end").alias("keep_end")).drop("run")


_RUN = ["id", "start", "end", "first", "last", "keep_id", "keep_start", "keep_end", "floor", "ceiling"]
_FAR = (1 << 31) - 1


def _extended(runs: DataFrame, docs: DataFrame, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """The runs with their ends moved out as far as words equal the kept copy's, or up to the next run of ``min_words``
    or more, since the rest goes with that one."""
    long = F.col("last") - F.col("first") >= min_words
    by_place = Window.partitionBy("id").orderBy("start", "end")
    before = F.max(F.when(long, F.col("end"))).over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(long, F.col("start"))).over(by_place.rowsBetween(1, Window.unboundedFollowing))
    now = runs.withColumns({"floor": F.coalesce(before, F.lit(0)), "ceiling": F.coalesce(after, F.lit(_FAR))})
    done, context = None, CONTEXT
    while True:
        moved = materialise(_moved(now, docs, context, min_words, id_col, text_col), "moved")
        told = moved.where("NOT more").select(_RUN)
        done = told if done is None else done.unionByName(told)
        rest = moved.where("more")
        if rest.isEmpty():
            return done
        now, context = rest.select(_RUN), context * CONTEXT_GROWTH


def _contexts(places: DataFrame, docs: DataFrame, context: int, id_col: str, text_col: str) -> DataFrame:
    """For each distinct place the text beside it, up to ``context`` characters on either side. A document's places
    go to its text together, so each text crosses the network once."""
    asked = materialise(places.groupBy(F.col("doc").alias("asked_doc")).agg(F.collect_set(F.struct("from", "to")).alias("at")), "asked")
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    near = texts.join(small_side(asked.select(F.col("asked_doc").alias("doc"))), "doc", "left_semi")
    both = near.join(asked.hint("merge"), F.col("doc") == F.col("asked_doc")).select("doc", "text", F.explode("at").alias("at"))
    begin = F.greatest(F.col("at.from") - context, F.lit(0))
    held = both.select(
        "doc", "at.from", "at.to", F.substring("text", begin + 1, F.col("at.from") - begin).alias("before"), F.substring("text", F.col("at.to") + 1, F.lit(context)).alias("after"),
        (begin > 0).alias("cut_before"), (F.char_length("text") > F.col("at.to") + context).alias("cut_after"),
    )
    # Repeated rows of one id have one text, or else any of theirs is taken.
    return materialise(held.dropDuplicates(["doc", "from", "to"]), "contexts")


def _moved(runs: DataFrame, docs: DataFrame, context: int, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """The runs, their ends as far as ``context`` tells, and whether it takes more (``more``)."""
    c = F.col
    long = c("last") - c("first") >= min_words
    room = {"room_before": F.when(long, F.greatest(c("start") - c("floor"), F.lit(0))).otherwise(F.lit(_FAR)), "room_after": F.when(long, F.greatest(c("ceiling") - c("end"), F.lit(0))).otherwise(F.lit(_FAR))}
    now = runs.withColumns(room)
    closed = (c("room_before") == 0) & (c("room_after") == 0)
    open_runs = now.where(~closed)
    own, kept = (open_runs.select(c(d).alias("doc"), c(a).alias("from"), c(b).alias("to")) for d, a, b in (("id", "start", "end"), ("keep_id", "keep_start", "keep_end")))
    beside = _contexts(own.unionByName(kept), docs, context, id_col, text_col)

    def with_context(rows: DataFrame, keys: tuple[str, str, str], name: str) -> DataFrame:
        held = beside.select(*(c(x).alias(f"__{x}") for x in ("doc", "from", "to")), F.struct("before", "after", "cut_before", "cut_after").alias(name))
        met = (c(keys[0]) == c("__doc")) & (c(keys[1]) == c("__from")) & (c(keys[2]) == c("__to"))
        return rows.join(held.hint("merge"), met).drop("__doc", "__from", "__to")

    both = with_context(with_context(open_runs, ("id", "start", "end"), "own"), ("keep_id", "keep_start", "keep_end"), "kept")
    # The own text beside a run ends where its room does.
    rest = lambda text, n, back: F.when(F.char_length(text) > c(n), F.right(c(text), c(n)) if back else F.substring(c(text), F.lit(1), c(n))).otherwise(c(text))
    whole = both.select(*_RUN, rest("own.before", "room_before", True).alias("own_before"), rest("own.after", "room_after", False).alias("own_after"), c("kept.before").alias("kept_before"), c("kept.after").alias("kept_after"),
                        (c("own.cut_before") | (F.char_length("own.before") > c("room_before"))).alias("own_cut_before"), (c("own.cut_after") | (F.char_length("own.after") > c("room_after"))).alias("own_cut_after"),
                        c("kept.cut_before").alias("kept_cut_before"), c("kept.cut_after").alias("kept_cut_after"))
    kinds = {**{n: pa.int64() if n in ("id", "keep_id") else pa.int32() for n in _RUN}, "more": pa.bool_()}
    schema = pa.schema(list(kinds.items()))

    def move(r: dict) -> dict:
        n, taken, back, early = shared_words(r["own_before"], r["kept_before"], True, (r["own_cut_before"], r["kept_cut_before"]))
        m, added, on, late = shared_words(r["own_after"], r["kept_after"], False, (r["own_cut_after"], r["kept_cut_after"]))
        out = {k: r[k] for k in _RUN}
        out["start"], out["end"], out["first"], out["last"] = r["start"] - taken, r["end"] + added, r["first"] - n, r["last"] + m
        out["keep_start"], out["keep_end"] = r["keep_start"] - back, r["keep_end"] + on
        # A side that has come to its neighbour is done once the run is long.
        short = out["last"] - out["first"] < min_words
        out["more"] = (early and (short or out["start"] > r["floor"] + 1)) or (late and (short or out["end"] + 1 < r["ceiling"]))
        return out

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, (1 << 20) // context)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                yield pa.RecordBatch.from_pylist([move(r) for r in batch.slice(at, step).to_pylist()], schema=schema)

    told = whole.mapInArrow(run, ", ".join(f"{n} {'boolean' if n == 'more' else 'bigint' if n in ('id', 'keep_id') else 'int'}" for n in kinds))
    return told.unionByName(now.where(closed).select(*_RUN, F.lit(False).alias("more")))


def _merged(runs: DataFrame) -> DataFrame:
    """Overlapping runs of a document as one passage, kept where the longest of them is: ``id, start, end, n_words, keep_id,
    keep_start``."""
    by_place = Window.partitionBy("id").orderBy("start", "end", "keep_id", "keep_start")
    reach = F.max("end").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    marked = runs.withColumn("fresh", F.when(F.col("start") < reach, 0).otherwise(1)).withColumn("passage", F.sum("fresh").over(by_place))
    longest = F.max(F.struct((F.col("last") - F.col("first")).alias("n"), (-F.col("keep_id")).alias("id"), (-F.col("keep_start")).alias("start"))).alias("kept")
    whole = marked.groupBy("id", "passage").agg(F.min("start").alias("start"), F.max("end").alias("end"), (F.max("last") - F.min("first")).alias("n_words"), longest)
    return whole.select("id", "start", "end", "n_words", (-F.col("kept.id")).alias("keep_id"), (-F.col("kept.start")).alias("keep_start"))


def without_passages(docs: DataFrame, passages: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the passages cut out of their texts. Documents of which nothing but white space is left go; null
    and empty texts that had no passage stay, as do rows without an id; spans may overlap."""
    by_place = Window.partitionBy("id").orderBy("start", "end")
    ends = passages.select(F.col(id_col).cast("long").alias("id"), F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"))
    # Each span with the furthest end before it: the text in between stays.
    reach = F.coalesce(F.max("end").over(by_place.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    gaps = ends.withColumn("reach", reach).groupBy("id").agg(F.sort_array(F.collect_list(F.struct("reach", "start"))).alias("gaps"), F.max("end").alias("tail"))
    own = [f"c{k}" for k in range(len(docs.columns))]
    names = dict(zip(docs.columns, own, strict=True))
    c = F.col
    joined = docs.toDF(*own).join(gaps, c(names[id_col]) == c("id"), "left")
    text = c(names[text_col])
    pieces = F.transform("gaps", lambda g: F.substring(text, g["reach"] + 1, F.greatest(g["start"] - g["reach"], F.lit(0))))
    cut = F.concat(F.array_join(pieces, ""), F.substring(text, c("tail") + 1, F.char_length(text)))
    left = joined.withColumn("cut", F.when(c("gaps").isNull(), text).otherwise(cut)).where(c("gaps").isNull() | c("cut").rlike(r"[^\x20\x09-\x0D]"))
    return left.select(*(c("cut" if n == text_col else names[n]).alias(n) for n in docs.columns))
