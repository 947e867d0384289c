"""Benchmark decontamination by a prefix-filtered set join, with DataFrame functions alone.

Words are runs of letters, digits and characters beyond ASCII; A-Z count as a-z. An item's windows are its stretches of
``WINDOW`` consecutive words, or all its words where they are fewer. A window stands for the set of its shingles of
``WIDTH`` words (all its words where they are fewer), and it can only occur in a document that holds every one of them.

The documents' shingles are set against those of the benchmark in one pass, which leaves the places of benchmark shingles
alone and their frequencies. Shingles are ordered by rarity; containment takes a prefix of one, so a window is joined by
its rarest shingle, and not at all where one of its shingles occurs nowhere. Length and position bound each candidate:
the window has to begin and end within the document. What is left is verified word by word.

The benchmark's sides are broadcast only while their counted rows are few; beyond that the same joins are merge joins.
No text is sent across the network but those of documents with a candidate.

Defined cases: null and empty texts, and texts without words, have no words and no hits; items without words are passed
over, as are items without an id; repeated items count once; items of one id count as one; rows are told apart by id and
text, so rows that share an id get their own results, and every row is returned, repeated ones and those without an id too;
further columns are ignored; an empty table gives no rows, and an empty benchmark no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .exact_dedup import ascii_lower
from .linking import small_side
from .scratch import materialise, released

#: Words of a window and of a shingle.
WINDOW, WIDTH = 10, 5
_PARTS, _WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
#: What a broadcast row of a shingle, and of a window with its words, takes.
_SHINGLE_BYTES, _WINDOW_BYTES = 128, 1024


def words(text: Column) -> Column:
    """The words of a text, in order; none of a null one."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), _PARTS), "")


def word_count(text: Column) -> Column:
    """As many as ``words`` gives, without making them."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(_WORD))


def _shingle(own: str, place: Column, width: int) -> Column:
    """The hash of ``width`` words from a place on; null where the words end before."""
    return F.when(place + width <= F.size(own), F.xxhash64(F.lit(width), *(F.get(F.col(own), place + k) for k in range(width))))


def windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``item, words`` for every window of every item, repeated ones once."""
    own = items.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("own")).where(F.size("own") > 0)
    first = F.explode(F.sequence(F.lit(0), F.greatest(F.size("own") - window, F.lit(0))))
    return own.select("item", "own", first.alias("first")).select("item", F.slice("own", F.col("first") + 1, F.lit(window)).alias("words")).distinct()


def _row_key(id_col: str, text_col: str) -> dict[str, Column]:
    """What tells rows apart: the id (``null`` has a letter, so it is no number) and a digest of the text."""
    return {"row_id": F.coalesce(F.col(id_col).cast("string"), F.lit("null")), "row_text": F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit(""))))}


def hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """All places of windows in documents, ``row_id, row_text, start, length, window``, and the items of the windows,
    ``window, item``. A window is named by the digest of its words."""
    c = F.col
    given = materialise(windows(items, item_col, item_text_col, window).withColumn("window", F.unhex(F.sha2(F.array_join("words", " "), 256))), "windows")
    once = given.dropDuplicates(["window"]).select("window", "words")
    sized = once.withColumn("width", F.least(F.size("words"), F.lit(width)))
    place = F.explode(F.sequence(F.lit(0), F.size("words") - c("width"))).alias("at")
    widths = sorted(r["width"] for r in sized.select("width").distinct().collect())  # at most ``width`` numbers
    if not widths:
        return docs.select(F.lit("").alias("row_id"), F.lit(b"").alias("row_text"), F.lit(0).alias("start"), F.lit(0).alias("length"), F.lit(b"").alias("window")).limit(0), given.select("window", "item")
    shingle_of = F.coalesce(*(F.when(c("width") == w, _shingle("words", c("at"), w)) for w in widths))
    sought = materialise(sized.select("window", "words", "width", place).select("window", F.size("words").alias("length"), "at", shingle_of.alias("shingle")), "sought")

    # The one pass over all words: hashed within the row that explodes, so that no array is copied for a place.
    own = docs.select(*(e.alias(n) for n, e in _row_key(id_col, text_col).items()), words(c(text_col)).alias("own"))
    each = own.select("row_id", "row_text", F.size("own").alias("n_words"), "own", F.posexplode("own").alias("place", "word"))
    every = F.explode(F.array(*(_shingle("own", c("place"), w) for w in widths))) if len(widths) > 1 else _shingle("own", c("place"), widths[0])
    hashed = each.select("row_id", "row_text", "n_words", "place", every.alias("shingle")).where("shingle IS NOT NULL")
    known = small_side(materialise(sought.select("shingle").distinct(), "shingles"), _SHINGLE_BYTES)
    met = materialise(hashed.join(known, "shingle"), "met")

    # The rarest shingle of each window (ties by hash, then by place); a window with one that is nowhere has no candidate.
    often = met.groupBy("shingle").agg(F.count(F.lit(1)).alias("often"))
    ranked = sought.join(often, "shingle", "left").groupBy("window", "length").agg(F.min(F.coalesce("often", F.lit(0))).alias("least"), F.min(F.struct("often", "shingle", "at")).alias("rarest"))
    prefix = materialise(ranked.where("least > 0").select(c("rarest.shingle").alias("shingle"), c("rarest.at").alias("at"), "length", "window"), "prefixes")
    near = met.join(small_side(prefix, _SHINGLE_BYTES), "shingle").withColumn("start", c("place") - c("at"))
    candidates = materialise(near.where((c("start") >= 0) & (c("start") + c("length") <= c("n_words"))).select("row_id", "row_text", "start", "length", "window"), "candidates")

    asked = small_side(materialise(candidates.select("row_id", "row_text").distinct(), "asked"), 2 * _SHINGLE_BYTES)
    texts = docs.withColumns({f"__{n}": e for n, e in _row_key(id_col, text_col).items()}).select(c("__row_id").alias("row_id"), c("__row_text").alias("row_text"), c(text_col).alias("held"))
    held = texts.join(asked, ["row_id", "row_text"], "left_semi").dropDuplicates(["row_id", "row_text"]).select("row_id", "row_text", words(c("held")).alias("own"))
    placed = candidates.join(small_side(once, _WINDOW_BYTES), "window").join(held.hint("merge"), ["row_id", "row_text"])
    found = placed.where(F.slice("own", c("start") + 1, c("length")) == c("words"))
    return materialise(found.select("row_id", "row_text", "start", "length", "window"), "hits"), given.select("window", "item")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, width: int = WIDTH) -> DataFrame:
    """For each row of ``docs``: ``id_col, n_words, n_hit`` (words within any window's occurrence), ``n_items``,
    ``items_sha256`` (of the occurring items' ids, sorted as text, comma-joined) and ``contaminated``."""
    with released(docs.sparkSession) as keep:
        return keep(_contamination(docs, items, id_col, text_col, item_col, item_text_col, window, width))


def _contamination(docs, items, id_col, text_col, item_col, item_text_col, window, width) -> DataFrame:
    c, key = F.col, ["row_id", "row_text"]
    found, owners = hits(docs, items, id_col, text_col, item_col, item_text_col, window, width)
    # The words of overlapping occurrences count once: each adds what lies beyond the furthest end before it.
    longest = found.groupBy(*key, "start").agg(F.max(c("start") + c("length")).alias("end"))
    before = F.max("end").over(Window.partitionBy(*key).orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    fresh = longest.withColumn("from", F.greatest("start", F.coalesce(before, F.lit(0))))
    covered = fresh.groupBy(*key).agg(F.sum(F.greatest(c("end") - c("from"), F.lit(0))).alias("n_hit"))
    told = found.select(*key, "window").distinct().join(small_side(owners, 2 * _SHINGLE_BYTES), "window").select(*key, "item").distinct()
    named = told.groupBy(*key).agg(F.count(F.lit(1)).alias("n_items"), F.sha2(F.array_join(F.sort_array(F.collect_list("item")), ","), 256).alias("items_sha256"))
    marks = materialise(covered.join(named.hint("merge"), key), "marks")
    # All rows, with nothing of their texts but the count of their words.
    rows = docs.select(c(id_col).alias("own_id"), *(e.alias(n) for n, e in _row_key(id_col, text_col).items()), word_count(c(text_col)).cast("long").alias("n_words"))
    joined = rows.join(marks.hint("merge"), key, "left")
    return materialise(
        joined.select(
            c("own_id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        ),
        "contamination",
    )


def without_hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **columns) -> DataFrame:
    """The rows of ``docs`` that hold no window of any item, all columns kept."""
    c = F.col
    found, _ = hits(docs, items, id_col, text_col, **columns)
    gone = small_side(materialise(found.select(c("row_id").alias("__row_id"), c("row_text").alias("__row_text")).distinct(), "gone"), 2 * _SHINGLE_BYTES)
    own = {n: f"c{k}" for k, n in enumerate(docs.columns)}
    tagged = docs.toDF(*own.values()).withColumns({f"__{n}": e for n, e in _row_key(own[id_col], own[text_col]).items()})
    return tagged.join(gone, ["__row_id", "__row_text"], "left_anti").select(*(c(k).alias(n) for n, k in own.items()))
