"""Packing documents into token sequences with a bounded number of open windows.

Each partition keeps ``open_windows`` windows. A document's last part goes to the window it fits best; where none
fits, the fullest window is filled to its end with the document's next tokens and emitted. At the end a partition
pours its open windows together, and the one partial window that may be left is merged with those of neighbouring
partitions, a fixed number of partitions at a time. So only the last window of such a group is padded, and no step
holds more than its windows. A document's tokens end with ``end_id``.

Defined cases: a null text counts as empty (the end id alone); null or repeated ids are packed like any; texts are
taken whole; further columns are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .piece_bpe import WordMemory, text_slices
from .scratch import new_path, trimmed
from .shingles import LOWER, distinct_stretches

SEQUENCE = 2048
OPEN_WINDOWS = 16
#: Partitions whose last windows are merged by one task: at most so many windows of SEQUENCE tokens.
MERGED_PARTITIONS = 512
PIECES = "id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, window bigint, offset bigint, part bigint, leftover boolean"


# Classes of bytes: white space, letters, digits, other characters, and what is never parted from its neighbours (the
# apostrophe, which begins contractions, and bytes of characters that aren't known to be letters).
_SPACE, _LETTER, _DIGIT, _OTHER, _TIED = range(5)
_CLASS = np.full(256, _TIED, np.uint8)
_CLASS[:128] = [_LETTER if chr(c).isalpha() else _DIGIT if chr(c).isdigit() else _OTHER for c in range(128)]
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE
_CLASS[ord("'")] = _TIED
#: Second bytes of the Latin-1 letters, of which all but the signs for times and divided by are letters.
_LATIN = np.zeros(256, bool)
_LATIN[[c for c in range(0x80, 0xC0) if c not in (0x97, 0xB7)]] = True


class UnitTokenizer:
    """Ids of whole texts by a tokenizers file whose words are split at white space and between letters, digits and
    other characters, whatever the case of A-Z. Each distinct unit is given to the library once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # Lower-case Latin letters need neither normalising nor splitting by patterns, which take most of the time.
        self.bare = Tokenizer.from_file(path)
        self.bare.normalizer = normalizers.Sequence([])
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.specials = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.memory = WordMemory(self.encode)

    def encode(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units and their counts. Units of letters alone end where a piece that closes a word stands, so they
        are encoded together."""
        code = np.frombuffer(b"".join(units), np.uint8)
        ends = np.cumsum([len(u) for u in units])
        odd = np.concatenate(([0], np.cumsum(_classes(code) != _LETTER)))
        plain = np.diff(odd[ends], prepend=0) == 0
        counts, parts = np.zeros(len(units), np.int64), [np.zeros(0, np.int32)]
        at = np.concatenate((np.flatnonzero(plain), np.flatnonzero(~plain)))
        together = at[: int(plain.sum())]
        if len(together):
            text = b" ".join([units[k] for k in together]).decode().lower()
            ids = np.array(self.bare.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(together):
                raise ValueError("units of letters alone must be one word each")
            counts[together] = np.diff(ends, prepend=0)
            parts.append(ids)
        rest = [x.ids for x in self.tokenizer.encode_batch_fast([units[k].decode() for k in at[len(together) :]], add_special_tokens=False)]
        counts[at[len(together) :]] = [len(x) for x in rest]
        flat = np.concatenate([*parts, np.fromiter((i for x in rest for i in x), np.int32, sum(map(len, rest)))])
        first = np.zeros(len(units), np.int64)
        first[at] = np.cumsum(counts[at]) - counts[at]
        return flat[_places(first, counts)], counts

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and the count of each text."""
        whole = [k for k, t in enumerate(texts) if any(x in t for x in self.specials)]
        found = self.split([*texts] if not whole else ["" if k in set(whole) else t for k, t in enumerate(texts)])
        if not whole:
            return found
        flat, counts = found
        pieces = np.split(flat, np.cumsum(counts)[:-1])
        for k in whole:
            pieces[k] = np.array(self.tokenizer.encode(texts[k], add_special_tokens=False).ids, np.int32)
        return np.concatenate(pieces), np.array([len(x) for x in pieces], np.int64)

    def split(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = [t.encode("utf-8", "replace") for t in texts]
        data = b" ".join([*raw, b""]).translate(LOWER)
        kind = _classes(np.frombuffer(data, np.uint8))
        before, now = kind[:-1], kind[1:]
        cut = np.concatenate(([True], (before != now) & ((before == _SPACE) | (now == _SPACE) | ((before != _TIED) & (now != _TIED)))))
        starts = np.flatnonzero(cut)
        number, values = distinct_stretches(data, np.append(starts, len(data)))
        # Values are numbered as they come up, so each one's first stretch tells whether it is white space.
        first = np.flatnonzero(np.diff(np.maximum.accumulate(number), prepend=-1))
        unit = kind[starts[first]] != _SPACE
        at = np.zeros(len(values), np.int64)
        at[unit] = self.memory.numbers([v for v, ok in zip(values.to_pylist(), unit.tolist(), strict=True) if ok])
        own = unit[number]
        flat, counts = self.memory.spelled(at[number[own]])
        bases = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)))
        total = np.concatenate(([0], np.cumsum(counts)))
        return flat, np.diff(total[np.searchsorted(starts[own], bases)])


def _classes(code: np.ndarray) -> np.ndarray:
    kind = _CLASS[code]
    latin = np.flatnonzero((code[:-1] == 0xC3) & _LATIN[code[1:]])
    kind[latin] = kind[latin + 1] = _LETTER
    return kind


def _places(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places ``starts[k]`` to ``starts[k] + counts[k] - 1`` for every k, end to end."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + counts, counts)


@cache
def word_tokenizer(path: str) -> UnitTokenizer:
    """One for each worker process and file, so what it remembers serves all tasks there."""
    return UnitTokenizer(path)


class Packer:
    """Windows of one partition. ``add`` and ``finish`` give pieces: (doc, start, ids, total, window, offset)."""

    def __init__(self, length: int = SEQUENCE, open_windows: int = OPEN_WINDOWS):
        self.length, self.most = length, open_windows
        self.free: dict[int, int] = {}  # open window -> free places
        self.held: dict[int, list] = {}
        self.next = 0

    def _open(self) -> int:
        window, self.next = self.next, self.next + 1
        self.free[window], self.held[window] = self.length, []
        return window

    def _put(self, window: int, piece: tuple) -> list:
        doc, start, ids, total = piece
        self.held[window].append((doc, start, ids, total, window, self.length - self.free[window]))
        self.free[window] -= len(ids)
        return self._emit(window) if not self.free[window] else []

    def _emit(self, window: int) -> list:
        del self.free[window]
        return self.held.pop(window)

    def add(self, doc, ids: np.ndarray) -> list:
        out, start, total = [], 0, len(ids)
        while total - start >= self.length:  # whole windows of a long document
            out += self._put(self._open(), (doc, start, ids[start : start + self.length], total))
            start += self.length
        while start < total:
            rest = total - start
            fits = min(((f, w) for w, f in self.free.items() if f >= rest), default=None)
            if fits:
                out += self._put(fits[1], (doc, start, ids[start:], total))
                break
            if len(self.free) < self.most:
                out += self._put(self._open(), (doc, start, ids[start:], total))
                break
            room, fullest = min((f, w) for w, f in self.free.items())
            out += self._put(fullest, (doc, start, ids[start : start + room], total))
            start += room
        return out

    def finish(self) -> tuple[list, list]:
        """The open windows poured together, in order: full windows, and the pieces of the one left over."""
        out, spare = [], [piece for w in sorted(self.held) for piece in self.held[w]]
        self.free, self.held, self.most = {}, {}, 1
        window = None
        for doc, start, ids, total, _, _ in spare:
            at = 0
            while at < len(ids):
                window = self._open() if window not in self.free else window
                take = min(self.free[window], len(ids) - at)
                out += self._put(window, (doc, start + at, ids[at : at + take], total))
                at += take
        return out, [piece for w in self.held.values() for piece in w]


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, length: int = SEQUENCE, open_windows: int = OPEN_WINDOWS, make_tokenizer=word_tokenizer) -> DataFrame:
    """One row for each piece: ``id_col, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit numbers. ``make_tokenizer(path)`` gives a
    function from a list of texts to flat ids and counts.
    """
    spark = docs.sparkSession

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        tokenize, packer = make_tokenizer(tokenizer_path), Packer(length, open_windows)

        def rows(pieces: list, leftover: bool) -> pa.RecordBatch:
            doc, start, ids, total, window, offset = zip(*pieces, strict=True) if pieces else [()] * 6
            n = [len(x) for x in ids]
            columns = [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()), pa.array(total, pa.int64()), pa.array(window, pa.int64()), pa.array(offset, pa.int64()), pa.array([part] * len(n), pa.int64()), pa.array([leftover] * len(n), pa.bool_())]
            return pa.RecordBatch.from_arrays(columns, ["id", "start", "length", "ids", "doc_tokens", "window", "offset", "part", "leftover"])

        for batch in batches:
            names = iter(batch.column("id").to_pylist())
            for texts in text_slices(batch.column("text").to_pylist()):
                flat, counts = tokenize(texts)
                out, at = [], 0
                for n in counts.tolist():
                    out += packer.add(next(names), np.append(flat[at : at + n], np.int32(end_id)))
                    at += n
                if out:
                    yield rows(out, False)
        whole, left = packer.finish()
        if whole:
            yield rows(whole, False)
        if left:
            yield rows(left, True)

    path = new_path(spark, "pieces")
    found = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(lambda batches: trimmed(run(batches)), PIECES)
    found.write.partitionBy("leftover").option("compression", "zstd").parquet(path)
    pieces = spark.read.schema(PIECES).parquet(path)
    # sequence_id: bit 62 marks merged windows; then the partition (or group of partitions), then the window.
    closed = pieces.where("NOT leftover").withColumn("sequence_id", F.shiftleft("part", 33) + F.col("window"))
    merged = _merge_leftovers(pieces.where("leftover"), length)
    columns = [F.col("id").alias(id_col), "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    return closed.select(columns).unionByName(merged.select(columns))


def _merge_leftovers(left: DataFrame, length: int) -> DataFrame:
    """Lay the last windows of each group of partitions end to end and cut them anew every ``length`` tokens."""
    group = F.floor(F.col("part") / MERGED_PARTITIONS)
    order = Window.partitionBy("bunch").orderBy("part", "window", "offset")
    laid = left.withColumn("bunch", group).withColumn("end", F.sum("length").over(order)).withColumn("begin", F.col("end") - F.col("length"))
    cut = laid.withColumn("slot", F.explode(F.sequence(F.floor(F.col("begin") / length), F.floor((F.col("end") - 1) / length))))
    first = F.greatest("begin", F.col("slot") * length)
    cut = cut.withColumn("first", first).withColumn("count", F.least("end", (F.col("slot") + 1) * length) - first)
    skip = F.col("first") - F.col("begin")
    return cut.select(
        "id", (F.col("start") + skip).alias("start"), F.col("count").alias("length"), F.col("ids").substr((4 * skip + 1).cast("int"), (4 * F.col("count")).cast("int")).alias("ids"),
        "doc_tokens", (F.lit(1 << 62) + F.shiftleft("bunch", 33) + F.col("slot")).alias("sequence_id"), (F.col("first") - F.col("slot") * length).alias("offset"),
    )
