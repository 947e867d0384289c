"""SentencePiece encoding and decoding by vectorised merge rounds.

Texts are cut into words (a run of word-start marks and what follows). The distinct words of a batch that a worker
hasn't met are laid end to end as one flat array of symbols. Each round finds the least pair rank of every word with
a segmented minimum, merges that pair at its leftmost places in all words at once, and compacts the array; words in
which no pair of the vocabulary is left drop out. Every id equals the library's: merges go by the best score, then
leftmost; where a merged piece could at once take part in a merge that comes before its equals, only the leftmost
place of that word is merged in the round.

Defined cases: a null text counts as empty and has no ids; null ids decode to the empty text; texts of any length are
taken whole (a worker holds one Arrow batch at a time); other columns pass through as they are, an existing output
column is replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MARK = "▁"
#: What an unknown piece decodes to.
UNKNOWN = " ⁇ "
_WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_NONE = np.int32(2**31 - 1)
_SHIFT = np.int64(21)
#: Characters of words that a worker remembers before it starts anew, each word counted with 32 besides; under 100 MB.
REMEMBERED_CHARS = 1 << 23
#: Characters handled at a time within an Arrow batch.
SLICE_CHARS = 1 << 21


class PieceVocabulary:
    """The pieces of a SentencePiece BPE model as arrays: characters to symbols, pairs to merged symbols and ranks."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        pieces = [model.id_to_piece(i) for i in range(size)]
        byte = [model.is_byte(i) for i in range(size)]
        normal = [i for i in range(size) if not (byte[i] or model.is_control(i) or model.is_unknown(i))]
        self.size = size
        self.byte_ids = np.array([i for i in range(size) if byte[i]], np.int32)
        # Decoding: bytes of every piece, control pieces as nothing.
        value = {int(i): bytes([k]) for k, i in enumerate(self.byte_ids)}
        plain = set(normal)
        self.decoded = [value[i] if byte[i] else pieces[i].replace(MARK, " ").encode() if i in plain else b"" for i in range(size)]
        self.decoded[model.unk_id()] = UNKNOWN.encode()
        self.opens = [i in plain and pieces[i].startswith(MARK) for i in range(size)]
        # Encoding: a character without a piece is the symbol size + code point.
        self.symbol = np.arange(size, size + 0x110000, dtype=np.int32)
        by_text = {pieces[i]: i for i in normal}
        for text, i in by_text.items():
            if len(text) == 1:
                self.symbol[ord(text)] = i
        ranks = {s: k for k, s in enumerate(sorted({model.get_score(i) for i in normal}, reverse=True))}
        keys, merged, order, touching = [], [], [], set()
        for text, i in by_text.items():
            for cut in range(1, len(text)):
                left, right = (by_text.get(x, size + ord(x) if len(x) == 1 else None) for x in (text[:cut], text[cut:]))
                if left is not None and right is not None:
                    keys.append((left << int(_SHIFT)) | right)
                    merged.append(i)
                    order.append(ranks[model.get_score(i)])
            touching.update((ord(a) << int(_SHIFT)) | ord(b) for a, b in zip(text, text[1:], strict=False))
        by = np.argsort(np.array(keys, np.int64))
        self.keys, self.merged, self.rank = np.array(keys, np.int64)[by], np.array(merged, np.int32)[by], np.array(order, np.int32)[by]
        self.touching = np.array(sorted(touching), np.int64)
        own = np.full(size, _NONE, np.int32)
        for i in normal:
            own[i] = ranks[model.get_score(i)]
        # Pieces that, once merged, could go first in another merge of the same or a better rank.
        self.eager = np.zeros(size, bool)
        for side in (self.keys >> _SHIFT, self.keys & ((1 << _SHIFT) - 1)):
            known = side < size
            hit = known & (self.rank <= own[np.where(known, side, 0)])
            self.eager[side[hit]] = True

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each pair the merged symbol and its rank (``_NONE`` where there is no such piece)."""
        key = (left.astype(np.int64) << _SHIFT) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return self.merged[at], np.where(hit, self.rank[at], _NONE)

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all words and the number of ids of each."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(words)), lengths)
        place, symbols = self._merge(code, word)
        word = word[place]
        if len(unknown := np.flatnonzero(symbols >= self.size)):
            word, symbols = self._fall_back(word, symbols, unknown)
        counts = np.bincount(word, minlength=len(words))
        return symbols.astype(np.int32), counts

    def _merge(self, code: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge rounds until no pair remains: places (first character) and symbols in text order."""
        symbol, place = self.symbol[code], np.arange(len(code))
        # A segment ends where the word does, or between characters that stand side by side in no piece.
        pair = (code[:-1] << _SHIFT) | code[1:]
        at = np.minimum(np.searchsorted(self.touching, pair), len(self.touching) - 1)
        joined = (self.touching[at] == pair) & (word[:-1] == word[1:])
        segment = np.concatenate(([0], np.cumsum(~joined))) if len(code) else np.zeros(0, np.int64)
        merged, rank = np.zeros(len(code), np.int32), np.full(len(code), _NONE, np.int32)
        inner = np.flatnonzero(joined)
        merged[inner], rank[inner] = self.look_up(symbol[inner], symbol[inner + 1])
        done_place, done_symbol = [], []
        while len(symbol):
            starts = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
            sizes = np.diff(np.append(starts, len(symbol)))
            least = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            over = least == _NONE
            if over.any():
                done_place.append(place[over])
                done_symbol.append(symbol[over])
                live = ~over
                symbol, place, segment, merged, rank, least = (x[live] for x in (symbol, place, segment, merged, rank, least))
                if not len(symbol):
                    break
            hit = np.flatnonzero(rank == least)
            if len(hit) > 1:
                # Of overlapping places every second one, from the left; of an eager piece the leftmost alone.
                new_run = np.concatenate(([True], np.diff(hit) != 1))
                first = np.maximum.accumulate(np.where(new_run, np.arange(len(hit)), 0))
                take = (np.arange(len(hit)) - first) % 2 == 0
                held = segment[hit]
                again = np.concatenate(([False], held[1:] == held[:-1]))
                eager = self.eager[merged[hit]]
                if (again & eager).any():
                    lead = np.flatnonzero(~again)
                    bad = np.repeat(np.logical_or.reduceat(eager, lead), np.diff(np.append(lead, len(hit))))
                    take &= ~(again & bad)
                hit = hit[take]
            symbol[hit] = merged[hit]
            keep = np.ones(len(symbol), bool)
            keep[hit + 1] = False
            new = (np.cumsum(keep) - 1)[hit]
            symbol, place, segment, merged, rank = (x[keep] for x in (symbol, place, segment, merged, rank))
            # Ranks change only at the merged symbols and before them.
            touched = np.zeros(len(symbol), bool)
            touched[new] = touched[np.maximum(new - 1, 0)] = True
            at = np.flatnonzero(touched)
            last = (at + 1 >= len(symbol)) | (segment[np.minimum(at + 1, len(symbol) - 1)] != segment[at])
            rank[at[last]] = _NONE
            at = at[~last]
            merged[at], rank[at] = self.look_up(symbol[at], symbol[at + 1])
        if not done_place:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        place, symbol = np.concatenate(done_place), np.concatenate(done_symbol)
        by = np.argsort(place, kind="stable")
        return place[by], symbol[by]

    def _fall_back(self, word, symbols, unknown):
        """Characters without a piece become the pieces of their bytes."""
        spelled = [chr(s - self.size).encode() for s in symbols[unknown].tolist()]
        repeats = np.ones(len(symbols), np.int64)
        repeats[unknown] = [len(b) for b in spelled]
        out = np.repeat(symbols, repeats)
        ends = np.cumsum(repeats)
        spots = np.concatenate([np.arange(e - len(b), e) for e, b in zip(ends[unknown], spelled, strict=True)])
        out[spots] = self.byte_ids[np.frombuffer(b"".join(spelled), np.uint8)]
        return np.repeat(word, repeats), out

    def decode(self, ids: list[int]) -> str:
        """As the library does: marks become spaces, a first mark goes, broken bytes become U+FFFD one by one."""
        if not ids:
            return ""
        get = self.decoded
        raw = b"".join([get[i] for i in ids])
        if self.opens[ids[0]]:
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return "".join(_lenient(raw))


def _lenient(raw: bytes) -> Iterator[str]:
    at = 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                yield raw[at : at + n].decode()
            except UnicodeDecodeError:
                continue
            at += n
            break
        else:
            yield "�"
            at += 1


class WordMemory:
    """Words met so far and their ids, flat; words are told apart by their whole text (or bytes)."""

    def __init__(self, encode, limit: int = REMEMBERED_CHARS):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.index: dict = {}
        self.flat, self.starts, self.counts = np.zeros(1 << 16, np.int32), np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.used = self.held = 0

    def numbers(self, words: list) -> np.ndarray:
        """The number of each word; words that haven't been met are encoded. A call may forget earlier numbers."""
        if self.held > self.limit:
            self.clear()
        new = list(dict.fromkeys(w for w in words if w not in self.index))
        if new:
            flat, counts = self.encode(new)
            base, more = len(self.index), len(new)
            self.flat = _with_room(self.flat, self.used + len(flat))
            self.starts, self.counts = _with_room(self.starts, base + more), _with_room(self.counts, base + more)
            self.flat[self.used : self.used + len(flat)] = flat
            self.starts[base : base + more] = self.used + np.cumsum(counts) - counts
            self.counts[base : base + more] = counts
            self.used += len(flat)
            self.held += sum(map(len, new)) + 32 * more
            self.index.update(zip(new, range(base, base + more), strict=True))
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))

    def spelled(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all numbered words in order, and the count of each."""
        counts = self.counts[at]
        ends = np.cumsum(counts)
        return self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[at] - ends + counts, counts)], counts

    def ids(self, words: list) -> tuple[np.ndarray, np.ndarray]:
        return self.spelled(self.numbers(words))


def _with_room(array: np.ndarray, size: int) -> np.ndarray:
    """The array, or one of at least twice its length that begins with it."""
    return array if size <= len(array) else np.concatenate((array, np.zeros(max(size, 2 * len(array)) - len(array), array.dtype)))


@cache
def vocabulary_of(path: str) -> PieceVocabulary:
    """One for each worker process and file."""
    return PieceVocabulary(path)


def text_slices(texts: list[str | None], chars: int = SLICE_CHARS) -> Iterator[list[str]]:
    """Consecutive texts of about ``chars`` characters together; one text is never cut."""
    part, held = [], 0
    for t in texts:
        part.append(t or "")
        held += len(part[-1])
        if held >= chars:
            yield part
            part, held = [], 0
    if part:
        yield part


def per_text_counts(counts: np.ndarray, words_per_text: list[int]) -> np.ndarray:
    """Sums of ``counts`` over the words of each text."""
    ends = np.cumsum(np.asarray(words_per_text, np.int64))
    total = np.concatenate(([0], np.cumsum(counts)))
    return np.diff(total[np.concatenate(([0], ends))])


def with_column(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    kept = [k for k, n in enumerate(batch.schema.names) if n != name]
    return pa.RecordBatch.from_arrays([batch.column(k) for k in kept] + [values], [batch.schema.names[k] for k in kept] + [name])


def with_field(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name != name] + [T.StructField(name, kind)])


def encode(df: DataFrame, model_path: str, text_col: str = "text", out_col: str = "ids", keep_text: bool = True) -> DataFrame:
    """Add ``out_col``: the ids of each whole text, without begin or end ids."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordMemory(vocabulary_of(model_path).encode_words)
        for batch in batches:
            flats, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
            for part in text_slices(batch.column(text_col).to_pylist()):
                words, sizes = [], []
                for text in part:
                    found = _WORD.findall(MARK + text.replace(" ", MARK)) if text else []
                    words += found
                    sizes.append(len(found))
                flat, each = memory.ids(words)
                flats.append(flat)
                counts.append(per_text_counts(each, sizes))
            offsets = np.concatenate(([0], np.cumsum(np.concatenate(counts))))
            values = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(flats), pa.int32()))
            out = batch if keep_text else batch.drop_columns([text_col])
            yield with_column(out, out_col, values)

    source = df.drop(out_col)
    schema = source.schema if keep_text else T.StructType([f for f in source.schema.fields if f.name != text_col])
    return source.mapInArrow(run, with_field(schema, out_col, T.ArrayType(T.IntegerType())))


def decode(df: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded", keep_ids: bool = True) -> DataFrame:
    """Add ``out_col``: the text that the ids of each row spell."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(model_path)
        for batch in batches:
            column = batch.column(ids_col)
            offsets, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
            present = column.is_valid().to_pylist()
            texts = [vocabulary.decode(flat[a:b].tolist()) if ok else "" for a, b, ok in zip(offsets[:-1], offsets[1:], present, strict=True)]
            out = batch if keep_ids else batch.drop_columns([ids_col])
            yield with_column(out, out_col, pa.array(texts, pa.string()))

    source = df.drop(out_col)
    schema = source.schema if keep_ids else T.StructType([f for f in source.schema.fields if f.name != ids_col])
    return source.mapInArrow(run, with_field(schema, out_col, T.StringType()))
