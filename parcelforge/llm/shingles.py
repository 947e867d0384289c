"""Words and word shingles of whole texts as flat hash arrays.

Words are runs of bytes other than the space and 0x09-0x0D; A-Z count as a-z. Texts are laid end to end and handled a
slice at a time. Each distinct word of a slice is hashed once, by SipHash, a keyed hash whose collisions don't follow from
the structure of words. Hashes of one key make the shingle hashes that sets consist of; those of a second one go into the
128-bit digest by which whole sets are told to be equal (``digested_sets``). Where it matters whether two texts really share
shingles, ``exact_sets`` tells words apart by their bytes and shingles by their words, without hashes.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pandas.util import hash_array

from .piece_bpe import text_slices

#: Words of a shingle.
WIDTH = 5
#: Characters handled at a time; one text is never cut.
SLICE_CHARS = 1 << 20
_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
#: The two keys of word hashes.
KEYS = ("words of shingle", "their other half")


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the splitmix finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def distinct_stretches(data: bytes, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """For each stretch of bytes between consecutive offsets the number of its value, and the values by number."""
    stretches = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])
    found = stretches.dictionary_encode()
    return found.indices.to_numpy(), found.dictionary


def word_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray, keys: tuple[str, ...] = KEYS[:1]) -> list[np.ndarray]:
    """For each key the hash of each word ``data[start:end]``; words are in order and don't touch."""
    if not len(starts):
        return [np.zeros(0, np.uint64) for _ in keys]
    number, found = distinct_stretches(data, np.stack((starts, ends), 1).reshape(-1))
    values = np.empty(len(found), object)
    values[:] = found.to_pylist()  # white space too, which is never asked for
    return [hash_array(values, hash_key=key, categorize=False)[number[::2]] for key in keys]


@dataclass
class Words:
    """The words of consecutive texts: hashes (and those of the second key), byte places in ``data``, and where each text's
    words begin."""

    data: bytes
    hashes: np.ndarray
    others: np.ndarray | None
    starts: np.ndarray
    ends: np.ndarray
    firsts: np.ndarray  # len(texts) + 1
    bases: np.ndarray  # first byte of each text


def words_of(texts: list[str], keys: tuple[str, ...] = KEYS[:1]) -> Words:
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = b" ".join([*raw, b""]).translate(LOWER)
    code = np.frombuffer(data, np.uint8)
    space = _SPACE[code]
    before = np.concatenate(([True], space[:-1])) if len(code) else space
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
    hashes, *others = word_hashes(data, starts, ends, keys)
    bases = np.concatenate((np.zeros(1, np.int64), np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)))
    return Words(data, hashes, others[0] if others else None, starts, ends, np.searchsorted(starts, bases), bases[:-1])


def shingle_hashes(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The hash of every ``width`` consecutive words; of fewer words, of all as one."""
    if not len(words):
        return words
    if len(words) < width:
        width = len(words)
    n = len(words) - width + 1
    out = words[:n] * _U(0xD6E8FEB86659FD93) + _U(width)
    for k in range(1, width):
        out = mix(out) + words[k : k + n]
    return mix(out)


def digested_sets(texts: list[str | None], width: int = WIDTH) -> Iterator[tuple[np.ndarray, bytes]]:
    """For each text the sorted distinct hashes of its shingles (empty without words) and a 128-bit digest of the set."""
    for part in text_slices(texts, SLICE_CHARS):
        found = words_of(part, KEYS)
        # Rows that straddle two texts are passed over.
        whole, twin = shingle_hashes(found.hashes, width), shingle_hashes(found.others, width)
        for a, b in zip(found.firsts[:-1].tolist(), found.firsts[1:].tolist(), strict=True):
            if b - a >= width:
                own, other = whole[a : b - width + 1], twin[a : b - width + 1]
            else:
                own, other = shingle_hashes(found.hashes[a:b], width), shingle_hashes(found.others[a:b], width)
            once, first = np.unique(own, return_index=True)
            yield once, blake2b(np.concatenate((once, other[first])).tobytes(), digest_size=16).digest()


def shingle_sets(texts: list[str | None], width: int = WIDTH) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles (empty without words)."""
    for part in text_slices(texts, SLICE_CHARS):
        found = words_of(part)
        whole = shingle_hashes(found.hashes, width)  # rows that straddle two texts are passed over below
        for a, b in zip(found.firsts[:-1].tolist(), found.firsts[1:].tolist(), strict=True):
            yield np.unique(whole[a : b - width + 1] if b - a >= width else shingle_hashes(found.hashes[a:b], width))


def exact_sets(texts: list[str | None], width: int = WIDTH) -> Iterator[np.ndarray]:
    """For each text its distinct shingles as sorted numbers that are equal, within one call, just where words are."""
    found = words_of([t or "" for t in texts])
    if not len(found.starts):
        yield from (np.zeros(0, np.int64) for _ in texts)
        return
    number, _ = distinct_stretches(found.data, np.stack((found.starts, found.ends), 1).reshape(-1))
    word = number[::2].astype(np.int64)  # words and the white space between them stand by turns
    grown, least, short = word, int(word.max()) + 1, []
    for k in range(1, width):
        short.append(grown)
        grown = np.unique(grown[: len(word) - k] * least + word[k:], return_inverse=True)[1] if len(word) > k else np.zeros(0, np.int64)
    for a, b in zip(found.firsts[:-1].tolist(), found.firsts[1:].tolist(), strict=True):
        if b - a >= width:
            yield np.unique(grown[a : b - width + 1])
        else:  # below zero by the number of words, so that sequences of different lengths differ
            yield np.array([-1 - (int(short[b - a - 1][a]) * width + b - a)] if b > a else [], np.int64)
