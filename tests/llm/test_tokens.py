"""Encoding, decoding and packing against the libraries and by round trip."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parcelforge.llm import packing, piece_bpe
from parcelforge.llm.queries import QUERIES, tokenizer_file

ODD = ["", " ", "  a  b ", "Hello\nworld\t!", "aaaa aaaaaaa", "don't It'sABC x's", "a—b, é. ½x", "<|endoftext|> hi <|ENDOFTEXT|>", "ΣΑΣ İstanbul 123abc #12!", "中文 テスト 🎉", "ﬁ Å ß ǅ", "12.5% (a)b[c]_d_", "x" * 5000, "▁ ▁▁a", "\x00\x01", None]


def test_pieces_equal_the_library(small_docs, make_docs):
    import sentencepiece

    path = tokenizer_file("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    docs = small_docs.select("doc_id", "text").unionByName(make_docs([(10_000 + k, t) for k, t in enumerate(ODD)]).select("doc_id", "text"))
    found = piece_bpe.decode(piece_bpe.encode(docs, path), path).collect()
    assert len(found) == 200 + len(ODD)
    for r in found:
        ids = model.encode(r["text"] or "")
        assert r["ids"] == ids, r["doc_id"]
        assert r["decoded"] == model.decode(ids), r["doc_id"]


def test_pieces_keep_other_columns_and_empty_tables(make_docs):
    path = tokenizer_file("piece_bpe_32k.model")
    found = piece_bpe.encode(make_docs(["a b"]).withColumn("ids", F.lit("old")), path)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids"] and found.schema["ids"].dataType.simpleString() == "array<int>"
    assert piece_bpe.encode(make_docs(["a"]).limit(0), path).count() == 0


def test_units_equal_the_library():

    path = tokenizer_file("word_bpe_49k.json")
    texts = [t for t in ODD if t is not None]
    flat, counts = packing.UnitTokenizer(path)(texts)
    got = np.split(flat, np.cumsum(counts)[:-1])
    for text, ids, want in zip(texts, got, Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids.tolist() == want.ids, text


def check_packing(pieces, texts, length=2048):
    """Every id lies in exactly one piece, sequences have no gaps and no overlaps."""

    tokenizer = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(texts)
    for doc, own in by_doc.items():
        ids = np.array([*tokenizer.encode(texts[doc] or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= length
    return len(by_sequence)


def test_packing_is_whole_and_dense(spark, sf_dir, small_docs):
    pieces = QUERIES["op3_packing"](spark, sf_dir).collect()
    sequences = check_packing(pieces, {r["doc_id"]: r["text"] for r in small_docs.select("doc_id", "text").collect()})
    assert sequences <= sum(r["length"] for r in pieces) / 2048 + 2


def test_packing_of_odd_texts(make_docs):
    docs = make_docs([*ODD, "word " * 9000]).repartition(7)
    pieces = packing.pack(docs, tokenizer_file("word_bpe_49k.json")).withColumn("ids_crc32", F.crc32("ids")).collect()
    check_packing(pieces, {k: t for k, t in enumerate([*ODD, "word " * 9000])})
    assert packing.pack(docs.limit(0), tokenizer_file("word_bpe_49k.json")).count() == 0


@pytest.mark.parametrize("sizes", [[1], [2048], [2049, 5], [100] * 50, [3000, 1, 2047, 4096]])
def test_windows_hold_each_id_once(sizes):
    packer = packing.Packer(2048, 3)
    out = [p for d, n in enumerate(sizes) for p in packer.add(d, np.arange(n))]
    whole, left = packer.finish()
    for d, n in enumerate(sizes):
        assert sorted(x for p in [*out, *whole, *left] if p[0] == d for x in p[2].tolist()) == list(range(n))
    assert sum(len(p[2]) for p in left) < 2048


def thue_morse(n, a, b):
    """Letters that collide, with their exchange, under every polynomial modulo two to the 64th from 1,024 on."""
    return "".join(a if k.bit_count() % 2 == 0 else b for k in range(n))


def test_units_are_told_apart_by_their_bytes():
    texts = [thue_morse(n, *ab) for n in (1024, 2048, 4096) for ab in ("ab", "ba")]
    path = tokenizer_file("word_bpe_49k.json")
    flat, counts = packing.UnitTokenizer(path)(texts)
    whole = Tokenizer.from_file(path)
    assert [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_remembered_words_are_bounded_by_their_characters():
    memory = piece_bpe.WordMemory(lambda words: (np.arange(len(words)), np.ones(len(words), np.int64)), limit=100)
    for k in range(50):
        assert memory.ids([f"word{k}", "x" * k])[1].tolist() == [1, 1]
        assert memory.held <= 100 + 2 * (32 + 60)
