"""Byte-level BPE against the tokenizers library, and round trips."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from medalith.llm import byte_bpe, frames

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.vocabulary(PATH)


def ids(data):
    return np.frombuffer(data, dtype="<u4").tolist()


EDGES = [
    "", " ", "  ", "   a", "a  ", "a\n \nb", "\n\n x", "a   b", "don't we'll I'M", "<|endoftext|>", "x<|endoftext|> <|endoftext|>y ",
    "<|endoftext", "日本語 テキスト", "é \U0001f600‍", "0123456789" * 30, "a" * 3000, "\x00\x1f\x85  z", "aAaA" * 500 + " " * 50,
]


@pytest.mark.parametrize("text", EDGES)
def test_edges(bpe, library, text):
    expected = library.encode(text, add_special_tokens=False).ids
    assert ids(bpe.encode(text)) == expected
    assert bpe.decode(bpe.encode(text)) == library.decode(expected, skip_special_tokens=False) == text


def test_random_texts(bpe, library):
    pick = random.Random(1)
    pieces = ["<|endoftext|>", " ", "\n", "\t", "\r\n", "a", "The", "'s", "é", "1", "!!", " ", "日本", "ab'll", "ing", "-", "　"]
    for _ in range(3000):
        text = "".join(pick.choice(pieces) for _ in range(pick.randint(1, 14)))
        assert ids(bpe.encode(text)) == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_every_character(bpe, library):
    characters = [chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(characters), 128):
        text = "".join(f"a{c} {c}{c}b" for c in characters[start : start + 128])
        assert ids(bpe.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_broken_ids_decode_leniently(bpe, library):
    half = bpe.encode("é")[:4] if len(bpe.encode("é")) > 4 else np.array([bpe.byte_ids[0xC3]], dtype="<u4").tobytes()
    assert bpe.decode(half + np.array([10**9], dtype="<u4").tobytes()) == library.decode(ids(half), skip_special_tokens=False)


def test_merges_take_the_lowest_rank_then_the_leftmost():
    merges = byte_bpe.Merges([(1, 0, 2), (0, 0, 1), (1, 1, 3)])
    assert byte_bpe.merge_symbols([0] * 5, merges) == [2, 1]
    assert byte_bpe.merge_symbols([0, 0, 0, 0], merges) == [2, 0]
    assert byte_bpe.merge_symbols([], merges) == []


def test_known_pieces_are_bounded():
    known = byte_bpe._Known(str.encode, 3)
    for word in ("a", "b", "c", "d", "x" * 1000, "a"):
        assert known[word] == word.encode()
    assert set(known) == {"d", "a"} and set(known.old) == {"a", "b", "c"}


def test_columns(spark):
    rows = [(1, "Hello there"), (2, None), (3, ""), (1, "Hello there"), (None, "a<|endoftext|>")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", byte_bpe.encode(F.col("text"), PATH))
    found = docs.withColumn("back", byte_bpe.decode(F.col("ids"), PATH)).collect()
    assert [(r.doc_id, r.back) for r in found] == [(d, t or "") for d, t in rows]
    assert byte_bpe.id_list(bytes(found[4]["ids"]))[-1] == 50256


def test_round_trip_of_a_table_leaves_no_known_words(spark):
    texts = [*EDGES, "some words some words", "more words here"]
    docs = spark.createDataFrame([(k, t, None) for k, t in enumerate(texts)], "doc_id long, text string, lang string").coalesce(1)
    found = {r.doc_id: r for r in byte_bpe.with_round_trip(docs, PATH, 50).collect()}
    plain = byte_bpe.ByteBpe(PATH)
    assert all(bytes(found[k].ids) == plain.encode(t) and found[k].round_trip and found[k].lang is None for k, t in enumerate(texts))

    def left(batches):
        for batch in batches:
            known = byte_bpe.vocabulary(PATH, 50)
            n = sum(len(k) + len(k.old) for k in (known.words, known.plain, known.spaced))
            yield pa.RecordBatch.from_arrays([pa.array([n] * len(batch), pa.int64())], names=["n"])

    assert {r.n for r in docs.select("doc_id").mapInArrow(left, "n long").collect()} == {0}


def test_workers_give_memory_back(monkeypatch):
    rows = 2 * frames.ROWS_AT_ONCE + 1
    calls = []

    class Pool:
        def release_unused(self):
            calls.append({len(known) for known in (bpe.words, bpe.plain, bpe.spaced)})

    bpe = byte_bpe.vocabulary(PATH, 1234)
    batch = pa.RecordBatch.from_pydict({"doc_id": range(rows), "text": [f"some text {k}" for k in range(rows)]})
    monkeypatch.setattr(pa, "default_memory_pool", Pool)
    found = list(frames.released(byte_bpe._round_trip(PATH, 1234, ["doc_id"]))(iter([batch])))
    assert [b.num_rows for b in found] == [frames.ROWS_AT_ONCE, frames.ROWS_AT_ONCE, 1]
    assert [k for b in found for k in b.column("doc_id").to_pylist()] == list(range(rows))
    assert all(all(b.column("round_trip").to_pylist()) for b in found)
    assert calls == [{0}]  # once, after the known pieces are forgotten
