"""Token shards: round trips, the hash index, keyed access."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from medalith.llm import token_store
from medalith.session import work_dir

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


TEXTS = [
    "Hello World", "", None, "don't  stop\n\nnow\t!", "İSTANBUL ΣΊΣΥΦΟΣ ΟΔΟΣ", "é é ﬁ", "<|endoftext|> a<|startoftext|>b",
    "日本語 テキスト", "x" * 5000, "a b\x0bc　d", "\n \n", "Ünïcode ́ accent",
]


def test_pieces_encode_as_whole_texts(library):
    texts = [t or "" for t in TEXTS] * 2
    found = token_store.PieceEncoder(PATH).encode(texts)
    assert [np.frombuffer(f, dtype="<u4").tolist() for f in found] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_known_pieces_are_bounded(library, monkeypatch):
    monkeypatch.setattr(token_store, "KNOWN_PIECES", 5)
    encoder = token_store.PieceEncoder(PATH)
    for k in range(5):
        (found,) = encoder.encode([f"one two three {k} four five six seven"])
        assert np.frombuffer(found, dtype="<u4").tolist() == library.encode(f"one two three {k} four five six seven", add_special_tokens=False).ids
    assert len(encoder.known) <= 5 and len(encoder.known.old) <= 5


def test_odd_texts_encode_as_the_library_does(library):
    pick = random.Random(3)
    pieces = ["The", "IS", "word", ",", ".", "...", "!?", "'s", "'LL", " ", "\n", "\t", "É", "ß", "Σ", "H\u0331", "I\u0307", "T\u0308", "<|", "ENDOFTEXT", "|>",
              "<|endoftext|>", "日本", "ǅ", "\u0250", "1", "a\u02beb", "ſ", "\u212a", "x" * 70, "é.", "-", "\xa0"]
    texts = ["".join(pick.choice(pieces) for _ in range(pick.randint(1, 14))) for _ in range(4000)]
    found = token_store.PieceEncoder(PATH).encode(texts)
    for text, ids in zip(texts, found, strict=True):
        assert np.frombuffer(ids, dtype="<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("size", [1, 2, 3, 10, 1000, 20000])
def test_index_is_minimal_and_perfect(size):
    keys = np.unique(np.random.default_rng(size).integers(-(2**62), 2**62, size))
    pilots = token_store.build_pilots(keys)
    slots = token_store._slots(token_store._hashes(keys), pilots, len(keys))
    assert sorted(slots.tolist()) == list(range(len(keys)))


def written(spark, rows, schema="doc_id long, text string"):
    path = work_dir(spark, "tokens")
    token_store.write_store(spark.createDataFrame(rows, schema), path, PATH)
    return path


def expected(library, rows):
    """Digests by plain encoding in ascending order of id and text."""
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, result = 0, []
    for doc, text in ordered:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        result.append((doc, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return result


def test_digests_and_lookup(spark, library):
    rows = [(i * 7 - 20, t) for i, t in enumerate(TEXTS)] + [(None, "no key"), (1, "repeated key b"), (1, "repeated key a"), (2**62, "far")]
    path = written(spark, rows)
    found = sorted([tuple(r) for r in token_store.document_digests(spark, path).collect()], key=lambda r: r[1])
    assert found == expected(library, rows)
    keys = spark.createDataFrame([(-20,), (1,), (2**62,), (3,), (None,), (-999,), (1,)], "doc_id long")
    looked_up = {r.doc_id: list(r.ids) for r in token_store.lookup(spark, path, keys).collect()}
    by_key = {-20: TEXTS[0], 1: "repeated key a" if TEXTS[3] > "repeated key a" else TEXTS[3], 2**62: "far"}
    assert looked_up == {k: [*library.encode(t or "", add_special_tokens=False).ids, 1] for k, t in by_key.items()}


def test_many_shards(spark, library):
    parts = []
    keys = list(range(0, 3000, 3))
    for shard in range(4):
        own = keys[shard * 250 : (shard + 1) * 250]
        ids = [np.arange(k % 50 + 1, dtype="<u4").tobytes() for k in own]
        parts.append(token_store.Shard(token_store.pack_shard(0, shard, own, ids) + b"\n"))
    for shard, part in enumerate(parts):
        asked = np.arange(-5, 3100)
        places = part.find(asked)
        own = keys[shard * 250 : (shard + 1) * 250]
        assert asked[places >= 0].tolist() == own
        assert all(part.ids(p).tolist() == list(range(k % 50 + 1)) for k, p in zip(asked, places, strict=True) if p >= 0)


def test_wide_ids():
    ids = np.array([1, 70_000], dtype="<u4")
    shard = token_store.Shard(token_store.pack_shard(0, 0, [5], [ids.tobytes()]))
    assert shard.header["width"] == 4 and shard.ids(0).tolist() == [1, 70_000]


def test_empty_table(spark):
    path = written(spark, [])
    assert token_store.document_digests(spark, path).count() == 0
    keys = spark.createDataFrame([(1,)], "doc_id long")
    assert token_store.lookup(spark, path, keys).count() == 0


def test_other_columns_do_not_matter(spark):
    schema = "doc_id long, text string, content string, part int, keys string, path string"
    path = written(spark, [(1, "a text", "x", 1, "y", "z")], schema)
    assert token_store.document_digests(spark, path).count() == 1
