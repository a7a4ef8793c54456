"""Aligned tokens against whole texts encoded by the libraries and linked pair by pair."""

import random
from collections import Counter
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tokenizers import Tokenizer

from medalith.llm import alignment

A_PATH = public_tokenizers.path("byte_bpe_50k.json")
B_PATH = public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_PATH), alignment.ByteVocabulary(A_PATH)


def spans(tokens):
    at, found = 0, []
    for token in tokens:
        found.append((at, at + len(token)))
        at += len(token)
    return found


def plain(texts, libraries):
    """The result for each text: every token of A against every token of B."""
    a_library, b_library, a_bytes = libraries
    rows, counts = [], Counter()
    for text in texts:
        a, b = a_library.encode(" " + (text or ""), add_special_tokens=False).ids, b_library.encode(text or "")
        pieces = [bytes([int(p[3:5], 16)]) if b_library.is_byte(k) else p.replace("▁", " ").encode() for k, p in ((k, b_library.id_to_piece(k)) for k in b)]
        whole = b" " + (text or "").encode()
        if not text or b"".join(a_bytes.bytes[k] for k in a) != whole or b"".join(pieces) != whole:
            rows.append(([], [], "", []))
            continue
        x, y = spans([a_bytes.bytes[k] for k in a]), spans(pieces)
        links = [(a[i], b[j]) for i, (p, q) in enumerate(x) for j, (r, s) in enumerate(y) if max(p, r) < min(q, s)]
        ends = sorted({q for _, q in x} & {s for _, s in y})
        groups, begin = [], 0
        for end in ends:
            sides = [",".join(str(k) for k, (p, q) in zip(ids, at, strict=True) if begin <= p and q <= end) for ids, at in ((a, x), (b, y))]
            groups.append("|".join(sides))
            begin = end
        counts.update(links)
        rows.append((a, b, ";".join(groups), links))
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [
        (len(a), len(b), groups.count(";") + 1 if groups else 0, len(links), sum(counts[k] == most[k[1]] for k in links), sum(counts[k] for k in links), groups)
        for a, b, groups, links in rows
    ]


def found(spark, rows, **size):
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a string, groups int")
    result = alignment.align(spark, docs, A_PATH, B_PATH, **size)
    return sorted(((r.doc_id, *[r[c] for c in COLUMNS]) for r in result.collect()), key=str)


EDGES = [
    "", None, " ", "  ", "a", " a", "a ", "a  b", "a   b c", "a \nb", "a\n b", "\n\n x\n", "\ta\t b", "don't we'll I'M", "<|endoftext|> <s></s><unk>",
    "日本語 テキスト", "a　b c", "é \U0001f600‍ x", "▁", "a ▁ b", "x ▁▁y", "0123456789" * 30, "a" * 3000, "ab " * 3000, "\x00\x1f\x85  z", "a \xa0 b",
    "<0x41> A", "ﬁ ﬀ", "the the the idiot the",
]


def test_edges(spark, libraries):
    rows = [(k, text, "x", 1) for k, text in enumerate(EDGES)] + [(None, "the end", None, None), (3, "the end", "", 0), (3, "the end", "", 0)]
    expected = plain([r[1] for r in rows], libraries)
    assert found(spark, rows) == sorted(((r[0], *e) for r, e in zip(rows, expected, strict=True)), key=str)


def test_random_texts(spark, libraries):
    pick = random.Random(5)
    parts = [" ", " ", " ", "\n", "\t", "  ", "a", "The", "'s", "é", "1", "!!", "日本", "ab'll", "ing", "-", "　", "thnt", "▁", "<s>", "\x1f"]
    texts = ["".join(pick.choice(parts) for _ in range(pick.randint(1, 30))) for _ in range(400)]
    rows = [(k, t, None, None) for k, t in enumerate(texts)]
    assert found(spark, rows) == sorted(((k, *e) for k, e in enumerate(plain(texts, libraries))), key=str)


def test_given_documents(spark, libraries):
    table = pq.read_table("/root/testdata/sf0.001/documents.parquet")
    rows = [(i, t, None, None) for i, t in zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True) if len(t or "") < 3000]
    assert found(spark, rows, size=5000) == sorted(((r[0], *e) for r, e in zip(rows, plain([r[1] for r in rows], libraries), strict=True)), key=str)


def test_small_steps_and_chunks(monkeypatch, libraries):
    monkeypatch.setattr(alignment, "STEP", 3)
    monkeypatch.setattr(alignment, "CHUNK", 7)
    texts = ["one two three four five six seven", "a  b  c d e f g h i j", "nospaceatallinthistext", " x ▁ y"]
    block = alignment._Block()
    for k, text in enumerate(texts):
        block.add(k, text)
    row = block.content(alignment.aligner(A_PATH, B_PATH))[-1]
    begin = 0
    for text, end, expected in zip(texts, row["doc_ends"].tolist(), plain(texts, libraries), strict=True):
        assert b";".join(row["groups"][k] for k in row["numbers"][begin:end].tolist()).decode() == expected[-1], text
        begin = end


def test_no_documents(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, None, None, None)]) == [(None, 0, 0, 0, 0, 0, 0, "")]


def test_pair_counts(spark):
    docs = spark.createDataFrame([(1, "the cat the"), (2, "the")], "doc_id long, text string")
    counts = alignment.pair_counts(alignment.blocks(spark, docs, A_PATH, B_PATH)).collect()
    assert sorted(r.n for r in counts) == [1, 3] and all(r.best for r in counts)


def test_memory_does_not_grow_with_the_blocks_of_a_task(spark, monkeypatch):
    """Sixteen blocks of more than 2 MB in one task: small row groups, and a worker gets one block at a time."""
    groups = []
    rows = spark.range(0, 16, 1, 1).selectExpr("id AS block", "array(id) AS pairs", "array(1L) AS pair_links", "randstr(2500000, CAST(1 AS INT)) AS content")
    rows = rows.withColumn("content", rows.content.cast("binary"))
    monkeypatch.setattr(alignment, "id_and_text", lambda _: rows)
    monkeypatch.setattr(alignment, "_blocks", lambda *_: lambda batches: batches)
    monkeypatch.setattr(alignment, "_BLOCK_SCHEMA", rows.schema)
    aligned = alignment.blocks(spark, None, A_PATH, B_PATH)
    for file in aligned.inputFiles():
        meta = pq.ParquetFile(file.removeprefix("file:")).metadata
        groups += [meta.row_group(k).num_rows for k in range(meta.num_row_groups)]
    assert sum(groups) == 16 and max(groups) <= 12

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("block")
            zeros = pa.array([batch.num_rows] * len(ids), pa.int64())
            yield pa.RecordBatch.from_arrays([ids, *[zeros] * 6, pa.array([""] * len(ids))], names=["doc_id", *COLUMNS])

    monkeypatch.setattr(alignment, "_documents", counted)
    found = alignment.documents(aligned, alignment.pair_counts(aligned)).select("doc_id", "n_a").collect()
    assert sorted(found) == [(k, 1) for k in range(16)]
