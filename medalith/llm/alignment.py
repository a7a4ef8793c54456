"""Alignment of two tokenizers' tokens over the same texts, and how often two tokens are linked.

A text is encoded by a byte-level vocabulary (A) and by a piece vocabulary (B). The cumulative byte ends of each side go
into a dictionary from end to index; the ends that both dictionaries have, in order, slice the two id lists into groups,
and the links of a group are its token pairs with overlapping bytes.

Neither side has a token that goes over a blank between two characters that are not white space: A's word pattern parts
them, and B's pieces are checked for it when they are loaded. So such blanks are common ends. A text is encoded and aligned between them: each
different segment once a block.

Counts over the corpus: a block of about ``BLOCK`` characters of text is one stored row: its different pairs with their
links and, packed, its different segments and the segments of each document. Pairs are summed per block before any
shuffle, meet the counts of the whole corpus in a join on the pair, and come back to their block as one list, which is at
most as long as the block has links. Documents themselves are never exploded. A very frequent pair is one row a block.

Defined results: a null or empty text, or one whose tokens do not give its bytes back on both sides (``▁`` in the text),
has no tokens: zeros, and '' as its groups. Documents with a null or repeated id are documents of their own; other
columns are ignored. Without documents the result is empty. The text of the groups is about six times as long as the
document's text and has to fit in a string of 2 GiB.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medalith.llm.byte_bpe import WORDS, byte_letters
from medalith.llm.frames import id_and_text, released, stored

BLOCK = 4 << 20
#: Segments that are aligned at a time; the dictionaries of their ends are what a worker needs most memory for.
STEP = 1 << 13
#: Longer segments are encoded by the library that needs n log n steps for one long word.
LONG_CHARS = 1000
#: Characters of a long text that are cut into segments at a time.
CHUNK = 1 << 20
#: A blank between two characters that are not white space.
BLANK = re.compile(r" (?=\S)(?<=\S )")
SPACE_MARK = "▁"
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


class _Vocabulary:
    """``bytes`` of each id; ``shown``: each id with a comma, then with the mark behind the last id of a group."""

    bytes: list[bytes]

    def _measure(self, last: str) -> None:
        self.lengths = np.array(list(map(len, self.bytes)), dtype=np.int64)
        self.shown = [f"{k}{mark}".encode() for k in range(len(self.bytes)) for mark in (",", last)]
        self.widths = np.array(list(map(len, self.shown)), dtype=np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))



class ByteVocabulary(_Vocabulary):
    """A byte-level BPE file; the ids of its merges are their ranks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
        made = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        tokens = [*byte_letters(), *made]
        ids = [model["vocab"][t] for t in tokens]
        if sorted(ids[:256]) != list(range(256)) or ids[256:] != list(range(256, len(ids))):
            raise ValueError(f"{path}: ids are not the ranks of the merges")
        self.bytes = [b""] * len(ids)
        for token, number in zip(tokens, ids, strict=True):
            self.bytes[number] = bytes(map(byte_of.__getitem__, token))
        self._measure("|")
        ranks = {b: number for number, b in enumerate(self.bytes)}
        self._ranked = tiktoken.Encoding("ranks", pat_str=WORDS.pattern, mergeable_ranks=ranks, special_tokens={})
        self._path, self._long = path, None

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text without long words."""
        return self._ranked.encode_to_numpy(text, disallowed_special=())

    def encode_long(self, text: str) -> list[int]:
        if self._long is None:
            self._long = tokenizers.Tokenizer.from_file(self._path)
            self._long.encode_special_tokens = True
            self._long.no_truncation()
            self._long.no_padding()
        return self._long.encode(text, add_special_tokens=False).ids


class PieceVocabulary(_Vocabulary):
    """A piece model that puts a blank before the text; a blank is U+2581 in its pieces."""

    def __init__(self, path: str):
        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self._model.id_to_piece(k) for k in range(self._model.get_piece_size())]
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces):
            raise ValueError(f"{path}: a piece goes over a blank")
        self.bytes = [self._bytes(k, piece) for k, piece in enumerate(pieces)]
        self._measure(";")

    def _bytes(self, number: int, piece: str) -> bytes:
        if self._model.is_byte(number):
            return bytes([int(_BYTE_PIECE.fullmatch(piece)[1], 16)])
        if self._model.is_control(number) or self._model.is_unknown(number):
            return b""
        return piece.replace(SPACE_MARK, " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


def end_index(ends: np.ndarray) -> dict[int, int]:
    """How many tokens end at or before each end."""
    return dict(zip(ends.tolist(), range(1, len(ends) + 1), strict=True))


def _at(index: dict[int, int], ends: list[int]) -> np.ndarray:
    return np.fromiter(map(index.__getitem__, ends), dtype=np.int64, count=len(ends))


def _ends(lengths) -> np.ndarray:
    return np.cumsum(np.fromiter(lengths, dtype=np.int64))


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the runs of ``values`` that end at ``ends``; empty runs have 0."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return np.diff(total[ends], prepend=0)


class Aligned:
    """Different segments one after the other: how many tokens, groups and links each has, links as ``a << 32 | b``, groups as text."""

    def __init__(self, texts: list[str], a: ByteVocabulary, b: PieceVocabulary):
        whole = [(" " + t).encode() for t in texts]
        self.broken = np.zeros(len(texts), dtype=bool)
        a_ids, b_lists = self._byte_ids(texts, a), b.encode(texts)
        b_ids = np.fromiter(chain.from_iterable(b_lists), dtype=np.int64)
        if b.decode(b_ids) != b"".join(whole):
            self.broken[:] = [b.decode(np.array(ids, dtype=np.int64)) != text for ids, text in zip(b_lists, whole, strict=True)]
            kept = [t for t, broken in zip(texts, self.broken, strict=True) if not broken]
            b_lists = [[] if broken else ids for ids, broken in zip(b_lists, self.broken, strict=True)]
            a_ids, b_ids = self._byte_ids(kept, a), np.fromiter(chain.from_iterable(b_lists), dtype=np.int64)
        stops = _ends(np.where(self.broken, 0, np.fromiter(map(len, whole), dtype=np.int64)))

        a_ends, b_ends = np.cumsum(a.lengths[a_ids]), np.cumsum(b.lengths[b_ids])
        a_index, b_index = end_index(a_ends), end_index(b_ends)
        common = sorted(a_index.keys() & b_index.keys())
        a_cut, b_cut = _at(a_index, common), _at(b_index, common)

        # the ends of both sides part a slice into stretches, each under one token of A and one of B: a link
        either = np.sort(np.concatenate([a_ends, b_ends]), kind="stable")
        either = either[np.diff(either, prepend=0) > 0]
        self.links = a_ids[np.searchsorted(a_ends, either)] << 32 | b_ids[np.searchsorted(b_ends, either)]
        stop = {name: np.searchsorted(ends, stops, side="right") for name, ends in zip("abgl", (a_ends, b_ends, common, either), strict=True)}
        self.n_a, self.n_b, self.n_groups, self.n_links = (np.diff(stop[name], prepend=0) for name in "abgl")

        # the tokens of a slice as text: those of A, then those of B, each with the mark behind it
        a_last, b_last = np.zeros(len(a_ids), dtype=np.int64), np.zeros(len(b_ids), dtype=np.int64)
        a_last[a_cut - 1], b_last[b_cut - 1] = 1, 1
        marked = np.empty(len(a_ids) + len(b_ids), dtype=np.int64)
        b_before = np.concatenate([[0], b_cut])[: len(b_cut)]
        marked[np.arange(len(a_ids)) + np.repeat(b_before, np.diff(a_cut, prepend=0))] = 2 * a_ids + a_last
        marked[np.arange(len(b_ids)) + np.repeat(a_cut, np.diff(b_cut, prepend=0))] = 2 * (len(a.bytes) + b_ids) + b_last
        shown = [*a.shown, *b.shown]
        text = b"".join(map(shown.__getitem__, marked.tolist()))
        at = np.concatenate([[0], np.cumsum(np.concatenate([a.widths, b.widths])[marked])])[stop["a"] + stop["b"]].tolist()
        self.groups = [text[begin : end - 1] for begin, end in zip([0, *at], at, strict=False)]

    @staticmethod
    def _byte_ids(texts: list[str], a: ByteVocabulary) -> np.ndarray:
        """Ids of A, of many segments at once where a blank between them parts them anyway."""
        parts, run = [], []
        for text in [*texts, None]:
            alone = text is None or len(text) > LONG_CHARS or text != text.strip() or not text
            if alone and run:
                parts.append(a.encode(" " + " ".join(run)))
                run = []
            if not alone:
                run.append(text)
            elif text is not None:
                parts.append(a.encode_long(" " + text) if len(text) > LONG_CHARS else a.encode(" " + text))
        return np.concatenate([np.asarray(p, dtype=np.int64) for p in parts]) if parts else np.zeros(0, dtype=np.int64)


class Aligner:
    """Two vocabularies; one instance per worker."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteVocabulary(a_path), PieceVocabulary(b_path)

    def segments(self, texts: list[str]) -> list[Aligned]:
        """How different segments align, ``STEP`` of them at a time."""
        return [Aligned(texts[first : first + STEP], self.a, self.b) for first in range(0, max(1, len(texts)), STEP)]


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def chunks(text: str) -> Iterator[str]:
    """Parts of about ``CHUNK`` characters, cut at blanks between segments; the blank goes."""
    start = 0
    while len(text) - start > CHUNK and (blank := BLANK.search(text, start + CHUNK)):
        yield text[start : blank.start()]
        start = blank.end()
    yield text[start:] if start else text


class _Numbers(dict):
    """A number for each different segment of a block; ``odd``: those that begin or end with white space, or are empty."""

    def __init__(self):
        super().__init__()
        self.odd: set[str] = set()

    def __missing__(self, segment: str) -> int:
        self[segment] = number = len(self)
        if not segment or segment[0].isspace() or segment[-1].isspace():
            self.odd.add(segment)
        return number

    def of(self, text: str) -> np.ndarray:
        segments = text.split(" ")
        numbers = np.fromiter(map(self.__getitem__, segments), dtype=np.int32, count=len(segments))
        if self.odd and not self.odd.isdisjoint(segments):  # not every blank parts segments
            segments = BLANK.split(text)
            numbers = np.fromiter(map(self.__getitem__, segments), dtype=np.int32, count=len(segments))
        return numbers


_CONTENT_TYPES = {
    "doc_ids": pa.list_(pa.int64()), "doc_ends": pa.list_(pa.int64()), "numbers": pa.list_(pa.int32()), "counts": pa.list_(pa.int32()),
    "groups": pa.list_(pa.binary()), "link_ends": pa.list_(pa.int64()), "links": pa.list_(pa.int32()),
}
#: For rows of megabytes. Without them a writer holds 100 rows before it looks at their size, and a reader a whole row group of 128 MB.
_LARGE_ROWS = {"parquet.page.size.row.check.min": 1, "parquet.block.size.row.check.min": 1, "parquet.block.size": 16 << 20}
_BLOCK_SCHEMA = "block long, pairs array<long>, pair_links array<long>, content binary"


def _packed(values: dict) -> bytes:
    """One row of lists as a compressed Arrow stream."""
    row = pa.RecordBatch.from_arrays([pa.array([values[k]], t) for k, t in _CONTENT_TYPES.items()], names=list(_CONTENT_TYPES))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, row.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(row)
    return sink.getvalue().to_pybytes()


class _Block:
    """Documents, up to about the size of a block; a longer text goes into one whole."""

    def __init__(self):
        self.numbers, self.doc_ids, self.words, self.lengths, self.size = _Numbers(), [], [], [], 0

    def add(self, doc_id: int | None, text: str) -> None:
        words = [self.numbers.of(chunk) for chunk in chunks(text)] if text else []
        self.doc_ids.append(doc_id)
        self.words += words
        self.lengths.append(sum(map(len, words)))
        self.size += len(text)

    def content(self, vocabularies: Aligner) -> tuple[np.ndarray, np.ndarray, dict]:
        """The pairs, how many links hold each, and the columns of ``_CONTENT_TYPES``."""
        found = vocabularies.segments(list(self.numbers))
        numbers = np.concatenate(self.words) if self.words else np.zeros(0, dtype=np.int32)
        ends = _ends(self.lengths)
        broken = np.concatenate([f.broken for f in found])
        if broken.any():  # the whole document has no tokens then
            gone = _sums(broken[numbers], ends) > 0
            numbers = numbers[~np.repeat(gone, self.lengths)]
            ends = _ends(np.where(gone, 0, self.lengths))
        pairs, places = np.unique(np.concatenate([f.links for f in found]), return_inverse=True)
        n_links = np.concatenate([f.n_links for f in found])
        times = np.repeat(np.bincount(numbers, minlength=len(n_links)), n_links)
        per_pair = np.bincount(places, weights=times, minlength=len(pairs)).astype(np.int64)
        met = per_pair > 0  # not the pairs of documents without tokens
        kept = np.where(met, np.cumsum(met) - 1, 0)
        counts = np.concatenate([np.stack([f.n_a, f.n_b, f.n_groups], axis=1) for f in found])
        content = {
            "doc_ids": self.doc_ids, "doc_ends": ends, "numbers": numbers, "counts": counts.ravel().astype(np.int32),
            "groups": list(chain.from_iterable(f.groups for f in found)), "link_ends": np.cumsum(n_links), "links": kept[places].astype(np.int32),
        }
        return pairs[met], per_pair[met], content

    def row(self, number: int, vocabularies: Aligner) -> pa.RecordBatch:
        pairs, links, content = self.content(vocabularies)
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), *[pa.array([v], pa.list_(pa.int64())) for v in (pairs, links)], pa.array([_packed(content)], pa.binary())],
            names=["block", "pairs", "pair_links", "content"],
        )


def _blocks(a_path: str, b_path: str, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabularies = aligner(a_path, b_path)
        number, block = TaskContext.get().partitionId() << 32, _Block()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                block.add(doc_id, text.as_py())
                if block.size >= size:
                    yield block.row(number, vocabularies)
                    number, block = number + 1, _Block()
        if block.doc_ids:
            yield block.row(number, vocabularies)

    return run


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of each block, with the corpus counts of the block's pairs."""
    for batch in batches:
        for k in range(batch.num_rows):
            with pa.ipc.open_stream(batch.column("content")[k].as_buffer()) as stream:
                content = stream.read_next_batch()
            row = {name: content.column(name)[0].values for name in content.schema.names}
            flat = {name: np.asarray(v) for name, v in row.items() if name not in ("doc_ids", "groups")}
            scored = batch.column("scored")[k].values
            pairs, at = np.asarray(batch.column("pairs")[k].values), np.zeros(0, dtype=np.int64)
            if scored is not None and len(scored):
                at = np.searchsorted(pairs, np.asarray(scored.field("pair")))
            count, best = np.zeros(len(pairs) + 1, dtype=np.int64), np.zeros(len(pairs) + 1, dtype=np.int64)
            if len(at):
                count[at], best[at] = np.asarray(scored.field("n")), np.asarray(scored.field("best"))
            links, link_ends, numbers, ends = flat["links"], flat["link_ends"], flat["numbers"], flat["doc_ends"]
            per_segment = [*flat["counts"].reshape(-1, 3).T, np.diff(link_ends, prepend=0), _sums(best[links], link_ends), _sums(count[links], link_ends)]
            columns = [_sums(values[numbers], ends) for values in per_segment]
            shown, doc_ids = row["groups"].to_pylist(), row["doc_ids"]
            texts, size, first = [], 0, 0
            for place, end in enumerate(ends.tolist()):
                begin = int(ends[place - 1]) if place else 0
                texts.append(b";".join(map(shown.__getitem__, numbers[begin:end].tolist())))
                size += len(texts[-1])
                if size > BLOCK or place + 1 == len(ends):
                    arrays = [doc_ids.slice(first, len(texts)), *[pa.array(c[first : place + 1], pa.int64()) for c in columns], pa.array(texts, pa.binary()).cast(pa.string())]
                    yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])
                    texts, size, first = [], 0, place + 1


def blocks(spark: SparkSession, docs: DataFrame, a_path: str, b_path: str, size: int = BLOCK) -> DataFrame:
    """The stored blocks of aligned documents."""
    return stored(spark, id_and_text(docs).mapInArrow(released(_blocks(a_path, b_path, size)), _BLOCK_SCHEMA), "alignment", **_LARGE_ROWS)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``a, b, n, best`` over all blocks: how many links hold the pair, and whether no pair of its ``b`` is in more."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "pair_links")).alias("p")).select("p.*")
    counts = each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("pair_links").alias("n"))
    counts = counts.select(F.shiftright("pair", 32).cast("int").alias("a"), F.col("pair").bitwiseAND(0xFFFFFFFF).cast("int").alias("b"), "n")
    of_b = Window.partitionBy("b")  # at most one row for each token of the other vocabulary
    return counts.withColumn("best", F.col("n") == F.max("n").over(of_b))


def documents(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """Documents of the blocks: tokens, groups (``a1,a2|b1;a3|b2,b3``), links, and what the corpus says about the links.

    Blocks reach the workers as groups of one row: a batch of many would hold 64 MB of them in the JVM and in Python.
    """
    met = aligned.select("block", F.explode("pairs").alias("pair"))
    keyed = counts.select((F.shiftleft(F.col("a").cast("long"), 32) + F.col("b")).alias("pair"), "n", F.col("best").cast("long").alias("best"))
    scored = met.join(keyed, "pair").groupBy("block").agg(F.collect_list(F.struct("pair", "n", "best")).alias("scored"))
    return aligned.join(scored, "block", "left").groupBy("block").applyInArrow(_documents, _RESULT)


def align(spark: SparkSession, docs: DataFrame, a_path: str, b_path: str, size: int = BLOCK) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups`` of every document."""
    aligned = blocks(spark, docs, a_path, b_path, size)
    return documents(aligned, pair_counts(aligned))
