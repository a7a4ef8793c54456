"""Byte-level BPE: encoding with a queue of merges over a linked symbol list, decoding by concatenation.

A text is cut into words by the vocabulary's pattern. Within a word the symbols form a doubly linked list; a heap holds
the possible merges by rank and place. An entry whose symbols have changed since it was pushed is skipped when it
comes up. A word of n bytes costs O(n log n), also when a text is one single word.

Words repeat, so each Python worker keeps the ids of pieces between batches, in two generations of at most
``KNOWN_WORDS`` pieces: what is met again moves to the young one, and a full young one replaces the old one. Texts are
neither shuffled nor cut.

Defined results: null or empty text gives no ids and decodes to an empty text. Special tokens in a text become their
ids, as the vocabulary file says. Ids outside of the vocabulary decode to nothing; bytes that are not UTF-8 decode to
the replacement character.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from medalith.llm.frames import released, slices

KNOWN_WORDS = 600_000
KNOWN_CHARS = 200
CLAUSE_ENDS = ".,;:!?"
#: Fixed value: the word pattern of this family of vocabularies.
WORDS = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: A blank between two white-space characters (or at the end after one) belongs to a longer run.
_INNER_BLANK = re.compile(r"\s (?:\s|\Z)")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where printable, else the next one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, spare = [], 256
    for byte in range(256):
        letters.append(chr(byte if byte in printable else spare))
        spare += byte not in printable
    return letters


class Merges:
    """The merges by rank, and the rank of each pair of symbols."""

    def __init__(self, ranked: list[tuple[int, int, int]]):
        self.left, self.right, self.made = ([m[k] for m in ranked] for k in range(3))
        self.rank = {left << 32 | right: rank for rank, (left, right, _) in enumerate(ranked)}


def merge_symbols(symbols: list[int], merges: Merges) -> list[int]:
    """Apply the merges to a word, lowest rank first, leftmost first among equal ranks.

    A queue entry is one integer, ``rank << 32 | place``.
    """
    size = len(symbols)
    if size < 2:
        return symbols
    rank_of, lefts, rights, made = merges.rank.get, merges.left, merges.right, merges.made
    symbols = [*symbols, -1]  # the last symbol has an end behind it that no merge knows
    after, before = list(range(1, size + 2)), list(range(-1, size))
    pairs = zip(symbols, symbols[1:size], strict=False)
    queue = [rank << 32 | place for place, (a, b) in enumerate(pairs) if (rank := rank_of(a << 32 | b)) is not None]
    heapq.heapify(queue)
    pop, push = heapq.heappop, heapq.heappush
    while queue:
        entry = pop(queue)
        rank, place = entry >> 32, entry & 0xFFFFFFFF
        right = after[place]
        if symbols[place] != lefts[rank] or symbols[right] != rights[rank]:
            continue  # stale: one of the two was merged after this entry was pushed
        symbols[place] = new = made[rank]
        symbols[right] = -1
        after[place] = further = after[right]
        before[further] = place
        if (follower := symbols[further]) >= 0 and (rank := rank_of(new << 32 | follower)) is not None:
            push(queue, rank << 32 | place)
        if (left := before[place]) >= 0 and (rank := rank_of(symbols[left] << 32 | new)) is not None:
            push(queue, rank << 32 | left)
    return [s for s in symbols if s >= 0]


class _Known(dict):
    """Ids of the short pieces met last; this dictionary is the young generation."""

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most = encode, most
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.encode(piece)
            if len(piece) > KNOWN_CHARS:
                return ids
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[piece] = ids
        return ids


class ByteBpe:
    """A byte-level BPE vocabulary file; ids go in and out as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, known_words: int = KNOWN_WORDS):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocabulary = content["model"]["vocab"]
        byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
        self.byte_ids = [vocabulary[letter] for letter in byte_letters()]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in content["model"]["merges"]]
        self.merges = Merges([(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in pairs])
        special = {t["content"]: t["id"] for t in content.get("added_tokens", [])}
        size = max([*vocabulary.values(), *special.values()]) + 1
        self.pieces = [b""] * size
        for token, number in vocabulary.items():
            self.pieces[number] = bytes(byte_of[letter] for letter in token)
        for token, number in special.items():
            self.pieces[number] = token.encode()
        self.special = {token: np.uint32(number).tobytes() for token, number in special.items()}
        longest_first = sorted(special, key=len, reverse=True)
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if special else None
        self.words = _Known(self._word, known_words)
        self.plain = _Known(self._pieces, known_words)
        self.spaced = _Known(self._after_blank, known_words)

    def _word(self, word: str) -> bytes:
        return packed(merge_symbols(list(map(self.byte_ids.__getitem__, word.encode())), self.merges))

    def _after_blank(self, piece: str) -> bytes:
        """Ids of a piece with a blank before it; letters are one word, and so are the marks that end a clause."""
        if piece.isalpha():
            return self._word(" " + piece)
        word = piece.rstrip(CLAUSE_ENDS)
        if len(word) < len(piece) and word.isalpha():
            return self.spaced[word] + self.words[piece[len(word) :]]
        return self._pieces(" " + piece)

    def _pieces(self, text: str) -> bytes:
        words, spaced = self.words, self.spaced
        return b"".join([spaced[w[1:]] if w[0] == " " and w[1:].isalpha() else words[w] for w in WORDS.findall(text)])

    def _ordinary(self, text: str) -> bytes:
        if _INNER_BLANK.search(text):
            return self._pieces(text)
        # no word goes over a blank that has something else before or behind it
        first, *rest = text.split(" ")
        return self.plain[first] + b"".join(map(self.spaced.__getitem__, rest))

    def encode(self, text: str) -> bytes:
        if not self.special_pattern or not any(token in text for token in self.special):
            return self._ordinary(text)
        parts = self.special_pattern.split(text)
        return b"".join(self.special[p] if i % 2 else self._ordinary(p) for i, p in enumerate(parts) if p)

    def forget(self) -> None:
        for known in (self.words, self.plain, self.spaced):
            known.clear()
            known.old = {}

    def decode(self, ids: bytes) -> str:
        numbers = np.frombuffer(ids, dtype="<u4")
        if len(numbers) and int(numbers.max()) >= len(self.pieces):
            numbers = numbers[numbers < len(self.pieces)]
        return b"".join(map(self.pieces.__getitem__, numbers.tolist())).decode("utf-8", errors="replace")


@lru_cache(maxsize=4)
def vocabulary(path: str, known_words: int = KNOWN_WORDS) -> ByteBpe:
    """One instance per worker, file and size of the table of known pieces (about 200 bytes a piece)."""
    return ByteBpe(path, known_words)


def encode(text: Column, path: str, known_words: int = KNOWN_WORDS) -> Column:
    """Ids of each text as binary, four bytes each; null counts as empty."""

    @F.arrow_udf("binary")
    def encoded(texts: pa.Array) -> pa.Array:
        bpe = vocabulary(path, known_words)
        return pa.array([bpe.encode(t) if t else b"" for t in texts.to_pylist()], pa.binary())

    return encoded(text)


def decode(ids: Column, path: str, known_words: int = KNOWN_WORDS) -> Column:
    """The text of each binary row of ids; null counts as no ids."""

    @F.arrow_udf("string")
    def decoded(rows: pa.Array) -> pa.Array:
        bpe = vocabulary(path, known_words)
        return pa.array([bpe.decode(r) if r else "" for r in rows.to_pylist()], pa.string())

    return decoded(ids)


def with_round_trip(docs: DataFrame, path: str, known_words: int = KNOWN_WORDS) -> DataFrame:
    """``docs`` with the binary ``ids`` of its ``text`` and ``round_trip``, whether they decode to it, in place of the text.

    Python workers outlive a stage, so each task leaves its worker without known pieces. The text must not be null.
    """
    others = [c for c in docs.columns if c != "text"]
    schema = StructType([docs.schema[c] for c in others]).add("ids", "binary").add("round_trip", "boolean")
    return docs.mapInArrow(released(_round_trip(path, known_words, others)), schema)


def _round_trip(path: str, known_words: int, others: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path, known_words)
        try:
            for batch in slices(batches):
                texts = batch.column("text").to_pylist()
                ids = [bpe.encode(t) if t else b"" for t in texts]
                same = [bpe.decode(i) == t for i, t in zip(ids, texts, strict=True)]
                columns = [*map(batch.column, others), pa.array(ids, pa.binary()), pa.array(same, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=[*others, "ids", "round_trip"])
        finally:
            bpe.forget()

    return run


def packed(ids: list[int]) -> bytes:
    numbers = array("I", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


def id_list(ids: bytes) -> list[int]:
    """Ids of a binary row, for use outside of Spark."""
    return np.frombuffer(ids, dtype="<u4").tolist()
