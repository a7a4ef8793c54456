"""Token ids in binary shard files, with a minimal perfect hash index for keyed access.

Documents are range-partitioned by id and sorted, then encoded; each task cuts its documents into shards of about
``SHARD_TOKENS`` ids (a longer document stands alone). One shard is one file:

====================  ==============================================================================
header                ``HEADER`` bytes of JSON, filled up with blanks
pilots                int32 per bucket of the hash index
fingerprints          uint32 per slot
ordinals              uint32 per slot: which document of the shard holds the key
keys                  int64 per document, ascending; the first ``null_keys`` ones stand for null
offsets               uint64 per document and one more, in ids from the start of the payload
payload               the raw ids, little-endian, two bytes each if all ids fit, else four
last byte             a newline, as Spark's writer ends a record
====================  ==============================================================================

The index is a hash-and-displace function: a key's bucket holds a pilot, key and pilot give the slot. It has one slot
per distinct key and no key stored in it; the fingerprint tells a foreign key apart, and the key beside the document
confirms it. Keyed access reads the shard that covers the key, then one pilot, one slot and one slice.

Files are written by Spark's own committing writer, so a lost executor leaves no partial shard, and they lie wherever
Spark can write. The manifest has one row per shard with the number of ids before it.

Defined results: null text is empty and has only the end id; a null key is stored first and is not indexed; of rows
that repeat a key the index points to the first (by text) and the others are read by scans; an empty table gives a
store without shards.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medalith.llm.byte_bpe import byte_letters, packed
from medalith.llm.frames import column, id_and_text
from medalith.llm.words import mix

SHARD_TOKENS = 1 << 22
SHARD_DOCUMENTS = 1 << 16
HEADER = 512
MAGIC = "token-shard-1"
KEYS_PER_BUCKET = 4
KNOWN_PIECES = 600_000
ROWS_AT_ONCE = 256
KNOWN_CHARS = 200
NO_KEY = -(2**63)
CLAUSE_ENDS = ".,;:!?"
LATIN_END = "\u0250"
_COMPOSING = re.compile("[\u02b0-\u036f\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\ufe20-\ufe2f]")


# --- encoding with the tokenizers library ---------------------------------------------------------------


class _Known(dict):
    """Ids of the short pieces met last; this dictionary is the young one of two generations."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode
        self.old: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = self.encode(piece)
            if len(piece) > KNOWN_CHARS:
                return ids
        if len(self) >= KNOWN_PIECES:
            self.old.clear()  # its room is used again
            self.old.update(self)
            self.clear()
        self[piece] = ids
        return ids


class PieceEncoder:
    """Encodes texts piece by piece, with the ids of pieces met before kept per worker.

    Only for vocabularies that drop white space and lower-case: nothing then reaches over a blank or a newline, and
    ASCII letters may be lowered before the library sees them (not beside combining marks, with which lowered letters
    would compose otherwise, nor beside what may be a special token). A run of Latin letters is one word of the
    vocabulary's pattern and stays as it is when normalized, so it goes straight to the library's BPE model; all other
    pieces take the library's whole way. Pieces are kept in two generations of at most ``KNOWN_PIECES``.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.letters = dict(enumerate(byte_letters()))
        self.known = _Known(self._piece)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        ids = self.known.__getitem__
        return [b"".join(map(ids, _lowered(t).replace("\n", " ").split(" "))) for t in texts]

    def _piece(self, piece: str) -> bytes:
        if not piece:
            return b""
        word = piece.rstrip(CLAUSE_ENDS)
        if word and len(word) < len(piece) and _is_word(word):
            return self.known[word] + self.known[piece[len(word) :]]
        if not _is_word(piece):
            return packed(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        lowered = piece.lower()
        if not lowered.isascii():
            lowered = lowered.encode().decode("latin-1").translate(self.letters)
        return packed([token.id for token in self.model.tokenize(lowered)])


def _is_word(piece: str) -> bool:
    """Latin letters only, also when lowered."""
    return piece.isalpha() and (piece.isascii() or (max(piece) < LATIN_END and piece.lower().isalpha()))


def _lowered(text: str) -> str:
    if "<|" in text:
        return text
    if text.isascii():
        return text.lower()
    if _COMPOSING.search(text):
        return text
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


# --- minimal perfect hash -------------------------------------------------------------------------------


def _hashes(keys: np.ndarray) -> np.ndarray:
    return mix(keys.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))


def _slots(hashes: np.ndarray, pilots: np.ndarray, size: int) -> np.ndarray:
    pilot = pilots[(hashes % np.uint64(len(pilots))).astype(np.int64)].astype(np.int64)
    moved = mix(hashes ^ mix(np.maximum(pilot, 0).astype(np.uint64) + np.uint64(1))) % np.uint64(size)
    return np.where(pilot < 0, -pilot - 1, moved.astype(np.int64))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(_hashes(keys) ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(32)).astype(np.uint32)


def build_pilots(keys: np.ndarray) -> np.ndarray:
    """Pilots that send the distinct keys to the slots 0 … n-1, each slot once.

    Large buckets are placed first, by trying pilots; a bucket of one key names a free slot outright (below zero).
    """
    size = len(keys)
    hashes = _hashes(keys)
    count = max(1, -(-size // KEYS_PER_BUCKET))
    bucket = (hashes % np.uint64(count)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    begin = np.searchsorted(bucket[order], np.arange(count + 1))
    pilots = np.zeros(count, dtype=np.int32)
    taken = np.zeros(size, dtype=bool)
    lengths = np.diff(begin)
    single = []
    tries = mix(np.arange(1, 257, dtype=np.uint64))
    for b in np.argsort(-lengths, kind="stable"):
        if lengths[b] < 2:
            break
        own = hashes[order[begin[b] : begin[b + 1]]]
        base = 0
        while True:
            slots = (mix(own[None, :] ^ tries[:, None]) % np.uint64(size)).astype(np.int64) if not base else (
                mix(own[None, :] ^ mix(np.arange(base + 1, base + 257, dtype=np.uint64))[:, None]) % np.uint64(size)
            ).astype(np.int64)
            free = ~taken[slots].any(axis=1)
            ordered = np.sort(slots, axis=1)
            free &= (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
            good = np.flatnonzero(free)
            if len(good):
                pilots[b] = base + good[0]
                taken[slots[good[0]]] = True
                break
            base += 256
    single = np.flatnonzero(lengths == 1)
    pilots[single] = -np.flatnonzero(~taken)[: len(single)] - 1
    return pilots


# --- shards ---------------------------------------------------------------------------------------------


def pack_shard(part: int, shard: int, keys: list[int | None], ids: list[bytes]) -> bytes:
    """One shard file's content, without the final newline."""
    nulls = sum(k is None for k in keys)
    stored = np.array([NO_KEY if k is None else k for k in keys], dtype="<i8")
    real = stored[nulls:]
    distinct, first = np.unique(real, return_index=True)
    payload = np.frombuffer(b"".join(ids), dtype="<u4")
    width = 2 if not len(payload) or int(payload.max()) < 1 << 16 else 4
    offsets = np.concatenate([[0], np.cumsum([len(i) // 4 for i in ids])]).astype("<u8")
    pilots = build_pilots(distinct) if len(distinct) else np.zeros(0, dtype=np.int32)
    marks, ordinals = np.zeros(len(distinct), dtype="<u4"), np.zeros(len(distinct), dtype="<u4")
    if len(distinct):
        slots = _slots(_hashes(distinct), pilots, len(distinct))
        marks[slots], ordinals[slots] = fingerprints(distinct), first + nulls
    header = json.dumps({
        "magic": MAGIC, "part": part, "shard": shard, "documents": len(keys), "null_keys": nulls, "keys": len(distinct),
        "buckets": len(pilots), "tokens": int(offsets[-1]), "width": width,
        "first_key": int(real[0]) if len(real) else None, "last_key": int(real[-1]) if len(real) else None,
    }).encode().ljust(HEADER)
    body = payload.astype(f"<u{width}")
    return b"".join([header, pilots.astype("<i4").tobytes(), marks.tobytes(), ordinals.tobytes(), stored.tobytes(), offsets.tobytes(), body.tobytes()])


class Shard:
    """A shard file's content, read in place."""

    def __init__(self, content: bytes):
        self.header = h = json.loads(bytes(content[:HEADER]))
        if h["magic"] != MAGIC:
            raise ValueError("not a token shard")
        at = HEADER

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            part = np.frombuffer(content, dtype=kind, count=count, offset=at)
            at += part.nbytes
            return part

        self.pilots, self.marks, self.ordinals = take("<i4", h["buckets"]), take("<u4", h["keys"]), take("<u4", h["keys"])
        self.keys, self.offsets = take("<i8", h["documents"]), take("<u8", h["documents"] + 1).astype(np.int64)
        self.payload = take(f"<u{h['width']}", h["tokens"])

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The document's place in the shard for each key, -1 for keys that are not in it."""
        if not len(self.marks) or not len(keys):
            return np.full(len(keys), -1, dtype=np.int64)
        slots = _slots(_hashes(keys), self.pilots, len(self.marks))
        places = self.ordinals[slots].astype(np.int64)
        return np.where((self.marks[slots] == fingerprints(keys)) & (self.keys[places] == keys), places, -1)

    def ids(self, place: int) -> np.ndarray:
        return self.payload[self.offsets[place] : self.offsets[place + 1]].astype("<u4")


def _packed(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, shard, keys, ids, size = TaskContext.get().partitionId(), 0, [], [], 0
        end = np.uint32(end_id).tobytes()
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):  # texts and ids of a few documents beside the batch
                some = batch.slice(first, ROWS_AT_ONCE)
                encoded = encoder(path).encode([t or "" for t in some.column("text").to_pylist()])
                for key, own in zip(some.column("doc_id").to_pylist(), encoded, strict=True):
                    if keys and (size + len(own) // 4 + 1 > SHARD_TOKENS or len(keys) == SHARD_DOCUMENTS):
                        yield pa.RecordBatch.from_arrays([pa.array([pack_shard(part, shard, keys, ids)], pa.binary())], names=["content"])
                        shard, keys, ids, size = shard + 1, [], [], 0
                    keys.append(key)
                    ids.append(own + end)
                    size += len(own) // 4 + 1
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array([pack_shard(part, shard, keys, ids)], pa.binary())], names=["content"])

    return run


def write_store(docs: DataFrame, path: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1) -> None:
    """Encode all documents and write them in ascending order of their ids below ``path``."""
    placed = id_and_text(docs, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    shards = placed.mapInArrow(_packed(vocabulary, end_id), "content binary")
    # a cast only renames the bytes; the text writer puts them into a file as they are, one record per file
    shards.select(F.col("content").cast("string")).write.option("maxRecordsPerFile", 1).option("lineSep", "\n").text(f"{path}/shards")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A row per shard, from the headers: ``path, part, shard, documents, tokens, first_key, last_key, base``.

    ``base`` is the number of ids in all shards before it. Totals of the parts come first, so the one ordered pass has
    a row per write task and not one per shard.
    """
    kind = "part int, shard int, documents long, tokens long, first_key long, last_key long"
    head = F.from_json(F.expr(f"cast(substring(content, 1, {HEADER}) as string)"), kind)
    rows = _files(spark, path).select("path", head.alias("h")).select("path", "h.*")
    totals = rows.groupBy("part").agg(F.sum("tokens").alias("own"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = totals.select("part", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("part_base"))
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = rows.withColumn("inner_base", F.coalesce(F.sum("tokens").over(within), F.lit(0))).join(parts, "part")
    return based.withColumn("base", F.col("part_base") + F.col("inner_base")).drop("part_base", "inner_base")


def _files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    where = path if isinstance(path, list) else f"{path}/shards"
    return spark.read.format("binaryFile").load(where).where("length > 0")


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for value in batch.column("content"):
            shard = Shard(value.as_buffer())
            nulls = shard.header["null_keys"]
            places = np.arange(len(shard.keys))
            # every key goes through the index; a repeated key is found at its first place
            found = shard.find(shard.keys[nulls:])
            repeated = np.concatenate([[False], shard.keys[nulls + 1 :] == shard.keys[nulls:-1]]) if len(found) else found.astype(bool)
            if (found[~repeated] != places[nulls:][~repeated]).any():
                raise ValueError("the index of a shard does not lead to its documents")
            n = len(places)
            wide = shard.payload.astype("<u4").view(np.uint8)
            ends = (shard.offsets * 4).tolist()
            checks = [zlib.crc32(wide[begin:end]) for begin, end in itertools.pairwise(ends)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, shard.header["part"], dtype=np.int32)), pa.array(np.full(n, shard.header["shard"], dtype=np.int32)),
                 pa.array(shard.keys, pa.int64(), mask=places < nulls), pa.array(shard.offsets[:-1]), pa.array(np.diff(shard.offsets)),
                 pa.array(checks, pa.int64())],
                names=["part", "shard", "doc_id", "inner", "n_tokens", "ids_crc32"],
            )


def document_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every stored document, read from the files through their index."""
    rows = _files(spark, path).select("content").mapInArrow(_scanned, "part int, shard int, doc_id long, inner long, n_tokens long, ids_crc32 long")
    bases = manifest(spark, path).select("part", "shard", "base")
    return rows.join(bases, ["part", "shard"]).select("doc_id", (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")


def _looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content, wanted in zip(batch.column("content"), batch.column("keys"), strict=True):
            shard = Shard(content.as_buffer())
            keys = np.array(wanted.as_py(), dtype=np.int64)
            places = shard.find(keys)
            hit = np.flatnonzero(places >= 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[hit]), pa.array([shard.ids(p).tolist() for p in places[hit]], pa.list_(pa.int64()))], names=["doc_id", "ids"]
            )


def lookup(spark: SparkSession, path: str, keys: DataFrame, key_col: str = "doc_id") -> DataFrame:
    """``doc_id, ids`` of the asked keys that are stored; only shards whose key range holds an asked key are read.

    Keys meet shards by ranges of the key space (about one per shard), then go through the shard's index in lists of
    at most ``SHARD_DOCUMENTS`` keys. The driver gets the names of the shards to read, as it does for any file scan.
    """
    shards = manifest(spark, path).where("first_key is not null").select("path", "first_key", "last_key")
    span = shards.agg(F.min("first_key"), F.max("last_key"), F.count("*")).first()
    wanted = keys.select(column(keys, key_col).cast("long").alias("key")).where("key is not null").distinct()
    if not span[2]:
        return wanted.where("false").select(F.col("key").alias("doc_id"), F.array().cast("array<bigint>").alias("ids"))
    width = (span[1] - span[0]) // span[2] + 1
    place = "cast(floor(({} - {}) / {}) as long)"
    cells = shards.withColumn("cell", F.explode(F.expr(f"sequence({place.format('first_key', span[0], width)}, {place.format('last_key', span[0], width)})")))
    asked = wanted.where(F.col("key").between(span[0], span[1])).withColumn("cell", F.expr(place.format("key", span[0], width)))
    routed = asked.join(cells, "cell").where("key between first_key and last_key")
    lists = routed.groupBy("path", F.expr(f"pmod(xxhash64(key), cast((last_key - first_key) div {SHARD_DOCUMENTS} + 1 as long))").alias("list"))
    lists = lists.agg(F.collect_list("key").alias("keys"))
    names = [r.path for r in routed.select("path").distinct().collect()]
    if not names:
        return wanted.where("false").select(F.col("key").alias("doc_id"), F.array().cast("array<bigint>").alias("ids"))
    return _files(spark, names).select("path", "content").join(lists, "path").select("content", "keys").mapInArrow(_looked_up, "doc_id long, ids array<long>")
