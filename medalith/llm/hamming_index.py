"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

Fitting, on at most ``SAMPLE`` vectors (chosen by the hash of their ids): principal axes, then a rotation that brings
the projections close to the corners of a cube (iterative quantization); the signs are a code of at most 64 bits. The
search radius is the one within which the share ``TARGET`` of the sample's true neighbours lies; with more vectors
neighbours only get nearer.

Every valid vector is indexed. Codes are cut into substrings of ``PIECE_BITS`` bits, and each substring has its own
table from value to rows. A code within Hamming radius r of a query agrees with it up to ⌊r / pieces⌋ bits in at least
one substring (pigeonhole), so probing all values that near finds every such code. Those are reranked by the exact
distance of the original vectors. The tables are built over blocks of rows inside a task; a block that holds fewer
than k codes within the radius widens it for itself, so no query ends with fewer neighbours than there are.

The queries are a stated set: their distinct vectors are sent to the executors in blocks of ``QUERY_BLOCK``. Equal
vectors are handled once, with the k + 1 smallest ids of each (more can't be among k neighbours), so neither a very
common vector nor its many queries cost more than one.

Defined results: rows with a null id, and vectors that are null, zero, or hold null or non-finite components take no
part, nor do those of another length than most of the sample (the smaller on a tie). Ties go to the smaller id. With k
candidates or fewer all are returned; without a candidate a query has no row. Rows that repeat an id count as one's own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medalith.llm.frames import column, hash_share, stored

SAMPLE = 4096
SAMPLE_QUERIES = 512
TARGET = 0.98
MAX_BITS = 64
#: Longer components, in units of the median of the largest ones, are shortened for the codes (never for distances).
LONGEST = 1e3
PIECE_BITS = 8
QUERY_BLOCK = 4096
ROUNDS = 40


@dataclass(frozen=True)
class Codes:
    """What a fit yields: a code is ``(vector - mean) @ axes > 0``, vectors in units of a usual component."""

    mean: np.ndarray
    axes: np.ndarray
    radius: int
    unit: float = 1.0

    @property
    def bits(self) -> int:
        return self.axes.shape[1]

    def encode(self, vectors: np.ndarray) -> np.ndarray:
        """Codes as unsigned 64-bit integers."""
        signs = (shortened(vectors, self.unit) - self.mean) @ self.axes > 0
        return (signs.astype(np.uint64) << np.arange(self.bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def shortened(vectors: np.ndarray, unit: float) -> np.ndarray:
    """Vectors in units of a usual component; those over ``LONGEST`` of them are shortened, so that no square overflows."""
    scaled = vectors / max(unit, 1e-300)
    longest = np.abs(scaled).max(axis=1, keepdims=True)
    infinite = np.isinf(longest)
    with np.errstate(invalid="ignore"):
        short = scaled / np.maximum(longest / LONGEST, 1)
        # divided in two steps where one overflows
        return np.where(infinite, LONGEST * (vectors / np.abs(vectors).max(axis=1, keepdims=True)), short)


def distances(apart: np.ndarray) -> np.ndarray:
    """Lengths of the rows; squares that leave the range of doubles are taken in units of the largest component."""
    with np.errstate(over="ignore", under="ignore"):
        plain = np.sqrt((apart**2).sum(axis=1))
    odd = np.flatnonzero(~(plain < 1e150) | (plain < 1e-150))
    if len(odd):
        top = np.abs(apart[odd]).max(axis=1)
        units = np.where((top > 0) & np.isfinite(top), top, 1.0)
        with np.errstate(over="ignore", invalid="ignore"):
            plain[odd] = np.where(np.isinf(top), np.inf, units * np.sqrt(((apart[odd] / units[:, None]) ** 2).sum(axis=1)))
    return plain


def valid_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, vector`` of the rows that take part, whatever their length."""
    named = rows.select(column(rows, id_col).cast("long").alias("vec_id"), column(rows, vector_col).cast("array<double>").alias("vector"))
    fine = "forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(vector, x -> x <> 0)"
    return named.where(f"vec_id is not null and vector is not null and coalesce({fine}, false)")


def fit(rows: DataFrame, sample: int = SAMPLE, k: int = 10) -> Codes | None:
    """Rotation and radius from a bounded sample of ``valid_vectors``; None for an empty table."""
    some = rows.where(hash_share(F.xxhash64("vec_id"), rows.count(), sample))
    taken = [r.vector for r in some.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()]
    if not taken:
        return None
    lengths = sorted({len(v) for v in taken}, key=lambda n: (-sum(len(v) == n for v in taken), n))
    vectors = np.unique(np.array([v for v in taken if len(v) == lengths[0]], dtype=np.float64), axis=0)
    unit = float(np.median(np.abs(vectors).max(axis=1)))
    vectors = shortened(vectors, unit)
    mean = vectors.mean(axis=0)
    bits = min(MAX_BITS, vectors.shape[1])
    _, axes = np.linalg.eigh((vectors - mean).T @ (vectors - mean))
    axes = axes[:, ::-1][:, :bits]
    projected = (vectors - mean) @ axes
    rotation, _ = np.linalg.qr(np.random.default_rng(0).normal(size=(bits, bits)))
    for _ in range(ROUNDS):
        left, _, right = np.linalg.svd(np.where(projected @ rotation > 0, 1.0, -1.0).T @ projected)
        rotation = (left @ right).T
    codes = Codes(mean, axes @ rotation, bits)
    return Codes(mean, axes @ rotation, _radius(codes, vectors, k), unit)


def _radius(codes: Codes, vectors: np.ndarray, k: int) -> int:
    if len(vectors) < 2:
        return codes.bits
    own = codes.encode(vectors)
    apart = []
    for q in range(0, len(vectors), max(1, len(vectors) // SAMPLE_QUERIES)):
        distance = ((vectors - vectors[q]) ** 2).sum(axis=1)
        distance[q] = np.inf
        near = np.argpartition(distance, min(k, len(vectors) - 1) - 1)[: min(k, len(vectors) - 1)]
        apart += np.bitwise_count(own[near] ^ own[q]).tolist()
    return int(np.quantile(apart, TARGET, method="higher"))


class BlockTables:
    """The substring tables over one block of distinct vectors."""

    def __init__(self, codes: np.ndarray, bits: int):
        self.codes, self.bits = codes, bits
        self.pieces = -(-bits // PIECE_BITS)
        self.rows, self.begin = [], []
        for piece in range(self.pieces):
            values = self._piece(codes, piece)
            order = np.argsort(values, kind="stable")
            self.rows.append(order)
            self.begin.append(np.searchsorted(values[order], np.arange((1 << PIECE_BITS) + 1)))

    @staticmethod
    def _piece(codes, piece: int):
        return ((codes >> np.uint64(piece * PIECE_BITS)) & np.uint64((1 << PIECE_BITS) - 1)).astype(np.int64)

    def within(self, code: np.uint64, radius: int) -> np.ndarray:
        """Rows of all codes within the radius, by probing each substring's table."""
        flips = PROBES[min(radius // self.pieces, PIECE_BITS)]
        hit = np.zeros(len(self.codes), dtype=bool)
        for piece in range(self.pieces):
            begin, rows = self.begin[piece], self.rows[piece]
            values = self._piece(code, piece) ^ flips
            for low, high in zip(begin[values].tolist(), begin[values + 1].tolist(), strict=True):
                if high > low:
                    hit[rows[low:high]] = True
        found = np.flatnonzero(hit)
        return found[np.bitwise_count(self.codes[found] ^ code) <= radius]

    def at_least(self, code: np.uint64, radius: int, count: int) -> np.ndarray:
        """Rows within the radius, widened until there are ``count`` of them (or all)."""
        count = min(count, len(self.codes))
        while len(found := self.within(code, radius)) < count:
            radius = min(self.bits, radius + max(1, self.bits // 16))
        return found


#: For each number of bits, the flips of a substring that change at most so many of them.
PROBES = [np.array([v for v in range(1 << PIECE_BITS) if v.bit_count() <= n]) for n in range(PIECE_BITS + 1)]


def build_index(spark: SparkSession, rows: DataFrame, codes: Codes) -> DataFrame:
    """``vec_id, vector, code`` of every vector of the fitted length, written to the shared folder."""
    size = len(codes.mean)

    @F.arrow_udf("long")
    def encoded(vectors: pa.Array) -> pa.Array:
        return pa.array(codes.encode(_matrix(vectors, size)).view(np.int64))

    fitting = rows.where(F.size("vector") == size)
    return stored(spark, fitting.withColumn("code", encoded(F.col("vector"))), "hamming-index")


def _matrix(vectors: pa.Array, size: int) -> np.ndarray:
    return np.asarray(vectors.flatten(), dtype=np.float64).reshape(len(vectors), size)


def _searched(block, codes: Codes, k: int):
    """Keeps the k + 1 best of each query over all blocks of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, vectors = block.value
        wanted = codes.encode(vectors)
        size = len(codes.mean)
        best: list[list[tuple[float, int]]] = [[] for _ in query]
        for batch in batches:
            ids = np.asarray(batch.column("vec_id"), dtype=np.int64)
            order = np.argsort(ids, kind="stable")
            ids, rows = ids[order], _matrix(batch.column("vector"), size)[order]
            own = np.asarray(batch.column("code"), dtype=np.int64)[order].view(np.uint64)
            _, first, group = np.unique(rows, axis=0, return_index=True, return_inverse=True)
            members = np.argsort(group.ravel(), kind="stable")
            begin = np.searchsorted(group.ravel()[members], np.arange(len(first) + 1))
            tables, distinct = BlockTables(own[first], codes.bits), rows[first]
            for q in range(len(query)):
                near = tables.at_least(wanted[q], codes.radius, k + 1)
                with np.errstate(over="ignore"):
                    distance = distances(distinct[near] - vectors[q])
                if len(near) > k + 1:
                    limit = np.partition(distance, k)[k]
                    near, distance = near[distance <= limit], distance[distance <= limit]
                for at, d in zip(near.tolist(), distance.tolist(), strict=True):
                    best[q] += [(d, int(i)) for i in ids[members[begin[at] : begin[at + 1]][: k + 1]]]
                best[q] = sorted(set(best[q]))[: k + 1]
        rows_out = [(query[q], i, d) for q in range(len(query)) for d, i in best[q]]
        columns = list(zip(*rows_out, strict=True)) if rows_out else [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())],
            names=["query_key", "vec_id", "score"],
        )

    return run


def search(spark: SparkSession, index: DataFrame, queries: DataFrame, codes: Codes, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows ``vec_id, vector`` of ``queries`` against all of ``index``.

    ``query_key`` is the smallest id that asks with a vector; the result is joined back to all ids that ask with it.
    """
    fitting = queries.where(F.size("vector") == len(codes.mean))
    asked = stored(spark, fitting.groupBy("vector").agg(F.min("vec_id").alias("query_key"), F.collect_set("vec_id").alias("ids")), "hamming-queries")
    blocks = asked.count() // QUERY_BLOCK + 1
    found = None
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("query_key"), F.lit(blocks)) == block).select("query_key", "vector").orderBy("query_key").collect()
        if not rows:
            continue
        sent = spark.sparkContext.broadcast(([r.query_key for r in rows], np.array([r.vector for r in rows], dtype=np.float64)))
        part = index.select("vec_id", "vector", "code").mapInArrow(_searched(sent, codes, k), "query_key long, vec_id long, score double")
        part = part if blocks == 1 else stored(spark, part, f"hamming-found-{block}")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return asked.where("false").select(F.col("query_key").alias("query_id"), F.lit(1).alias("rank"), F.col("query_key").alias("vec_id"), F.lit(0.0).alias("score"))
    best = Window.partitionBy("query_key").orderBy("score", "vec_id")
    some = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1).drop("place")
    each = some.join(asked.select("query_key", F.explode("ids").alias("query_id")), "query_key").where("query_id <> vec_id")
    final = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return each.select("query_id", F.row_number().over(final).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
