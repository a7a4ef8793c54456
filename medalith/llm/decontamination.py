"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item are compared when they share a run of ``MIN_TILE`` words (the seeds). Greedy string
tiling then marks the longest common runs that do not overlap, again and again; the runs are found with running
Karp-Rabin hashes and checked word by word. An item leaks into a document when the marked part of the item reaches
``COVERAGE``. Tiles may stand in any order, so reordered passages are found as well.

The items are a stated query set: they are sent to the executors in blocks of at most ``BLOCK_CHARS`` characters, and
every document meets every block. Documents are never shuffled, so neither long nor copied nor frequent passages pile
up anywhere.

Words are runs of letters, digits and non-ASCII characters after lower-casing. Defined results: null or empty texts
have no hits; an item with fewer than ``MIN_TILE`` words is one seed and leaks where all its words stand together; items
without words are never found; an item id that repeats is reported for each of its rows that leaks, in the order of
ids; without items there are no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medalith.llm.frames import ROWS_AT_ONCE, column
from medalith.llm.words import ALPHANUMERIC, hashed_words, pieces, shingles, text_bytes

MIN_TILE = 5
COVERAGE = 0.5
BLOCK_CHARS = 1 << 24
FIRST_LENGTH = 20
HITS = "array<struct<item_id:bigint,coverage:double,tiles:int>>"
_ARROW_HITS = pa.list_(pa.struct([("item_id", pa.int64()), ("coverage", pa.float64()), ("tiles", pa.int32())]))

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    grown = np.full(n + 1, base, dtype=np.uint64)
    grown[0] = 1
    return np.cumprod(grown, dtype=np.uint64)


class _Running:
    """Karp-Rabin hashes of all windows of any length over one sequence, from one prefix sum."""

    def __init__(self, words: np.ndarray, up: np.ndarray, down: np.ndarray):
        self.words, self.down = words, down
        self.prefix = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(words * up[: len(words)], dtype=np.uint64)])
        self.marked = np.zeros(len(words), dtype=bool)

    def open_windows(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the windows without a marked word."""
        count = len(self.words) - length + 1
        if count <= 0:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        marks = np.concatenate([[0], np.cumsum(self.marked)])
        places = np.flatnonzero(marks[length:] == marks[:count])
        hashes = (self.prefix[places + length] - self.prefix[places]) * self.down[places]
        return places, hashes


def greedy_tiles(item: np.ndarray, text: np.ndarray, min_tile: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """``(place in the item, place in the text, length)`` of the tiles, in the order in which they were marked."""
    size = max(len(item), len(text))
    up, down = _powers(_BASE, size), _powers(_INVERSE, size)
    one, two = _Running(item, up, down), _Running(text, up, down)
    tiles: list[tuple[int, int, int]] = []
    length = max(min_tile, min(FIRST_LENGTH, len(item)))
    while True:
        matches = _matches(one, two, length)
        longest = max((m[2] for m in matches), default=0)
        if longest > 2 * length:
            length = longest
            continue
        for p, t, n in sorted(matches, key=lambda m: (-m[2], m[0], m[1])):
            if not one.marked[p : p + n].any() and not two.marked[t : t + n].any():
                one.marked[p : p + n] = two.marked[t : t + n] = True
                tiles.append((p, t, n))
        if matches:
            continue  # what overlapped a longer tile may still hold an open part of this length
        if length == min_tile:
            return tiles
        length = max(min_tile, length // 2)


def _matches(one: _Running, two: _Running, length: int) -> list[tuple[int, int, int]]:
    """Maximal open common runs of at least ``length`` words."""
    p_places, p_hashes = one.open_windows(length)
    t_places, t_hashes = two.open_windows(length)
    if not len(p_places) or not len(t_places):
        return []
    by_hash: dict[int, list[int]] = {}
    for place, value in zip(p_places.tolist(), p_hashes.tolist(), strict=True):
        by_hash.setdefault(value, []).append(place)
    found = []
    reached: dict[int, int] = {}  # diagonal -> end of the run found last on it
    hits = np.flatnonzero(np.isin(t_hashes, p_hashes))
    for t, value in zip(t_places[hits].tolist(), t_hashes[hits].tolist(), strict=True):
        for p in by_hash[value]:
            if reached.get(t - p, -1) > t or not np.array_equal(one.words[p : p + length], two.words[t : t + length]):
                continue
            n = length
            while (
                p + n < len(one.words) and t + n < len(two.words) and one.words[p + n] == two.words[t + n]
                and not one.marked[p + n] and not two.marked[t + n]
            ):
                n += 1
            reached[t - p] = t + n
            found.append((p, t, n))
    return found


class Items:
    """One block of benchmark items with an index from seeds to items."""

    def __init__(self, ids: list[int], texts: list[str]):
        data, offsets = text_bytes(pa.array([t.lower() for t in texts], pa.large_string()))
        hashes, at = hashed_words(data, offsets, ALPHANUMERIC)
        self.ids, self.words = [], []
        seeds, owners = [], []
        for row, item in enumerate(ids):
            words = hashes[at[row] : at[row + 1]]
            if len(words):
                own = np.unique(shingles(words, MIN_TILE))
                seeds.append(own)
                owners.append(np.full(len(own), len(self.ids)))
                self.ids.append(item)
                self.words.append(words)
        self.seeds = np.concatenate(seeds) if seeds else np.zeros(0, dtype=np.uint64)
        self.owners = np.concatenate(owners) if owners else np.zeros(0, dtype=np.int64)
        order = np.argsort(self.seeds, kind="stable")
        self.seeds, self.owners = self.seeds[order], self.owners[order]
        # shingles of different widths have different hashes, so one index holds them all
        self.widths = sorted({min(MIN_TILE, len(words)) for words in self.words})

    def hits(self, words: np.ndarray, coverage: float) -> list[dict]:
        shared = np.zeros(0, dtype=np.uint64)
        for width in self.widths:
            if width <= len(words):
                own = shingles(words, width)
                at = np.searchsorted(self.seeds, own)
                shared = np.union1d(shared, own[self.seeds[np.minimum(at, len(self.seeds) - 1)] == own])
        if not len(shared):
            return []
        low, high = np.searchsorted(self.seeds, shared, "left"), np.searchsorted(self.seeds, shared, "right")
        found = []
        for owner in np.unique(np.concatenate([self.owners[a:b] for a, b in zip(low, high, strict=True)])):
            item = self.words[owner]
            tiles = greedy_tiles(item, words, min(MIN_TILE, len(item)))
            covered = sum(n for _, _, n in tiles) / len(item)
            if covered >= coverage:
                found.append({"item_id": self.ids[owner], "coverage": covered, "tiles": len(tiles)})
        return sorted(found, key=lambda h: (h["item_id"] is None, h["item_id"] or 0))


def _hits_column(block, coverage: float):
    @F.arrow_udf(HITS)
    def hits(text: pa.Array) -> pa.Array:
        parts = (text.slice(start, ROWS_AT_ONCE) for start in range(0, len(text), ROWS_AT_ONCE))
        found = pa.array([hits for part in parts for hits in _row_hits(block.value, part, coverage)], _ARROW_HITS)
        pa.default_memory_pool().release_unused()  # workers outlive a stage
        return found

    return hits


def _row_hits(items: Items, text: pa.Array, coverage: float) -> Iterator[list[dict]]:
    lowered = pa.array([(t or "").lower() for t in text.to_pylist()], pa.large_string())
    data, offsets = text_bytes(lowered)
    for first, last in pieces(offsets):
        hashes, at = hashed_words(data, offsets[first : last + 1], ALPHANUMERIC)
        for row in range(last - first):
            yield items.hits(hashes[at[row] : at[row + 1]], coverage)


def item_blocks(items: DataFrame, id_col: str, text_col: str, chars: int = BLOCK_CHARS) -> Iterator[Items]:
    """The query set in blocks of about ``chars`` characters; only one block at a time is on the driver."""
    plain = items.select(
        column(items, id_col).cast("long").alias("item_id"), F.coalesce(column(items, text_col).cast("string"), F.lit("")).alias("text")
    )
    total = plain.agg(F.sum(F.length("text") + 64)).first()[0] or 0
    blocks = total // chars + 1
    for block in range(blocks):
        rows = plain.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        yield Items([r.item_id for r in rows], [r.text for r in rows])


def leaks_column(
    spark: SparkSession, text: Column, items: DataFrame, id_col: str = "item_id", text_col: str = "text", coverage: float = COVERAGE
) -> Column:
    """For each text an array of the items that leak into it: item, covered share of the item, number of tiles."""
    parts = [_hits_column(spark.sparkContext.broadcast(b), coverage)(text) for b in item_blocks(items, id_col, text_col)]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def with_leaks(
    spark: SparkSession, docs: DataFrame, items: DataFrame, into: str = "leaks", text_col: str = "text", coverage: float = COVERAGE
) -> DataFrame:
    """``docs`` with the array of leaking items in the column ``into``."""
    return docs.withColumn(into, leaks_column(spark, column(docs, text_col).cast("string"), items, coverage=coverage))
