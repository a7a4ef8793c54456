"""Hashes of words and word shingles over a whole Arrow batch at once.

All functions work on the UTF-8 bytes as they lie in the Arrow buffer, in pieces of about ``PIECE`` bytes cut at
document borders, so memory does not depend on the size of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
#: For shingles: pieces whose words and hashes stay in a core's cache.
SHINGLE_PIECE = 1 << 16
SHINGLE_WORDS = 5

#: Byte tables: A-Z to a-z; what separates words: the space and 0x09-0x0D only, or every ASCII byte but 0-9A-Za-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IN_WORD = np.ones(256, dtype=bool)
IN_WORD[[9, 10, 11, 12, 13, 32]] = False
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[48:58] = ALPHANUMERIC[65:91] = ALPHANUMERIC[97:123] = ALPHANUMERIC[128:] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {base: np.ones(1, dtype=np.uint64) for base in (_BASE, _INVERSE)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """1, B, B², … mod 2⁶⁴, at least ``n`` of them; no more than ``PIECE`` are kept for the next call."""
    known = _powers[base]
    if len(known) < n:
        known = np.full(max(n, 64), base, dtype=np.uint64)
        known[0] = 1
        np.cumprod(known, dtype=np.uint64, out=known)
        if n <= PIECE:
            _powers[base] = known
    return known[:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the offsets of its rows; nulls are empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    bytes_ = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return bytes_, offsets


def pieces(offsets: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; a longer row stands alone."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        end = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
        end = min(max(end, start + 1), rows)
        yield start, end
        start = end


def hashed_words(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray = IN_WORD) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the rows between ``offsets``, and where each row's words begin (one more entry)."""
    low, high = int(offsets[0]), int(offsets[-1])
    rows = len(offsets) - 1
    if low == high:
        return np.zeros(0, dtype=np.uint64), np.zeros(rows + 1, dtype=np.int64)
    part = LOWER[data[low:high]]
    inside = in_word[part]
    border = np.zeros(high - low + 1, dtype=bool)
    border[offsets - low] = True
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | border[:-1]))
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), np.zeros(rows + 1, dtype=np.int64)
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | border[1:])) + 1
    # a word's sum of (byte + 1) * B^place is a difference of prefix sums over the places in the piece, moved to its start
    prefix = np.zeros(high - low + 1, dtype=np.uint64)
    np.cumsum((part.astype(np.uint64) + np.uint64(1)) * powers(high - low), out=prefix[1:])
    value = (prefix[ends] - prefix[starts]) * powers(high - low, _INVERSE)[starts]
    hashes = mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return hashes, np.searchsorted(starts, offsets - low)


def shingles(hashes: np.ndarray, size: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of all windows of ``size`` words, in order; fewer words make one shingle, none make none."""
    if not len(hashes):
        return hashes
    width = min(size, len(hashes))
    count = len(hashes) - width + 1
    total = np.full(count, width, dtype=np.uint64)
    for k in range(width):
        total = mix(total * np.uint64(_BASE) + hashes[k : k + count])
    return total


def _windows(hashes: np.ndarray, starts: np.ndarray | slice, count: int, width: int) -> np.ndarray:
    """``shingles`` of ``width`` words that begin at ``starts``, for all at once."""
    total = np.full(count, width, dtype=np.uint64)
    for k in range(width):
        words = hashes[k : k + count] if isinstance(starts, slice) else hashes[starts + k]
        total = mix(total * np.uint64(_BASE) + words)
    return total


def shingle_pieces(column: pa.Array, size: int = SHINGLE_WORDS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each piece of rows: its first row, the sorted distinct shingle hashes of its rows one after the other, and
    where each row's begin (one more entry)."""
    data, offsets = text_bytes(column)
    for first, last in pieces(offsets, SHINGLE_PIECE):
        hashes, at = hashed_words(data, offsets[first : last + 1])
        count = len(hashes)
        total, inside = np.empty(count, dtype=np.uint64), np.zeros(count, dtype=bool)
        whole = max(0, count - size + 1)
        total[:whole], inside[:whole] = _windows(hashes, slice(None), whole, size), True
        for k in range(1, size):  # no shingle goes over the border of two rows
            before = at[1:-1] - k
            inside[before[before >= 0]] = False
        n_words = np.diff(at)
        for width in range(1, size):  # rows of fewer words are one shingle
            short = at[:-1][n_words == width]
            total[short], inside[short] = _windows(hashes, short, len(short), width), True
        values = total[inside]
        begin = np.concatenate([[0], np.cumsum(np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1)))])
        for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
            values[a:b].sort()
        fresh = np.ones(len(values), dtype=bool)
        fresh[1:] = values[1:] != values[:-1]
        fresh[begin[:-1][n_words > 0]] = True
        yield first, values[fresh], np.concatenate([[0], np.cumsum(fresh)])[begin]


def shingle_sets(column: pa.Array, size: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    for _, values, begin in shingle_pieces(column, size):
        for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
            yield values[a:b].copy()
