"""Hashes of byte spans, words and shingles of whole Arrow batches, in numpy.

A span's hash is a polynomial of its bytes modulo 2**64, read off prefix sums, so that a
batch costs a few passes over its bytes whatever the number of spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_BYTE = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64)
_PLACE = np.random.default_rng(21).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER_BYTE = _BYTE[_LOWER]
_POWERS: dict[str, np.ndarray] = {}

# Bytes of text that are hashed at once; a longer document is hashed alone.
CHUNK_BYTES = 1 << 20
# The same where words are hashed: eight bytes of hashes for each byte of text stay in a core's cache.
WORD_BYTES = 1 << 17


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, CHUNK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            values = np.full(size, base, dtype=np.uint64)
            values[0] = 1
            _POWERS[name] = np.cumprod(values)
    return _POWERS["up"], _POWERS["down"]


def prefixes(data: np.ndarray, values: np.ndarray = _BYTE) -> np.ndarray:
    """``p`` such that ``span_hash(p, s, e)`` hashes ``data[s:e]``; ``values`` stand for the bytes."""
    _, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    terms = values.take(data)
    terms *= down[: len(data)]
    np.cumsum(terms, out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    up, _ = _powers(len(sums))
    sizes = (end - start).astype(np.uint64)
    sizes *= _BASE
    hashes = sums.take(end)
    hashes -= sums.take(start)
    hashes *= up.take(start)
    hashes += sizes
    return mix(hashes)


def texts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column, back to back, and the offsets of its rows; null counts as empty."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if array.null_count:
        array = array.fill_null("" if pa.types.is_string(array.type) or pa.types.is_large_string(array.type) else b"")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, places, data = array.buffers()
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes, or of one row."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row, bytes, offsets) of parts of a column."""
    data, offsets = texts(column)
    for first, last in slices(offsets, limit):
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` of all rows, and each row's first word."""
    blank = _SPACE.take(data)
    solid = ~blank
    start, end = solid.copy(), solid.copy()
    start[1:] &= blank[:-1]
    end[:-1] &= blank[1:]
    bounds = offsets[:-1][offsets[1:] > offsets[:-1]]
    start[bounds] = solid[bounds]
    inner = bounds[bounds > 0] - 1
    end[inner] = solid[inner]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, A-Z lower-cased, and each row's first word."""
    starts, ends, rows = word_spans(data, offsets)
    return span_hash(prefixes(data, _LOWER_BYTE), starts, ends), rows


def sequence_hashes(words: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """For each row a hash of all its words in order."""
    _, down = _powers(len(words) + 1)
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * down[: len(words)], out=sums[1:])
    return span_hash(sums, rows[:-1], rows[1:])


def combine(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words."""
    total = np.full(max(len(words) - size + 1, 0), (size * int(_BASE)) % 2**64, dtype=np.uint64)
    for k in range(size):
        total += words[k : len(words) - size + 1 + k] * _PLACE[k]
    return mix(total)


def shingle_rows(words: np.ndarray, rows: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """For each row its shingles in order: runs of ``size`` words, or all words if they are fewer."""
    runs = combine(words, size) if len(words) >= size else None
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist()):
        if b - a >= size:
            yield runs[a : b - size + 1]
        elif b > a:
            yield combine(words[a:b], b - a)
        else:
            yield np.zeros(0, np.uint64)


def distinct(values: np.ndarray) -> np.ndarray:
    """The sorted distinct values; several times faster than ``np.unique`` on the few thousand of a text."""
    values = np.sort(values)
    return values if len(values) < 2 else values[np.concatenate([[True], values[1:] != values[:-1]])]


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct shingle hashes of its lower-cased words."""
    for _, _, data, offsets in chunks(column, WORD_BYTES):
        words, rows = word_hashes(data, offsets)
        for runs in shingle_rows(words, rows, size):
            yield distinct(runs)
