"""Benchmark items inside documents: SimHash windows, multi-index Hamming blocks, exact check.

An item of n words is looked for in every window of n words. Only windows that share a shingle
with some item of their size can reach the bar, so only these get a SimHash (off prefix sums
of the shingles' bits). Of two fingerprints within the radius some block of eight bits differs
in at most radius // 8 bits; tables of such blocks give the candidates, whose distance is then
checked, and their weighted shingle similarity decides.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablepull.llm.hashing import chunks, combine, word_hashes
from tablepull.llm.tables import filtered

# Bytes of benchmark text whose index is copied to all executors at once; more goes in further passes.
INDEX_BYTES = 4 * 1024 * 1024
# Differing bits of 64. At a similarity of 0.75 the fingerprints differ in 11 on average, and in more
# than the radius once in some ten thousand windows.
RADIUS = 24
_BLOCKS = 8
_BITS = np.arange(64, dtype=np.uint64)
_ONES = np.array([bin(i).count("1") for i in range(256)])
_FILTER_BITS = 20


def _signs(shingles: np.ndarray) -> np.ndarray:
    """One row of 64 times +1 or -1 for each shingle."""
    return ((shingles[:, None] >> _BITS) & np.uint64(1)).astype(np.int32) * 2 - 1


def _packed(sums: np.ndarray) -> np.ndarray:
    """Fingerprints, as eight bytes each, of rows of summed signs."""
    return np.packbits(sums > 0, axis=1)


def weighted_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of the lesser over sum of the greater counts of all shingles of two texts."""
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    common = int(np.minimum(n[i], m[j]).sum())
    return common / (len(a) + len(b) - common)


class ItemIndex:
    """The items of one benchmark chunk, by size in words."""

    def __init__(self, ids: list, texts: list[str | None], size: int):
        self.size, self.ids, self.runs, self.lengths = size, [], [], []
        for _, _, data, offsets in chunks(pa.array(texts, pa.string())):
            words, rows = word_hashes(data, offsets)
            for a, b in zip(rows[:-1].tolist(), rows[1:].tolist()):
                self.lengths.append(b - a)
                self.runs.append(combine(words[a:b], min(size, b - a)) if b > a else np.zeros(0, np.uint64))
        self.ids = list(ids)
        self.by_length: dict[int, np.ndarray] = {}
        for n in sorted(set(self.lengths) - {0}):
            self.by_length[n] = np.flatnonzero(np.array(self.lengths) == n)
        # Shingles of all items of a width, and the lengths of the items that have them.
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for width in {min(size, n) for n in self.by_length}:
            members = [i for i, n in enumerate(self.lengths) if n and min(size, n) == width]
            pairs = np.unique(np.stack([np.concatenate([self.runs[i] for i in members]), np.concatenate([np.full(len(self.runs[i]), self.lengths[i], np.uint64) for i in members])]), axis=1)
            self.known[width] = (pairs[0], pairs[1].astype(np.int64))
        self.filters = {}
        for width, (shingles, _) in self.known.items():
            self.filters[width] = np.zeros(1 << _FILTER_BITS, bool)
            self.filters[width][shingles & np.uint64((1 << _FILTER_BITS) - 1)] = True
        self.prints, self.tables = {}, {}
        near = _ONES[np.arange(256)[:, None] ^ np.arange(256)] <= RADIUS // _BLOCKS
        for n, items in self.by_length.items():
            self.prints[n] = np.concatenate([_packed(_signs(self.runs[i]).sum(axis=0)[None]) for i in items])
            # tables[n][block][value]: the items whose block is that close to the value.
            self.tables[n] = [near[:, self.prints[n][:, block]] for block in range(_BLOCKS)]

    def _starts(self, words: np.ndarray) -> dict[int, np.ndarray]:
        """For each item length the window starts that share a shingle with an item of that length."""
        found: dict[int, list[np.ndarray]] = {}
        for width, (shingles, lengths) in self.known.items():
            if len(words) < width:
                continue
            runs = combine(words, width)
            places = np.flatnonzero(self.filters[width][runs & np.uint64((1 << _FILTER_BITS) - 1)])
            first = np.searchsorted(shingles, runs[places], "left")
            count = np.searchsorted(shingles, runs[places], "right") - first
            places, first, count = places[count > 0], first[count > 0], count[count > 0]
            if not len(places):
                continue
            step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            place, length = np.repeat(places, count), lengths[np.repeat(first, count) + step]
            for n in np.unique(length):
                low = np.maximum(place[length == n] - (n - width), 0)
                high = np.minimum(place[length == n], max(len(words) - n, 0))
                marks = np.zeros(len(words) + 2, np.int64)
                np.add.at(marks, low, 1)
                np.add.at(marks, np.maximum(high, low) + 1, -1)
                found.setdefault(int(n), []).append(np.flatnonzero(np.cumsum(marks) > 0))
        return {n: np.unique(np.concatenate(parts)) for n, parts in found.items()}

    def find(self, words: np.ndarray, bar: float) -> Iterator[tuple[int, float, int, int]]:
        """(item, best similarity, first word of the first best window, windows at the bar) of each item found."""
        for n, starts in self._starts(words).items():
            width, size = min(self.size, n), min(n, len(words))
            if size < width:
                continue
            runs, span = combine(words, width), size - width + 1
            # Sums of the signs over the stretch that holds the windows, part by part.
            best: dict[int, list] = {}
            for at in range(0, len(starts), 4096):
                part = starts[at : at + 4096]
                part = part[part + span <= len(runs)]
                if not len(part):
                    continue
                for group in np.split(part, np.flatnonzero(np.diff(part) > 4096) + 1):
                    base = group[0]
                    signs = _signs(runs[base : group[-1] + span])
                    sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(signs, axis=0, dtype=np.int32)])
                    prints = _packed(sums[group - base + span] - sums[group - base])
                    near = self.tables[n][0][prints[:, 0]]
                    for block in range(1, _BLOCKS):
                        near = near | self.tables[n][block][prints[:, block]]
                    window, item = np.nonzero(near)
                    close = _ONES[prints[window] ^ self.prints[n][item]].sum(axis=1) <= RADIUS
                    for w, i in zip(window[close].tolist(), item[close].tolist()):
                        start, which = int(group[w]), int(self.by_length[n][i])
                        similarity = weighted_similarity(runs[start : start + span], self.runs[which])
                        if similarity >= bar:
                            state = best.setdefault(which, [0.0, 0, 0])
                            state[2] += 1
                            if similarity > state[0]:
                                state[:2] = similarity, start
            for which, (similarity, start, windows) in best.items():
                yield which, similarity, start, windows


def _indexes(benchmark: DataFrame, item_col: str, text_col: str, size: int) -> Iterator[ItemIndex]:
    items = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    parts = -(-total // INDEX_BYTES)
    for part in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part).distinct().orderBy("item", "text").collect()
        if rows:
            yield ItemIndex([r["item"] for r in rows], [r["text"] for r in rows], size)


def _documents(column: pa.Array) -> Iterator[np.ndarray]:
    for _, _, data, offsets in chunks(column):
        words, rows = word_hashes(data, offsets)
        for a, b in zip(rows[:-1].tolist(), rows[1:].tolist()):
            yield words[a:b]


def _shared(spark, index: ItemIndex):
    """The index as plain values: broadcasts are read without this package."""
    return spark.sparkContext.broadcast(vars(index))


def _restored(values: dict) -> ItemIndex:
    index = ItemIndex.__new__(ItemIndex)
    index.__dict__.update(values)
    return index


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", size: int = 5, bar: float = 0.75) -> DataFrame:
    """(id, item, similarity, start_word, n_words, n_windows): the items found in each document.

    Words lie between ASCII white space, A-Z lower-cased; the similarity is that of the counted
    shingles of ``size`` words (fewer words: of the whole item) of a window as long as the item,
    or of the whole document if that is shorter. Null, empty and blank texts and items match nothing; repeated
    rows of ``docs`` come back repeated, repeated items once; among equally similar windows the
    first one is told. Without documents or items the result is empty; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    item_type = benchmark.schema[item_col].dataType.simpleString()
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, `{item_col}` {item_type}, similarity double, start_word long, n_words long, n_windows long"
    found = None
    for index in _indexes(benchmark, item_col, item_text_col, size):
        one = rows.mapInArrow(_finder(_shared(docs.sparkSession, index), bar, id_col, item_col), schema)
        found = one if found is None else found.unionByName(one)
    return docs.sparkSession.createDataFrame([], schema) if found is None else found


def _finder(shared, bar: float, id_col: str, item_col: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _restored(shared.value)
        for batch in batches:
            rows, hits = [], []
            for row, words in enumerate(_documents(batch.column("text"))):
                for item, similarity, start, windows in index.find(words, bar):
                    rows.append(row)
                    hits.append((index.ids[item], similarity, start, index.lengths[item], windows))
            items, *rest = zip(*hits) if hits else ((), (), (), (), ())
            kinds = (pa.float64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch(
                [batch.column("id").take(pa.array(rows, pa.int64())), pa.array(items), *(pa.array(x, kind) for x, kind in zip(rest, kinds))] if hits else
                [batch.column("id").slice(0, 0), pa.array(items, pa.array(index.ids).type), *(pa.array(x, kind) for x, kind in zip(rest, kinds))],
                names=[id_col, item_col, "similarity", "start_word", "n_words", "n_windows"],
            )

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", size: int = 5, bar: float = 0.75) -> DataFrame:
    """The rows of ``docs``, all columns, in which no item of ``benchmark`` is found; see ``contaminated``."""
    at = docs.columns.index(text_col)
    for index in _indexes(benchmark, item_col, item_text_col, size):
        docs = filtered(docs, _dropper(_shared(docs.sparkSession, index), bar, at))
    return docs


def _dropper(shared, bar: float, at: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _restored(shared.value)
        for batch in batches:
            clean = [next(index.find(words, bar), None) is None for words in _documents(batch.column(at))]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return run
