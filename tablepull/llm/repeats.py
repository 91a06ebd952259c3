"""Repeated byte strings: the windows of all texts, sorted by bucket-pointer refinement.

A string of ``LENGTH`` bytes (a window) belongs to the bucket of one of its q-grams, the one of
the smallest hash, so equal windows are always of one bucket, and runs of neighbouring windows
share it: one row for each run goes through the shuffle. A bucket in which one run occurs alone
has no repeats; a run equal to an earlier one is repeated as a whole. What is left, different
runs of one bucket, has its bytes fetched, and its windows are sorted: by 8-grams first, then
by the bucket pointers of later offsets, which the rounds before have already refined.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablepull.functions.names import qcol
from tablepull.llm.hashing import chunks, mix, prefixes, span_hash, texts
from tablepull.llm.tables import stored

LENGTH = 100
GRAM = 24
# Bytes of runs that are sorted at once, and the runs of one bucket beyond which its windows are
# dealt out singly by their hash (a bucket is then no task's work).
SORT_BYTES = 512 * 1024
BUCKET_RUNS = 10_000
_PLACE_BITS = np.uint64(24)
_PIECE = 1 << 22
# Bytes of short texts that are taken together, so that their hashes stay in a core's cache.
CHUNK = 1 << 16
_NULL_ID = -(2**63)


def window_runs(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(row, first window, last window - first, bucket, hash) of the runs of windows of one bucket, over all rows.

    The last is the hash of the bytes of the run, with the place of its q-gram.
    """
    n = len(data) - length + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    sums = prefixes(data)
    at = np.arange(len(data) - gram + 1)
    grams = span_hash(sums, at, at + gram)
    # The smallest hash of each window, the leftmost if several: place in the low bits.
    keys = (grams >> _PLACE_BITS << _PLACE_BITS) | at.astype(np.uint64)
    width = length - gram + 1
    padded = np.full(-(-len(keys) // width) * width + width, np.uint64(2**64 - 1))
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    anchor = (np.minimum(backward[:n], forward[width - 1 : width - 1 + n]) & np.uint64((1 << int(_PLACE_BITS)) - 1)).astype(np.int64)
    # Windows that end behind their row are none.
    sizes = np.diff(offsets)
    row, valid = np.repeat(np.arange(len(sizes)), sizes)[:n], np.arange(n) + length <= np.repeat(offsets[1:], sizes)[:n]
    change = np.flatnonzero((anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1]) | (row[1:] != row[:-1])) + 1
    first = np.concatenate([[0], change])
    last = np.concatenate([change, [n]]) - 1
    first, last = first[valid[first]], last[valid[first]]
    place = anchor[first]
    prints = span_hash(sums, first, last + length) ^ (place - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return row[first], first - offsets[row[first]], last - first, grams[place], prints


def _runs(length: int, gram: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            for top, _, data, offsets in chunks(batch.column("text"), CHUNK):
                # A very long text is taken in pieces that overlap by a window less one byte.
                step = max(len(data), 1) if len(offsets) > 2 else _PIECE
                for base in range(0, max(len(data) - length + 1, 1), step):
                    piece = data[base : base + step + length - 1]
                    ends = offsets if len(offsets) > 2 else np.array([0, len(piece)])
                    row, first, more, bucket, prints = window_runs(piece, ends, length, gram)
                    span = (first + base) << 8 | more
                    # A run that its own text has seen is settled here: however often a text repeats
                    # itself, it adds one row to a bucket. Settled rows are dealt out by themselves.
                    own = np.ones(len(row), bool)
                    own[np.unique(mix(mix(bucket ^ row.astype(np.uint64)) ^ prints), return_index=True)[1]] = False
                    bucket = np.where(own, mix(bucket + span.astype(np.uint64)), bucket)
                    yield pa.record_batch(
                        [pa.array(bucket.view(np.int64)), pa.array(prints.view(np.int64)), pa.array(ids[top + row]), pa.array(span), pa.array(own)],
                        names=["bucket", "print", "id", "span", "own"],
                    )

    return run


def _slices(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The bytes of the runs ``spans`` of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                data, offsets = texts(part.column("text"))
                buckets, crowded, ids, spans, pieces = [], [], [], [], []
                rows = zip(part.column("id").to_pylist(), part.column("runs").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist())
                for id_, wanted, start, end in rows:
                    for one in wanted:
                        first = one["span"] >> 8
                        piece = data[start + first : min(start + first + (one["span"] & 255) + length, end)]
                        if len(piece) == (one["span"] & 255) + length:
                            buckets.append(one["bucket"])
                            crowded.append(one["crowded"])
                            ids.append(id_)
                            spans.append(one["span"])
                            pieces.append(piece.tobytes())
                yield pa.record_batch(
                    [pa.array(buckets, pa.int64()), pa.array(crowded, pa.bool_()), pa.array(ids, pa.int64()), pa.array(spans, pa.int64()), pa.array(pieces, pa.binary())],
                    names=["bucket", "crowded", "id", "span", "bytes"],
                )

    return run


def refined(data: np.ndarray, ends: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Bucket pointers of the windows of ``length`` bytes at ``starts``: equal for equal windows.

    ``ends`` is, for each byte, the end of the text it belongs to. Buckets are those of the
    8-grams; each round sorts the members of buckets of two or more by the pointer of the place
    where their known prefix ends. Pointers are replaced in place, so a round's pointers serve
    the next one at twice the depth.
    """
    step = min(8, length)
    at = np.flatnonzero(np.arange(len(data)) + step <= ends)
    # Eight bytes from every place on as one number, the first byte on top.
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    grams = np.ndarray(len(data), ">u8", padded, strides=(1,)).astype(np.uint64)[at] >> np.uint64(8 * (8 - step))
    pointer = np.full(len(data), -1, np.int64)
    # Pointers do not depend on the order of equal numbers, so no sort has to keep it.
    order = np.argsort(grams)
    grams = grams[order]
    pointer[at[order]] = _bucket_starts(grams[1:] != grams[:-1], 0)
    depth = step
    while depth < length:
        reach = min(2 * depth, length)
        places = starts if reach == length else np.flatnonzero(np.arange(len(data)) + reach <= ends)
        # Members of buckets that are still shared.
        size = np.bincount(pointer[places], minlength=len(data))
        places = places[size[pointer[places]] > 1]
        # Both pointers as one number.
        both = pointer[places] * len(data) + pointer[places + reach - depth]
        order = np.argsort(both)
        places, both = places[order], both[order]
        old, split = pointer[places], both[1:] != both[:-1]
        head = np.concatenate([[True], old[1:] != old[:-1]])[: len(old)]
        begin = np.maximum.accumulate(np.where(head, np.arange(len(old)), 0))
        within = _bucket_starts(split, 0) - begin
        pointer[places] = old + within
        depth = reach
    return pointer[starts]


def _bucket_starts(split: np.ndarray, base: int) -> np.ndarray:
    """For each member of a sorted list the place of the first of its bucket; ``split``: a bucket begins at the next."""
    begins = np.concatenate([[True], split])
    return base + np.maximum.accumulate(np.where(begins, np.arange(len(begins)), 0))


def _later_windows(pointer: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Whether a window equals one of a smaller (id, start)."""
    later = np.zeros(len(pointer), bool)
    shared = np.flatnonzero(np.bincount(pointer)[pointer] > 1)
    order = shared[np.lexsort((starts[shared], ids[shared], pointer[shared]))]
    p, i, s = pointer[order], ids[order], starts[order]
    first = _bucket_starts(p[1:] != p[:-1], 0)[: len(p)]
    later[order] = (i != i[first]) | (s != s[first])
    return later


def _sorted(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Repeated stretches of the runs of whole buckets, which come in bucket order."""

    def solve(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        data, offsets = texts(table["bytes"])
        span, ids = table["span"].to_numpy(), table["id"].to_numpy()
        windows = (span & 255) + 1
        run = np.repeat(np.arange(len(span)), windows)
        inside = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        ends = np.repeat(offsets[1:], np.diff(offsets))
        pointer = refined(data, ends, offsets[run] + inside, length)
        start = (span[run] >> 8) + inside
        later = _later_windows(pointer, ids[run], start)
        # Neighbouring windows of a run make one stretch.
        run, start = run[later], start[later]
        cut = np.flatnonzero((run[1:] != run[:-1]) | (start[1:] != start[:-1] + 1)) + 1
        first, last = np.concatenate([[0], cut])[: len(run)], np.concatenate([cut, [len(run)]])[: len(run)] - 1
        return pa.record_batch([pa.array(ids[run[first]]), pa.array(start[first]), pa.array(start[last] + length)], names=["id", "from", "to"])

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            while batch.num_rows:
                bucket = batch.column("bucket").to_numpy()
                if size >= SORT_BYTES:
                    # Go on to the end of the bucket, then sort.
                    last = held[-1].column("bucket")[-1].as_py()
                    rest = int(np.argmax(bucket != last)) if (bucket != last).any() else len(bucket)
                    if rest:
                        held.append(batch.slice(0, rest))
                    batch = batch.slice(rest)
                    if batch.num_rows:
                        yield solve(held)
                        held, size = [], 0
                    continue
                take = batch.slice(0, 4096)
                held.append(take)
                size += pc.sum(pc.binary_length(take.column("bytes"))).as_py() or 0
                batch = batch.slice(4096)
        if held:
            yield solve(held)

    return go


def _single(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Every window of the runs, by the digest of its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, ids, starts = [], [], []
            for id_, span, data in zip(*(batch.column(c).to_pylist() for c in ("id", "span", "bytes"))):
                for k in range((span & 255) + 1):
                    digests.append(hashlib.blake2b(data[k : k + length], digest_size=16).digest())
                    ids.append(id_)
                    starts.append((span >> 8) + k)
            yield pa.record_batch([pa.array(digests, pa.binary()), pa.array(ids, pa.int64()), pa.array(starts, pa.int64())], names=["digest", "id", "start"])

    return run


def repeated_stretches(rows: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(id, from, to) of byte ranges of ``rows`` (id, text) that repeated windows cover; ranges may overlap."""
    runs = rows.mapInArrow(_runs(length, gram), "bucket long, print long, id long, span long, own boolean")
    whole, equal = Window.partitionBy("bucket"), Window.partitionBy("bucket", "print").orderBy("id", "span")
    runs = runs.withColumn("low", F.min("print").over(whole)).withColumn("high", F.max("print").over(whole)).withColumn("members", F.count(F.lit(1)).over(whole))
    runs = runs.where("members > 1 or own").withColumn("first", F.first(F.struct("id", "span")).over(equal))
    runs = stored(runs.select("bucket", "print", "id", "span", "own", "first", (F.col("low") != F.col("high")).alias("mixed")), "runs")
    copy = F.col("own") | (F.struct("id", "span") != F.col("first"))
    start = F.shiftright("span", 8)
    spans = runs.where(copy).select("id", start.alias("from"), (start + F.col("span").bitwiseAND(255) + length).alias("to"))
    open_ = runs.where(~copy & F.col("mixed")).select("bucket", "id", "span").distinct()
    crowded = open_.groupBy("bucket").agg(F.count(F.lit(1)).alias("runs")).where(F.col("runs") > BUCKET_RUNS).select("bucket", F.lit(True).alias("crowded"))
    open_ = open_.join(crowded, "bucket", "left").withColumn("crowded", F.coalesce("crowded", F.lit(False)))
    wanted = open_.groupBy("id").agg(F.collect_list(F.struct("bucket", "crowded", "span")).alias("runs"))
    pieces = rows.join(wanted, "id").mapInArrow(_slices(length), "bucket long, crowded boolean, id long, span long, bytes binary")
    pieces = stored(pieces, "pieces")
    together = pieces.where("not crowded").drop("crowded").repartition("bucket").sortWithinPartitions("bucket")
    found = together.mapInArrow(_sorted(length), "id long, from long, to long")
    single = pieces.where("crowded").mapInArrow(_single(length), "digest binary, id long, start long")
    earliest = single.groupBy("digest").agg(F.min(F.struct("id", "start")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = single.join(earliest, "digest").where(F.struct("id", "start") != F.col("first"))
    return spans.unionByName(found).unionByName(later.select("id", F.col("start").alias("from"), (F.col("start") + length).alias("to")))


def _removed(spans: list[dict] | None, size: int) -> list[tuple[int, int]]:
    """The stretches in order, merged where they touch, within the text."""
    merged: list[list[int]] = []
    for start, end in sorted((s["from"], min(s["to"], size)) for s in spans or ()):
        if start >= end:
            continue
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    return merged


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            data, offsets = texts(part.column("text"))
            out = []
            for start, end, spans in zip(offsets[:-1].tolist(), offsets[1:].tolist(), part.column("spans").to_pylist()):
                text, gone = data[start:end].tobytes(), _removed(spans, end - start)
                edges = [0, *(x for span in gone for x in span), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((len(text), sum(b - a for a, b in gone), len(gone), kept))
            n, removed, spans, kept = zip(*out)
            yield pa.record_batch(
                [part.column("own"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept"],
            )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept): the texts, as UTF-8 bytes, without what an earlier window repeats.

    A byte goes if a window of ``length`` bytes covers it that also starts earlier: in a document
    of a smaller id (null first), or earlier in the same document. Windows are judged on the
    input; ``n_spans`` counts the maximal removed runs; ``kept`` is what is left, as bytes. Null
    texts count as empty; texts shorter than a window stay whole. Rows that share an id are one document to the order: equal places
    of theirs do not repeat each other, and a stretch that goes in one goes in all. Repeated rows
    come back as often as they occur; an empty table gives an empty result; other columns are not read.
    """
    rows = docs.select(F.coalesce(qcol(id_col).cast("long"), F.lit(_NULL_ID)).alias("id"), qcol(text_col).alias("text"))
    spans = repeated_stretches(rows, length).groupBy("id").agg(F.collect_list(F.struct("from", "to")).alias("spans"))
    own = F.when(F.col("id") != _NULL_ID, F.col("id")).alias("own")
    joined = rows.join(spans, "id", "left").select(own, "text", "spans")
    out = joined.mapInArrow(_cut, "id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.withColumnRenamed("id", id_col)
