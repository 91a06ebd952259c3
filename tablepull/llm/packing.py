"""Best-fit packing of documents into sequences, without two of a source or of a duplicate cluster in one.

Documents are dealt at random into shards of bounded size. In a shard the longest pieces go
first; the bins are kept in order of what is left in them, each with a bitmap of its sources
and one of its clusters, and the search goes on from the tightest bin that is large enough to
the next larger until one is compatible.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablepull.functions.names import qcol
from tablepull.llm.hashing import WORD_BYTES, chunks, sequence_hashes, word_hashes
from tablepull.llm.minhash import near_duplicates
from tablepull.llm.tables import broadcast_below, repeated, stored

# Documents that are packed together. Shards are dealt by hash, so they differ little in size.
SHARD_ROWS = 8192
# Bytes of a cluster's row in a table that is copied to all executors, at most.
CLUSTER_BYTES = 64
_ROWS = "id {id_type}, source string, node long, n long, cluster long"


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Instead of the text its number of words and a hash of them in lower case."""
    for batch in batches:
        lowered = pc.utf8_lower(batch.column("text").cast(pa.large_string()).fill_null(""))
        counts, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for _, _, data, offsets in chunks(lowered, WORD_BYTES):
            words, rows = word_hashes(data, offsets)
            counts.append(np.diff(rows))
            hashes.append(sequence_hashes(words, rows))
        described = [pa.array(np.concatenate(counts), pa.int64()), pa.array(np.concatenate(hashes).view(np.int64))]
        yield pa.record_batch([*(batch.column(c) for c in ("id", "source", "node")), *described], names=["id", "source", "node", "n", "cluster"])


def _node(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def near_clusters(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(node, near) of the texts that are a near copy of another: near copies have equal ``near``; ``node`` is a text's hash.

    See ``near_duplicates``; letter case is folded as for copies. Texts are nodes here, not
    documents, so ids that are null or shared do not matter. Texts of equal words have equal shingles.
    """
    text = qcol(text_col)
    texts = docs.select(_node(text).alias("node"), F.lower(text).alias("text"))
    near = near_duplicates(texts, "node").where("component_id != node")
    return stored(near.select("node", F.col("component_id").alias("near")).distinct(), "clusters")


def _bits(values: list) -> list[int]:
    """A bit for each value that occurs twice or more, none for others and for null."""
    seen, places = {}, {}
    for value in values:
        if value is not None:
            seen[value] = seen.get(value, 0) + 1
    for value, count in seen.items():
        if count > 1:
            places[value] = 1 << len(places)
    return [places.get(value, 0) for value in values]


def pack(lengths: list[int], sources: list, clusters: list, capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """(row, piece, start, length, bin, offset in bin) of every piece of every non-empty row, in the order given.

    A row longer than ``capacity`` is cut into full bins and a rest.
    """
    source_bits, cluster_bits = _bits(sources), _bits(clusters)
    pieces = []
    for row, length in enumerate(lengths):
        for piece, start in enumerate(range(0, length, capacity)):
            pieces.append((min(capacity, length - start), row, piece, start))
    pieces.sort(key=lambda p: (-p[0], p[1], p[2]))
    left: list[tuple[int, int]] = []
    in_source, in_cluster, placed = [], [], []
    for length, row, piece, start in pieces:
        source, cluster = source_bits[row], cluster_bits[row]
        at = bisect_left(left, (length, -1))
        while at < len(left) and (in_source[left[at][1]] & source or in_cluster[left[at][1]] & cluster):
            at += 1
        if at < len(left):
            room, number = left.pop(at)
        else:
            room, number = capacity, len(in_source)
            in_source.append(0)
            in_cluster.append(0)
        in_source[number] |= source
        in_cluster[number] |= cluster
        placed.append((row, piece, start, length, number, capacity - room))
        if room > length:
            insort(left, (room - length, number))
    return placed


def pack_documents(docs: DataFrame, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", clusters: DataFrame | None = None) -> DataFrame:
    """(id, piece, start, n_tokens, bin_id, bin_offset): where each piece of each document goes.

    Lengths are counted in words between ASCII white space. No bin holds two documents of one
    source or of one duplicate cluster; a null source conflicts with none. ``clusters`` of
    ``near_clusters`` makes near copies one cluster, otherwise only copies are. Documents without
    words come back once with length 0 and a null bin. Repeated rows are packed as often as
    they occur, into different bins; equal lengths go by id, nulls first. An empty table gives
    an empty result; other columns are not read.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), _node(qcol(text_col)).alias("node"), qcol(text_col).alias("text"))
    rows = rows.mapInArrow(_described, _ROWS.format(id_type=id_type))
    # Copies that differ in white space or letter case are different nodes of one cluster; near copies join nodes.
    near = F.col("cluster") if clusters is None else F.coalesce("near", "node")
    if clusters is not None:
        rows = rows.join(broadcast_below(clusters, clusters.count(), CLUSTER_BYTES), "node", "left")
    rows = rows.groupBy("id", "source", "n", "cluster", near.alias("near")).agg(F.count(F.lit(1)).alias("copies"))
    total = docs.select(F.count(F.lit(1))).first()[0]
    shards = max(1, -(-total // SHARD_ROWS))
    rows = repeated(rows, "copies", "copy")
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("id", "n", "cluster", "copy"), F.lit(shards)))

    def shard_bins(table: pa.Table) -> pa.Table:
        order = pc.sort_indices(table, [(c, "ascending") for c in ("id", "n", "cluster", "copy")], null_placement="at_start")
        table = table.take(order)
        shard, lengths = table["shard"][0].as_py(), table["n"].to_pylist()
        placed = pack(lengths, table["source"].to_pylist(), table["near"].to_pylist(), capacity)
        placed = [(row, piece, start, n, (shard << 32) + number, offset) for row, piece, start, n, number, offset in placed]
        placed += [(row, 0, 0, 0, None, None) for row, n in enumerate(lengths) if n == 0]
        row, *rest = zip(*placed)
        return pa.table([table["id"].take(pa.array(row)), *(pa.array(c, pa.int64()) for c in rest)], names=names)

    names = [id_col, "piece", "start", "n_tokens", "bin_id", "bin_offset"]
    schema = f"`{id_col}` {id_type}, piece long, start long, n_tokens long, bin_id long, bin_offset long"
    return rows.groupBy("shard").applyInArrow(shard_bins, schema)
