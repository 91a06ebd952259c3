"""Approximate nearest neighbours: a forest of random-projection trees, one queue, exact ranking.

The trees are grown on a bounded sample, one task a tree; every vector is put into its leaf of
every tree. A query's search walks all trees through one priority queue and names the leaves to
look into; queries and members then meet leaf by leaf, where the distances of all members are
computed exactly and the nearest leave the task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablepull.functions.names import qcol
from tablepull.llm import forest
from tablepull.llm.tables import stored

TREES = 24
# Points of the sample in a leaf, at most, and the points that the leaves of a search hold in sum.
LEAF = 32
SEARCH = 20_000
# Vectors of the sample (the first ones by hash of their id) take so many bytes at most.
SAMPLE_BYTES = 24 * 1024 * 1024
# Members of a leaf that are compared in one task.
MEMBERS = 20_000


def _valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the vectors that take part, repeated rows once."""
    v = qcol(vector_col).cast("array<double>")
    rows = vectors.select(qcol(id_col).cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(finite & F.exists("v", lambda x: x != 0)).distinct()
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), F.desc("n")).first()
    return rows.where(F.size("v") == (sizes["n"] if sizes else 0))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def grow_forest(rows: DataFrame, trees: int, leaf: int) -> list[forest.Tree]:
    """Trees over a sample of ``rows`` (id, v), grown in one task each."""
    spark, first = rows.sparkSession, rows.select(F.size("v")).first()
    if first is None:
        return []
    limit = max(1000, SAMPLE_BYTES // (4 * first[0]))
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(limit).select(F.col("v").cast("array<float>").alias("v")).toArrow()
    shared = spark.sparkContext.broadcast(_matrix(sample["v"]).astype(np.float32))
    names = ("plane", "offset", "child", "size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column("id").to_pylist():
                tree = forest.grow(shared.value, leaf, number)
                yield pa.record_batch([pa.array([number])] + [pa.array([tree[n].tobytes()], pa.binary()) for n in names], names=["tree", *names])

    grown = spark.range(0, trees, 1, trees).mapInArrow(run, "tree long, plane binary, offset binary, child binary, size binary")
    found = []
    for row in sorted(grown.collect()):
        parts = {"plane": np.float32, "offset": np.float32, "child": np.int32, "size": np.int64}
        tree = {name: np.frombuffer(row[name], kind) for name, kind in parts.items()}
        found.append(tree | {"plane": tree["plane"].reshape(-1, first[0]), "child": tree["child"].reshape(-1, 2)})
    return found


def _members(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                points = _matrix(part.column("v")).astype(np.float32)
                for number, tree in enumerate(shared.value):
                    leaf = forest.leaves(tree, points)
                    yield pa.record_batch([pa.array(np.full(len(leaf), number, np.int32)), pa.array(leaf.astype(np.int32)), part.column("id"), part.column("v")], names=["tree", "leaf", "id", "v"])

    return run


def _probes(shared, search: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _matrix(batch.column("v")).astype(np.float32)
            for row, point in enumerate(points):
                found = np.array(forest.probe(shared.value, point, search), np.int32).reshape(-1, 2)
                same = pa.array(np.full(len(found), row))
                yield pa.record_batch([pa.array(found[:, 0]), pa.array(found[:, 1]), batch.column("id").take(same), batch.column("v").take(same)], names=["tree", "leaf", "id", "v"])

    return run


def _ranked(top: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(members: pa.Table, queries: pa.Table) -> pa.Table:
        out = []
        if members.num_rows and queries.num_rows:
            ids, points = members["id"].to_numpy(), _matrix(members["v"])
            for query, point in zip(queries["id"].to_numpy(), _matrix(queries["v"])):
                score = np.sqrt(np.square(points - point).sum(axis=1))
                score[ids == query] = np.inf
                # All that are as near as the last one wanted, so that ties stay open.
                last = np.partition(score, top - 1)[top - 1] if len(score) > top else np.inf
                near = np.flatnonzero((score <= last) & (score < np.inf))
                near = near[np.lexsort((ids[near], score[near]))][:top]
                out.append((np.full(len(near), query, np.int64), ids[near], score[near]))
        q, i, s = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pa.table([pa.array(q), pa.array(i), pa.array(s)], names=["query_id", "vec_id", "score"])

    return run


def nearest(
    vectors: DataFrame, every: int = 100, top: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    trees: int = TREES, leaf: int = LEAF, search: int = SEARCH,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` nearest found of every vector whose id is divisible by ``every``.

    The score is the Euclidean distance in double precision; ties go to the smaller id. Vectors
    that are null, zero, of another length than most, or hold null or non-finite components,
    and rows with a null id, take no part. Repeated rows count once. Rows that share an id are
    all searched, never found by a query of that id, and found once, by their nearest. With few vectors all are
    candidates; an empty table gives an empty result; other columns are not read.
    """
    spark = vectors.sparkSession
    rows = stored(_valid(vectors, id_col, vector_col), "vectors")
    schema = "query_id long, vec_id long, score double"
    grown = grow_forest(rows, trees, leaf)
    if not grown:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared = spark.sparkContext.broadcast(grown)
    # Of equal vectors only the smallest ids can be among the nearest: the query's own and ``top`` more.
    copies = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    members = rows.withColumn("copy", copies).where(F.col("copy") <= top + 1).select("id", "v")
    kind = "tree int, leaf int, id long, v array<double>"
    members = members.mapInArrow(_members(shared), kind)
    probes = rows.where(F.col("id") % every == 0).mapInArrow(_probes(shared, search), kind)
    # A leaf that holds more than expected is dealt to several tasks; all its queries go to each.
    sizes = members.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > MEMBERS)
    large = F.broadcast(stored(sizes.select("tree", "leaf", F.expr(f"int(ceil(members / {MEMBERS}))").alias("parts")), "leaves"))
    members = members.join(large, ["tree", "leaf"], "left").withColumn("part", F.expr("int(pmod(xxhash64(id), coalesce(parts, 1)))"))
    probes = probes.join(large, ["tree", "leaf"], "left").withColumn("part", F.explode(F.expr("sequence(0, coalesce(parts, 1) - 1)")))
    keys = ["tree", "leaf", "part"]
    met = members.drop("parts").groupBy(*keys).cogroup(probes.drop("parts").groupBy(*keys)).applyInArrow(_ranked(top), schema)
    once = met.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return once.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
