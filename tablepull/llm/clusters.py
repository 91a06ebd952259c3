"""Exact k-means over whole-number vectors, with bounds that say which vectors need no scan.

Every vector carries a lower bound of its distance to all centroids but its own. After a round
the centroids have moved. A cluster lies in a sphere around its old centroid; in the plane of
that centre and the two places of another centroid, geometry says by how much the distance of
any point of the sphere to that centroid can have shrunk: at most by the move times the cosine
of the smallest angle, seen from the middle of the move, between its direction and the sphere.
The bounds of a cluster's vectors are loosened by the largest such value over the other
centroids instead of by the largest move. A vector that is nearer to its own centroid than its
bound stays where it is; all others are scanned exactly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablepull.llm.tables import drop_stored, stored
from tablepull.llm.vectors import largest, matrix, scaled

# Squared distances must fit 64 bits: dimensions * (2 * largest component) ** 2 stays below this.
DISTANCE_LIMIT = 2**62
# Below this sums of products are exact in double precision.
EXACT = 2**52
# Distances of vectors to centroids that a task holds at once.
HELD = 2**21
# Room for rounding in bounds, which are square roots of whole numbers.
_ROOM = 1e-9
_STATE = "id long, q array<int>, cluster int, distance long, lower double, scanned boolean"


def scan(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the smaller), its squared distance, and the second smallest one."""
    high = max((int(np.abs(m).max()) for m in (points, centroids) if m.size), default=0)
    kind = np.float64 if 4 * points.shape[1] * high**2 < EXACT else np.int64
    x, c = points.astype(kind), centroids.astype(kind)
    square = np.square(c).sum(axis=1)
    own, near, second = (np.zeros(len(points), t) for t in (np.int32, np.int64, np.float64))
    step = max(1, HELD // len(c))
    for at in range(0, len(points), step):
        part = x[at : at + step]
        far = np.square(part).sum(axis=1)[:, None] - 2 * (part @ c.T) + square
        rows, best = np.arange(len(part)), far.argmin(axis=1)
        own[at : at + step], near[at : at + step] = best, far[rows, best].astype(np.int64)
        if len(c) > 1:
            far[rows, best] = np.iinfo(np.int64).max if kind is np.int64 else np.inf
            second[at : at + step] = far.min(axis=1)
        else:
            second[at : at + step] = np.inf
    return own, near, second


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """For each cluster, by how much a vector within ``radius`` of its old centroid can have come nearer to another one.

    From the middle m of a move p to q, d(x, p) - d(x, q) = 2 |pq| |xm| cos(a) / (d(x, p) + d(x, q)),
    and the denominator is 2 |xm| at least; the smallest angle a of a sphere's points is that of
    its centre less the one under which the radius is seen.
    """
    old, new = old.astype(np.float64), new.astype(np.float64)
    move, middle = new - old, (new + old) / 2
    length = np.sqrt(np.square(move).sum(axis=1))
    out = np.zeros(len(old))
    for i, centre in enumerate(old):
        sight = centre - middle
        away = np.sqrt(np.square(sight).sum(axis=1))
        with np.errstate(divide="ignore", invalid="ignore"):
            turn = np.arccos(np.clip((sight * move).sum(axis=1) / (away * length), -1, 1))
            turn = turn - np.arcsin(np.minimum(radius[i] / away, 1))
        shrunk = np.where(away <= radius[i], length, length * np.cos(np.clip(turn, 0, np.pi / 2)))
        shrunk = np.where(length == 0, 0, shrunk)
        shrunk[i] = 0
        out[i] = shrunk.max(initial=0) * (1 + _ROOM) + _ROOM
    return out


def _state(ids, points: np.ndarray, own, near, lower, scanned) -> pa.RecordBatch:
    offsets = np.arange(0, points.size + 1, points.shape[1], dtype=np.int32)
    q = pa.ListArray.from_arrays(pa.array(offsets), pa.array(points.astype(np.int32).ravel()))
    return pa.record_batch([ids, q, pa.array(own), pa.array(near), pa.array(lower), pa.array(scanned)], names=["id", "q", "cluster", "distance", "lower", "scanned"])


def _first(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = matrix(batch.column("q"))
                own, near, second = scan(points, shared.value)
                yield _state(batch.column("id"), points, own, near, np.sqrt(second) * (1 - _ROOM), np.ones(len(own), bool))

    return run


def _moved(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, loose = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            points = matrix(batch.column("q"))
            own = batch.column("cluster").to_numpy().copy()
            lower = batch.column("lower").to_numpy() - loose[own]
            near = np.square(points - centroids[own]).sum(axis=1)
            unsure = ~(np.sqrt(near) * (1 + _ROOM) < lower)
            if unsure.any():
                own[unsure], near[unsure], second = scan(points[unsure], centroids)
                lower[unsure] = np.sqrt(second) * (1 - _ROOM)
            yield _state(batch.column("id"), points, own, near, lower, unsure)

    return run


@dataclass(frozen=True)
class Clustering:
    """Assigned vectors (id, q, cluster, distance, lower, scanned), the final centroids, vectors and summed distance per cluster."""

    vectors: DataFrame
    centroids: np.ndarray
    sizes: list[int]
    inertia: list[int]


def _sums(state: DataFrame, k: int, dims: int) -> tuple[list[int], list[int], np.ndarray, list[list[int]]]:
    """Count, summed distance, radius and sum vector of each cluster: one row per cluster reaches the driver."""
    total = [F.sum(F.get("q", F.lit(i)).cast("long")).alias(f"s{i}") for i in range(dims)]
    facts = [F.count(F.lit(1)).alias("n"), F.sum("distance").alias("inertia"), F.max("distance").alias("far")]
    sizes, inertia, radius, sums = [0] * k, [0] * k, np.zeros(k), [[0] * dims for _ in range(k)]
    for row in state.groupBy("cluster").agg(*facts, *total).collect():
        i = row["cluster"]
        sizes[i], inertia[i], radius[i] = row["n"], row["inertia"], np.sqrt(row["far"]) * (1 + _ROOM)
        sums[i] = list(row[4:])
    return sizes, inertia, radius, sums


def cluster_vectors(
    vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: str = "2",
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> Clustering | None:
    """``rounds`` of assigning every vector to its nearest centroid and moving the centroids, and a last assignment.

    Vectors with ``dims`` components, none null or non-finite, take part, each component x as
    floor(``scale`` * x). The first centroids are the ``k`` vectors (all, if fewer) with the smallest
    sha256 of "``seed``:id", rows with a null id last, ties by id and vector. Nearest is by squared
    Euclidean distance, ties to the smaller number. A centroid becomes the floor of the mean of its
    vectors, exactly; one without vectors stays. Repeated rows and equal vectors count each,
    other columns are not read, and without vectors there is no clustering (None). Components
    too large for distances of 64 bits are refused.

    The vectors are rewritten once a round with their bounds; ``k`` times ``dims`` numbers reach
    the driver and the tasks.
    """
    spark = vectors.sparkSession
    rows = scaled(vectors, id_col, vector_col, scale).where(F.size("q") == dims)
    high = largest(rows)
    if dims * (2 * high) ** 2 >= DISTANCE_LIMIT or high >= 2**31:
        raise ValueError(f"A component of {high} is too large for distances of 64 bits.")
    order = [F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).asc_nulls_last(), F.col("id"), F.col("q")]
    centroids = np.array([row["q"] for row in rows.orderBy(*order).limit(k).select("q").collect()], np.int64)
    if not len(centroids):
        return None
    state = stored(rows.mapInArrow(_first(spark.sparkContext.broadcast(centroids)), _STATE), "clusters")
    for _ in range(rounds):
        sizes, _, radius, sums = _sums(state, len(centroids), dims)
        moved = np.array([[s // n for s in total] if n else list(c) for n, total, c in zip(sizes, sums, centroids)], np.int64)
        shared = spark.sparkContext.broadcast((moved, loosening(centroids, moved, radius)))
        after = stored(state.drop("distance", "scanned").mapInArrow(_moved(shared), _STATE), "clusters")
        drop_stored(state)
        state, centroids = after, moved
    sizes, inertia, _, _ = _sums(state, len(centroids), 0)
    return Clustering(state, centroids, sizes, inertia)


def clustered(vectors: DataFrame, id_col: str = "vec_id", **options) -> DataFrame:
    """One row per vector of ``cluster_vectors``: its cluster, squared distance, the sums of distances over
    its cluster and over all, and a digest of its centroid (components joined by commas)."""
    spark, kind = vectors.sparkSession, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    found = cluster_vectors(vectors, id_col=id_col, **options)
    if found is None:
        return spark.createDataFrame([], f"`{id_col}` long, cluster int, distance long, {kind.removeprefix('cluster int, ')}")
    digests = [sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in found.centroids]
    facts = [(i, s, sum(found.inertia), d) for i, (s, d) in enumerate(zip(found.inertia, digests))]
    # One row per cluster: bounded by the parameter k.
    joined = found.vectors.join(F.broadcast(spark.createDataFrame(facts, kind)), "cluster")
    return joined.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
