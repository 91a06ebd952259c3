"""Hard negatives: rows of other labels whose score lies in a window below that of a positive.

All vectors are packed into an R-tree whose upper part is dealt by Spark: quantiles of the widest
coordinate cut the table into slabs, quantiles of the next one each slab into tiles. The boxes of the tiles
(at most ``DIRECTORY_BYTES``) are known to all tasks. Every anchor ranks the tiles by the highest
score they can hold and visits them in waves of 1, 4, 16, ... tiles; after each wave the last place of its
lists leaves out what lies strictly below. A visit meets a block of anchors with a part of a
tile in one task, which packs the part and searches it best first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablepull.functions.names import qcol
from tablepull.llm import rtree
from tablepull.llm.tables import drop_stored, stored
from tablepull.llm.vectors import largest, matrix, scaled
from tablepull.operators.keys import first_per_key

# Rows of a part of a tile, and anchors of a block: what meets in one task.
PART_ROWS = 8192
BLOCK_ROWS = 2048
# The boxes of all tiles take so many bytes at most; beyond, tiles have more parts.
DIRECTORY_BYTES = 16 * 1024 * 1024
WAVE = 4
# Whole numbers up to this are exact in double precision; a hundredfold score must fit 64 bits.
EXACT, SCORE_LIMIT = 2**52, 2**63 // 100
NEVER, ALWAYS = -(2**62), 2**62
_FOUND = "id long, window int, other long, score long"
_PROBE = "id long, label long, q array<long>, lows array<long>, highs array<long>, floors array<long>"


class _Cuts:
    """Which tile a vector belongs to: a slab by one coordinate, a tile of the slab by another."""

    def __init__(self, rows: DataFrame, count: int, tiles: int, dims: int):
        spread = rows.agg(*[F.var_pop(F.get("q", F.lit(i))).alias(f"c{i}") for i in range(dims)]).first()
        self.first, self.second = (np.argsort([-(s or 0.0) for s in spread], kind="stable")[[0, min(1, dims - 1)]]).tolist()
        slabs = int(np.ceil(np.sqrt(tiles)))
        self.per_slab = -(-tiles // slabs)
        share = [i / slabs for i in range(1, slabs)]
        cut = lambda axis, shares: F.percentile_approx(F.get("q", F.lit(axis)), shares, 10_000)
        self.slabs = np.array(rows.agg(cut(self.first, share)).first()[0] if share else [], np.int64)
        share = [i / self.per_slab for i in range(1, self.per_slab)]
        self.tiles = {i: np.zeros(0, np.int64) for i in range(slabs)}
        if share:
            slab = F.lit(0)
            for border in self.slabs.tolist():
                slab = slab + (F.get("q", F.lit(self.first)) >= border).cast("int")
            for row in rows.groupBy(slab.alias("slab")).agg(cut(self.second, share).alias("cuts")).collect():
                self.tiles[row["slab"]] = np.array(row["cuts"], np.int64)

    def of(self, points: np.ndarray) -> np.ndarray:
        slab = np.searchsorted(self.slabs, points[:, self.first], "right")
        tile = slab * self.per_slab
        for i in np.unique(slab).tolist():
            rows = slab == i
            tile[rows] += np.searchsorted(self.tiles[i], points[rows, self.second], "right")
        return tile.astype(np.int32)


def _tiles(cuts: _Cuts) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                tile = cuts.of(matrix(batch.column("q")))
                yield pa.record_batch([batch.column("id"), batch.column("label"), batch.column("q"), pa.array(tile)], names=["id", "label", "q", "tile"])

    return run


def _boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The box of each tile among the rows of a task, as one row of low and high per tile."""
    lows: dict[int, np.ndarray] = {}
    highs: dict[int, np.ndarray] = {}
    rows: dict[int, int] = {}
    for batch in batches:
        if batch.num_rows:
            points, tile = matrix(batch.column("q")), batch.column("tile").to_numpy()
            for i in np.unique(tile).tolist():
                mine = points[tile == i]
                low, high = mine.min(axis=0), mine.max(axis=0)
                lows[i] = np.minimum(lows.get(i, low), low)
                highs[i] = np.maximum(highs.get(i, high), high)
                rows[i] = rows.get(i, 0) + len(mine)
    for i in lows:
        yield pa.record_batch([pa.array([i], pa.int32()), pa.array([rows[i]]), pa.array([lows[i].tolist()]), pa.array([highs[i].tolist()])], names=["tile", "rows", "low", "high"])


def _open_windows(column: pa.Array) -> list[np.ndarray]:
    return [np.array(values, np.int64) for values in column.to_pylist()]


def _routes(shared, start: int, stop: int, kind: type) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each probe the tiles of places ``start`` to ``stop`` in its own order that can still matter to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles, low, high = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                upper, lower = rtree.bounds(matrix(part.column("q")).astype(kind), low.astype(kind), high.astype(kind))
                rows, found = [], []
                windows = zip(*(_open_windows(part.column(name)) for name in ("lows", "highs", "floors")))
                for row, (lows, highs, floors) in enumerate(windows):
                    order = np.argsort(-np.minimum(upper[row], highs.max()), kind="stable")[start:stop]
                    least = np.maximum(lows, floors)
                    fits = (upper[row][order, None] >= least) & (lower[row][order, None] <= highs)
                    order = order[fits.any(axis=1)]
                    rows.append(np.full(len(order), row))
                    found.append(tiles[order])
                if rows:
                    take = pa.array(np.concatenate(rows))
                    yield pa.record_batch([pa.array(np.concatenate(found).astype(np.int32))] + [part.column(i).take(take) for i in range(part.num_columns)], names=["tile", *part.schema.names])

    return run


def _visit(kind: type, top: int, same_label: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Searches a part of a tile for a block of probes."""

    def run(members: pa.Table, probes: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int]] = []
        if members.num_rows and probes.num_rows:
            tree = rtree.Tree(matrix(members["q"]), members["id"].to_numpy(), members["label"].to_numpy(), kind)
            queries = matrix(probes["q"]).astype(kind)
            upper, lower = rtree.bounds(queries, tree.low, tree.high)
            ids, labels = probes["id"].to_pylist(), probes["label"].to_pylist()
            limits = zip(*(probes[name].to_pylist() for name in ("lows", "highs", "floors")))
            for i, (lows, highs, floors) in enumerate(limits):
                windows = [rtree.Window(low, high, top, floor, same_label, []) for low, high, floor in zip(lows, highs, floors)]
                tree.search(queries[i], labels[i], ids[i], upper[i], lower[i], windows)
                out += [(ids[i], w, other, score) for w, window in enumerate(windows) for score, other in window.found]
        columns = list(zip(*out)) if out else [(), (), (), ()]
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64())], names=["id", "window", "other", "score"])

    return run


class _Index:
    """The tiles of the members and what is needed to search them."""

    def __init__(self, members: DataFrame, dims: int, kind: type, part_rows: int, block_rows: int):
        spark, count = members.sparkSession, members.count()
        tiles = max(1, min(-(-count // part_rows), DIRECTORY_BYTES // (16 * dims)))
        cuts = _Cuts(members, count, tiles, dims)
        self.members = stored(members.mapInArrow(_tiles(cuts), "id long, label long, q array<long>, tile int"), "tiles")
        boxes = self.members.select("q", "tile").mapInArrow(_boxes, "tile int, rows long, low array<long>, high array<long>")
        # The boxes meet per tile on the executors; one row per tile reaches the driver.
        sides = [f"transform(sequence(0, {dims - 1}), i -> {f}(transform(collect_list({side}), b -> b[i]))) AS {side}" for f, side in (("array_min", "low"), ("array_max", "high"))]
        found = boxes.groupBy("tile").agg(F.sum("rows").alias("rows"), *map(F.expr, sides)).orderBy("tile").collect()
        self.parts = [(row["tile"], -(-row["rows"] // part_rows)) for row in found]
        table = np.array([r["tile"] for r in found]), np.array([r["low"] for r in found]), np.array([r["high"] for r in found])
        self.shared, self.tiles = spark.sparkContext.broadcast(table), len(found)
        self.kind, self.block_rows = kind, block_rows

    def search(self, probes: DataFrame, top: int, same_label: bool) -> DataFrame:
        """The ``top`` best (id, window, other, score) of each window of each probe (``_PROBE``, without floors)."""
        probes = stored(probes, "probes")
        blocks = max(1, -(-probes.count() // self.block_rows))
        groups = min(10_000, blocks * sum(parts for _, parts in self.parts))
        # One row per tile: bounded by DIRECTORY_BYTES.
        parts = F.broadcast(probes.sparkSession.createDataFrame(self.parts, "tile int, parts int"))
        members = self.members.join(parts, "tile").withColumn("part", F.expr("int(pmod(xxhash64(id), parts))")).drop("parts")
        keys = ["tile", "part", "block"]
        best = None
        start, stop = 0, 1
        while start < self.tiles:
            floors = F.transform("lows", lambda _: F.lit(NEVER).cast("long"))
            with_floors = probes.withColumn("floors", floors)
            if best is not None:
                last = best.groupBy("id", "window").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("floor")).where(F.col("n") >= top)
                known = last.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("window", "floor"))).alias("known"))
                floors = F.transform("lows", lambda _, w: F.coalesce(F.try_element_at("known", w), F.lit(NEVER)))
                with_floors = probes.join(known, "id", "left").withColumn("floors", floors).drop("known")
            names = [c.split()[0] for c in _PROBE.split(", ")]
            routed = with_floors.select(*names).mapInArrow(_routes(self.shared, start, stop, self.kind), f"tile int, {_PROBE}")
            routed = routed.join(parts, "tile").withColumn("part", F.explode(F.expr("sequence(0, parts - 1)"))).drop("parts")
            routed = stored(routed.withColumn("block", F.expr(f"int(pmod(xxhash64(id), {blocks}))")), "routes")
            wanted = members.join(routed.select("tile", "part", F.col("block").alias("of")).distinct(), ["tile", "part"]).withColumnRenamed("of", "block")
            met = wanted.repartition(groups, *keys).groupBy(*keys).cogroup(routed.repartition(groups, *keys).groupBy(*keys))
            met = met.applyInArrow(_visit(self.kind, top, same_label), _FOUND)
            both = met if best is None else best.unionByName(met)
            place = F.row_number().over(Window.partitionBy("id", "window").orderBy(F.desc("score"), "other"))
            after = stored(both.withColumn("place", place).where(F.col("place") <= top).drop("place"), "found")
            drop_stored(routed, *([] if best is None else [best]))
            best, start, stop = after, stop, stop + (stop - start) * WAVE
        drop_stored(probes)
        return best


def hard_negatives(
    vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256,
    id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
    part_rows: int = PART_ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for every anchor, each of its
    first ``positives`` rows of the same label, and for each of these the first ``negatives`` rows of other labels whose
    score is ``low`` to ``high`` percent of the positive's.

    Anchors are the rows whose id is divisible by ``every``. Each component x counts as floor(``scale`` * x),
    and a score is the inner product with the anchor, in whole numbers; higher ones come first, ties by smaller id.
    Rows with a null id or label, or a vector that is null, empty, of another length than most, or holds a null or
    non-finite component, take no part. Rows that share an id count once, by the smallest label and then the smallest
    vector. Fewer rows are returned where there are fewer; an empty table gives none; other columns are not
    read. Components too large for scores of 64 bits are refused.
    """
    spark, label = vectors.sparkSession, qcol(label_col).cast("long").alias("label")
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = scaled(vectors, id_col, vector_col, scale, label).where("id is not null and label is not null")
    sizes = rows.groupBy(F.size("q").alias("n")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), F.desc("n")).first()
    if sizes is None:
        return spark.createDataFrame([], result)
    dims = sizes["n"]
    rows = stored(first_per_key(rows.where(F.size("q") == dims), ["id"], [F.col("label"), F.col("q")]), "vectors")
    most = dims * largest(rows) ** 2
    if most >= SCORE_LIMIT:
        raise ValueError(f"Scores of up to {most} are too large for 64 bits.")
    # Rows of one vector and label have one score: only the smallest ids can be among the first, the anchor's own beside.
    copy = F.row_number().over(Window.partitionBy("label", "q").orderBy("id"))
    members = stored(rows.withColumn("copy", copy).where(F.col("copy") <= max(positives + 1, negatives)).drop("copy"), "members")
    index = _Index(members, dims, np.float64 if most < EXACT else np.int64, part_rows, block_rows)
    drop_stored(members)
    anchors = rows.where(F.col("id") % every == 0)
    open_ = [F.array(F.lit(v).cast("long")).alias(name) for v, name in ((NEVER, "lows"), (ALWAYS, "highs"))]
    found = index.search(anchors.select("id", "label", "q", *open_), positives, True)
    pairs = found.select(F.col("id"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score"))
    # A positive's window needs 100 * negative between low and high times its score.
    pairs = pairs.withColumn("lowest", F.expr(f"ceil(({low} * cast(positive_score as decimal(25, 0))) / 100)").cast("long"))
    pairs = stored(pairs.withColumn("highest", F.expr(f"floor(({high} * cast(positive_score as decimal(25, 0))) / 100)").cast("long")), "pairs")
    drop_stored(found)
    per = F.array_sort(F.collect_list(F.struct("positive_id", "lowest", "highest")))
    windows = pairs.groupBy("id").agg(per.alias("windows")).select("id", F.col("windows.lowest").alias("lows"), F.col("windows.highest").alias("highs"), F.col("windows.positive_id").alias("of"))
    asked = anchors.join(windows, "id").select("id", "label", "q", "lows", "highs")
    mined = index.search(asked, negatives, False)
    if mined is None:
        return spark.createDataFrame([], result)
    place = F.row_number().over(Window.partitionBy("id", "window").orderBy(F.desc("score"), "other"))
    owner = windows.select("id", F.posexplode("of").alias("window", "positive_id")).join(pairs.drop("lowest", "highest"), ["id", "positive_id"])
    out = mined.withColumn("rank", place).join(owner, ["id", "window"])
    return out.select(F.col("id").alias("anchor_id"), "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
