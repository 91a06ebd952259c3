"""Quality classifier: naive Bayes support vectors over byte n-gram indicators.

Spark counts, over all labelled training rows, how many texts of either class hold each
n-gram. The log ratios of the two classes scale the indicators; on them a linear hinge-loss
model is fitted by dual coordinate descent on a bounded sample of the same rows, and a
sigmoid fitted on the part of the sample that the descent did not see turns margins into
scores. Features come from the text alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablepull.llm.hashing import chunks, combine, word_hashes
from tablepull.llm.tables import broadcast_below, filtered, stored

# Labelled rows (the first ones by hash of their id) and feature ids the descent is fitted on, at most.
FIT_ROWS = 12_000
FIT_IDS = 40_000_000
EPOCHS = 12
COST = 1.0
_THREE = 1 << 18
# Shares of words that repeat the word before, and of word 3-grams that repeat an earlier one.
_SHARES = np.array([0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.7])
_REPEATS = _THREE + (1 << 16) + (1 << 8)
DIMENSIONS = _REPEATS + 2 * len(_SHARES)


@dataclass(frozen=True)
class QualityModel:
    """Weight and squared log ratio of each feature, the bias, and the sigmoid's slope and offset."""

    weight: np.ndarray
    square: np.ndarray
    bias: float
    slope: float
    offset: float


def gram_ids(column: pa.Array) -> Iterator[np.ndarray]:
    """For each text the distinct ids of its byte 1-, 2- and 3-grams (3-grams hashed) and of its word repetitions."""
    last = np.zeros(DIMENSIONS, np.int64)
    for _, _, data, offsets in chunks(column):
        one = data.astype(np.int64)
        two = (one[:-1] << 8) | one[1:]
        three = ((two[:-1] << 8) | one[2:]) * 0x9E3779B1 >> 7 & (_THREE - 1)
        two += _THREE
        one += _THREE + (1 << 16)
        words, rows = word_hashes(data, offsets)
        for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            ids = np.concatenate([one[a:b], two[a : max(a, b - 1)], three[a : max(a, b - 2)], _repeats(words[rows[row] : rows[row + 1]])])
            at = np.arange(len(ids))
            last[ids] = at
            yield ids[last[ids] == at]


def _repeats(words: np.ndarray) -> np.ndarray:
    """Ids of the shares that a text's repetitions exceed."""
    if len(words) < 4:
        return np.zeros(0, np.int64)
    before = (words[1:] == words[:-1]).mean()
    runs = combine(words, 3)
    earlier = 1 - len(np.unique(runs)) / len(runs)
    return _REPEATS + np.concatenate([np.flatnonzero(_SHARES < before), len(_SHARES) + np.flatnonzero(_SHARES < earlier)])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, DIMENSIONS), np.int64)
    rows = [0, 0]
    for batch in batches:
        for label, ids in zip(batch.column("label").to_pylist(), gram_ids(batch.column("text"))):
            counts[label][ids] += 1
            rows[label] += 1
    kept = np.flatnonzero(counts.sum(axis=0))
    # The number of texts of each class is counted as one more feature.
    yield pa.record_batch(
        [pa.array(np.append(kept, DIMENSIONS).astype(np.int32)), pa.array(np.append(counts[0][kept], rows[0])), pa.array(np.append(counts[1][kept], rows[1]))],
        names=["feature", "low", "high"],
    )


def _descend(rows: list[np.ndarray], signs: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for ``min |w|^2 / 2 + COST * sum(max(0, 1 - y w.x))``, rows of length one and a bias."""
    weight, bias = np.zeros(DIMENSIONS), 0.0
    values = [_unit(ids, ratio) for ids in rows]
    alpha, order = np.zeros(len(rows)), np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            ids, x, y = rows[i], values[i], signs[i]
            gradient = y * (weight[ids] @ x + bias) - 1.0
            new = min(max(alpha[i] - gradient / (x @ x + 1.0), 0.0), COST)
            step, alpha[i] = (new - alpha[i]) * y, new
            if step:
                weight[ids] += step * x
                bias += step
    return weight, bias


def _unit(ids: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    x = ratio[ids]
    length = np.sqrt(x @ x)
    return x / length if length > 0 else x


def _sigmoid(margins: np.ndarray, signs: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the likeliest sigmoid, labels smoothed by their counts, by Newton steps."""
    up = (signs > 0).sum()
    target = np.where(signs > 0, (up + 1) / (up + 2), 1 / (len(signs) - up + 2))
    point, x = np.array([1.0, 0.0]), np.stack([margins, np.ones(len(margins))], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ point, -30, 30)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(curve, x.T @ (p - target) + 1e-6 * (point - [1.0, 0.0]))
        point = point - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(point[0], 1e-3)), float(point[1])


def _fit(ratio: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels, total = [], [], 0
        for batch in batches:
            for label, ids in zip(batch.column("label").to_pylist(), gram_ids(batch.column("text"))):
                if total + len(ids) <= FIT_IDS:
                    rows.append(ids.astype(np.int32))
                    labels.append(label)
                    total += len(ids)
        signs = np.where(np.array(labels, dtype=np.int64) > 0, 1.0, -1.0)
        held = np.arange(len(rows)) % 4 == 3
        weight, bias = _descend([x for x, h in zip(rows, held) if not h], signs[~held], ratio)
        margins = np.array([weight[ids] @ _unit(ids, ratio) + bias for ids, h in zip(rows, held) if h])
        slope, offset = _sigmoid(margins, signs[held]) if len(margins) else (1.0, 0.0)
        yield pa.record_batch(
            [pa.array([weight.tobytes()], pa.binary()), pa.array([bias]), pa.array([slope]), pa.array([offset])], names=["weight", "bias", "slope", "offset"]
        )

    return run


def held_out(id_column: Column) -> Column:
    """Rows never learned from: the crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> QualityModel:
    """Fits the model on the labelled rows of ``docs`` that are not held out.

    Rows of ``labels`` with a null id or label, and ids with contradicting labels, are left
    out; repeated rows of ``docs`` each count. Without rows of both classes the log ratios
    are 0 and every text gets the same score. Null texts count as empty.
    """
    marks = labels.select(F.col(id_col).alias("id"), (F.col(label_col) > 0).cast("int").alias("label")).dropna()
    marks = marks.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other").drop("other")
    marks = stored(marks.where(~held_out(F.col("id"))), "labels")
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = known.join(broadcast_below(marks, marks.count(), 32), "id").withColumn("h", F.xxhash64("id"))
    counts = known.select("label", "text").mapInArrow(_count, "feature int, low long, high long")
    counts = counts.groupBy("feature").agg(F.sum("low").alias("low"), F.sum("high").alias("high")).toPandas()
    low, high = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)
    low[counts["feature"]], high[counts["feature"]] = counts["low"], counts["high"]
    ratio = np.zeros(DIMENSIONS)
    if low[-1] and high[-1]:
        # Smoothed shares of the texts of either class that hold a feature.
        ratio = np.log((high[:-1] + 1) / (high[-1] + 2)) - np.log((low[:-1] + 1) / (low[-1] + 2))
    first = marks.select(F.xxhash64("id").alias("h")).orderBy("h").limit(FIT_ROWS).agg(F.max("h")).first()[0]
    sample = known.where(F.col("h") <= F.lit(first)) if first is not None else known.limit(0)
    sample = sample.select("h", "label", "text").repartition(1).sortWithinPartitions("h", "text").drop("h")
    fitted = sample.mapInArrow(_fit(ratio), "weight binary, bias double, slope double, offset double").first()
    weight = np.frombuffer(fitted["weight"]) if fitted else np.zeros(DIMENSIONS)
    bias, slope, offset = fitted[1:] if fitted else (0.0, 1.0, 0.0)
    return QualityModel((weight * ratio).astype(np.float32), np.square(ratio).astype(np.float32), bias, slope, offset)


def _scored(column: pa.Array, m: QualityModel) -> np.ndarray:
    margins = []
    for ids in gram_ids(column):
        length = float(m.square[ids].sum(dtype=np.float64)) ** 0.5
        margins.append(float(m.weight[ids].sum(dtype=np.float64)) / length + m.bias if length > 0 else m.bias)
    return 1 / (1 + np.exp(-np.clip(m.slope * np.array(margins, dtype=np.float64) + m.offset, -500, 500)))


def _scores(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = QualityModel(**shared.value)
        for batch in batches:
            score = pa.array(_scored(batch.column(batch.num_columns - 1), m), pa.float64())
            yield pa.record_batch([*batch.columns[:-1], score], names=[*batch.schema.names[:-1], "score"])

    return run


def score_quality(docs: DataFrame, model: QualityModel, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of every row and its score (0 to 1), repeated rows included; null texts count as empty."""
    keep = keep or ["doc_id"]
    rows = docs.select(*keep, F.col(text_col).alias("score_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(_scores(docs.sparkSession.sparkContext.broadcast(vars(model))), f"{fields}, score double")


def keep_quality(docs: DataFrame, model: QualityModel, bar: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose score is at least ``bar``."""
    at, shared = docs.columns.index(text_col), docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = QualityModel(**shared.value)
        for batch in batches:
            yield batch.filter(pa.array(_scored(batch.column(at), m) >= bar, pa.bool_()))

    return filtered(docs, run)
