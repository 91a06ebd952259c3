"""From documents to packed sequences: five stages, each written as Parquet and reread by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepull.llm.decontaminate import drop_contaminated
from tablepull.llm.lines import dedup_lines
from tablepull.llm.minhash import drop_near_duplicates
from tablepull.llm.packing import pack_documents
from tablepull.llm.quality import keep_quality, train_quality
from tablepull.llm.queries import QUALITY_BAR
from tablepull.llm.tables import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose score is below the bar; learns from the labelled ones that are not held out."""
    return keep_quality(docs, train_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), QUALITY_BAR)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts lines that repeat an earlier one, or nearly so. All documents stay; ``n_chars`` follows the text."""
    out = dedup_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, that of the smallest id."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold an item of the benchmark."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes: (doc_id, piece, start, n_tokens, bin_id, bin_offset)."""
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("minhash_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

# The stages are a trained model, a graph's components and a greedy search: none is SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
