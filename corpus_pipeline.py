"""The corpus pipeline: documents through five stages to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's `docs`. All but the last return the
columns of `documents`; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidepanel.llm import decontaminate, exact_dedup, near_copies, packing, quality
from tidepanel.llm.common import let_workers_import, materialize, read_table
from tidepanel.llm.queries import vocabulary


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return quality.drop_rejected(docs, quality.train(docs, read_table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies."""
    let_workers_import(spark)
    return near_copies.keep_one_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their sequence and offset."""
    let_workers_import(spark)
    return packing.pack(docs, vocabulary())


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_benchmark_leaks),
    ("pack", pack_sequences),
]

# trees, sketches, edit distance and tokens are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
