"""From raw documents to packed training sequences.

Each stage takes what its predecessor kept, as rows of ``documents``, and is
written as Parquet before the next one reads it. The last stage returns the
pieces of the packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gableframe.llm import decontaminate, packing, quality, simhash
from gableframe.llm.catalog import tokenizer_file
from gableframe.sources.workspace import materialize


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay whose posterior probability of being good is at least one half."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest id: groups
    are connected by fingerprints of three-word shingles at most two bits apart."""
    return simhash.keep_one(docs, size=3, radius=2)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay that hold no window of a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens."""
    return packing.pack(packing.pieces(docs, tokenizer_file()))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("good_quality", good_quality),
    ("near_duplicates", near_duplicates),
    ("benchmark_free", benchmark_free),
    ("best_fit_packing", pack),
]

#: Fingerprints and packing are beyond SQL; a test runs brute force beside it.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
