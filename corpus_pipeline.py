"""A corpus cleaned and packed in five stages, each written and read again.

Toxic documents go, then those of bad quality, then near copies of others;
secrets are masked; what is left is packed into sequences of token ids. Each
stage takes (spark, docs, sf_dir) and works on all that its predecessor kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logbrook.llm import packing, quality, secret_scan, simhash, toxicity
from logbrook.session import work_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic, by a model learned from these documents and the labels."""
    model = toxicity.learned(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.clean(docs, model)


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, with all their columns. Null and empty texts fail by their word count."""
    return quality.kept(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near copies, one row of it; rows without an id all stay."""
    return simhash.one_of_each(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked and ``n_chars`` brought up to date; a null text stays null."""
    return secret_scan.masked(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its sequence and place there; an empty text is its end id alone."""
    return packing.pack(packing.pieces(docs))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("quality", of_quality),
    ("near_copies", without_near_copies),
    ("secrets", without_secrets),
    ("packing", packed),
]

# Fingerprints, compression and merges are not for SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the folder's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = work_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
