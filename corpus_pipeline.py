"""A training corpus in five stages, each an operator of ``tradewinds.llm`` over all that the one before kept.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet and read again as the
next one's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tradewinds.deploy import ship
from tradewinds.llm import bpe, exact_dedup, jaccard_join, mixing, quality
from tradewinds.llm._shared import delete, tables, written
from tradewinds.llm.queries import RANKS

#: The fit of the first stage and the shuffle of the fourth aren't SQL; the stages are tested by brute force.
ORACLE_SQL = None


def accept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    ship(spark)
    return quality.accepted_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of equal texts."""
    return exact_dedup.kept_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar texts: five-word shingles, similarity 0.8 or more."""
    ship(spark)
    return jaccard_join.kept_documents(docs, n=5, num=4, den=5)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, in the order of the mix."""
    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of each text of the mix."""
    ship(spark)
    return bpe.encode_digests(docs, RANKS)


STAGES = [("quality classifier", accept), ("exact dedup", drop_copies), ("n-gram Jaccard join", drop_near_copies), ("mixing sources", mix), ("byte-level BPE", tokenize)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over ``documents``; what a stage has written but its result goes with it."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), set(tables())
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{k}")
        delete(spark, [t for t in tables()[:-1] if t not in before])
    return docs
