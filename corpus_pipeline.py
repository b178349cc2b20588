"""A training-data pipeline over ``documents``: each stage is written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lendframe.llm import decontaminate, ngramjoin, pieces, pii, quality
from lendframe.session import cut_lineage


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest id."""
    return ngramjoin.drop_near_copies(docs)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaked(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets."""
    return pii.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and of the text decoded from them."""
    import public_tokenizers

    return pieces.digest_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality", keep_good),
    ("near_copies", drop_near_copies),
    ("benchmark", drop_leaked),
    ("personal_data", redact),
    ("encode", encode),
]

#: Learned models and vectorised coding: SQL can't express these stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
