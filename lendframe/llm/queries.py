"""Registered queries of this subpackage, their parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lendframe.llm import decontaminate, divergence, htmltext, langid, neighbours, ngramjoin, pieces, pii, quality, substrings, tokenfile, urlfilter, vectorcodes

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge_pages(_table(spark, sf_dir, "pages"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.join_documents(_table(spark, sf_dir, "documents"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest_documents(_table(spark, sf_dir, "documents"), _vocabulary("piece_bpe_32k.model"))


def op5_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(_table(spark, sf_dir, "pages"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.link_vectors(_table(spark, sf_dir, "embeddings"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(_table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.store_and_verify(_table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.compress(_table(spark, sf_dir, "embeddings"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest_documents(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_url_filters,
        op3_ngram_join,
        op4_sentencepiece,
        op5_page_text,
        op6_quality,
        op7_decontamination,
        op8_near_vectors,
        op9_personal_data,
        op10_token_files,
        op11_source_divergence,
        op12_vector_codes,
        op13_substring_dedup,
    )
}
ORACLES: dict[str, str] = {
    "op2_url_filters": urlfilter.ORACLE_URLS,
    "op11_source_divergence": divergence.ORACLE,
    "op12_vector_codes": vectorcodes.oracle(),
    "op13_substring_dedup": substrings.ORACLE,
}
