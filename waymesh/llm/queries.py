"""The queries opN_<name>: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from waymesh.llm import chat, langid, packing, quality, secret_scan, simhash, sp_sampling, token_store, toxicity, vector_dedup
from waymesh.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op1_packing(table(spark, sf_dir, "documents"), vocabulary())


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.op2_token_store(table(spark, sf_dir, "documents"), vocabulary())


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.op3_embedding_dedup(table(spark, sf_dir, "embeddings"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return sp_sampling.op4_segmentation_sampling(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op5_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.op6_simhash_dedup(table(spark, sf_dir, "documents"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op7_quality_rules(table(spark, sf_dir, "documents"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.op8_chat_format(table(spark, sf_dir, "conversations"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.op9_language_id(table(spark, sf_dir, "documents"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.op10_secret_scan(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_packing": op1,
        "op2_token_store": op2,
        "op3_embedding_dedup": op3,
        "op4_segmentation_sampling": op4,
        "op5_toxicity": op5,
        "op6_simhash_dedup": op6,
        "op7_quality_rules": op7,
        "op8_chat_format": op8,
        "op9_language_id": op9,
        "op10_secret_scan": op10,
    }


def oracle_sql() -> dict[str, str]:
    return {"op8_chat_format": chat.OP8_SQL}
