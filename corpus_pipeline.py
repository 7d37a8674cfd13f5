"""From raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``. Between stages the rows are written as Parquet and read again,
so a lost executor never sends the work back further than the stage it is in.

* language: documents without a language, or long ones that stay ambiguous, go.
* toxicity: documents that score 0.7 or more go.
* near_duplicates: one document of each group of SimHash neighbours stays, the one with the
  least id.
* secrets: credentials give way to a mark; values that many owners share stay.
* packing: sequences of power-of-two lengths.

Null texts and texts without a letter go in the first stage. Repeated rows end as one in
the third. Null ids are kept as ids. Empty tables give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymesh.llm import langid, packing, secret_scan, simhash, toxicity
from waymesh.llm.common import table
from waymesh.plans.durable import written

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs, langid.fit(langid.learned_part(docs)))


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.fit(toxicity.learned_part(docs, table(spark, sf_dir, "labels"))))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, VOCABULARY).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [("language", language), ("toxicity", without_toxic), ("near_duplicates", near_duplicates), ("secrets", secrets), ("packing", packed)]
#: The models of the first stages can't be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
