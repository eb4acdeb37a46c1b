"""The corpus pipeline: stages over `documents`, each one corpus operator.

run() applies the stages one after the other; a runner that writes each stage's rows and reads them
again gets the same result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselog.llm import language_id, mixing, packing, secrets, simhash
from caselog.llm.common import extra_name

TOKENIZER = "word_bpe_49k.json"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a known language go."""
    return language_id.in_known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: that of the smallest id."""
    return simhash.one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to marks; every document stays."""
    return secrets.redact_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as their source's rate asks, in a random order."""
    return mixing.mix_sources(docs, copy=extra_name(docs, "_copy")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as pieces of windows of 2048 ids."""
    pieces = packing.pack(docs, public_tokenizers.path(TOKENIZER))
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("mixing", mix),
    ("packing", pack),
]

#: Profiles, fingerprints, entropy and tokens are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of the folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
