"""The corpus pipeline: language identification, near-duplicate removal, redaction of secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which run() writes as Parquet and reads again for the
next one. The first three return the columns of documents; the last returns the packed pieces. Texts that are
null or hold no letter go in the first stage, and so do those whose language stays below even odds. Of documents
that five-word shingles link at a Jaccard similarity of 0.8 or more, the one with the least id stays. Secrets are replaced in the
texts, and n_chars follows; documents without secrets pass unchanged. An empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furlong.llm import jaccard_join, language_id, packing, secret_scan
from furlong.llm.common import stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs, language_id.fit(docs), 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs, 5, 80, 100)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = secret_scan.redact(docs, secret_scan.train_on_corpus(docs))
    return out.withColumn("n_chars", F.coalesce(F.char_length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), 2048, 0)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]
#: SQL can express none of the learned stages; tests/llm/test_pipeline.py holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
