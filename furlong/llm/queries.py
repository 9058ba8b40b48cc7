"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe_codec, chat_format, embedding_dedup, fill_middle, jaccard_join, language_id, license_scan, media, packing, piece_codec, secret_scan, source_divergence, token_count

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document by rules and Markov models, as counts and spans."""
    docs = table(spark, sf_dir, "documents")
    return secret_scan.digest(secret_scan.scan(docs, secret_scan.train_on_corpus(docs)))


@query
def op4_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the byte-level tokenizer, and whether a context of 1,024 tokens is exceeded."""
    return token_count.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 1024)


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2,048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048, 0)


@query
def op10_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text they decode to."""
    return bpe_codec.code(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from two thirds of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit(docs.where(~language_id.is_held_out("doc_id"))))


@query
def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored as a media member of an archive directory, read back and described."""
    return media.text_media(table(spark, sf_dir, "documents"))


@query
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one made of control strings, formatted into windows and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-1, 0, "user", chat_format.PROBE), (-1, 1, "assistant", chat_format.PROBE)], turns.schema)
    return chat_format.digest(chat_format.windows(turns.unionByName(probe)))


ORACLE_SQL["op6_chat_format"] = chat_format.SQL


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence of every document: its own by cosine to templates, else that of the nearest directory."""
    return license_scan.scan(license_scan.document_paths(table(spark, sf_dir, "documents")))


ORACLE_SQL["op8_license_scan"] = license_scan.sql()


@query
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The groups of documents whose four-word shingles overlap by 0.85 or more."""
    return jaccard_join.groups(table(spark, sf_dir, "documents"), 4, 85, 100)


@query
def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors whose cosine is 0.9 or more: how many each links with, and its component."""
    return embedding_dedup.neighbours(table(spark, sf_dir, "embeddings"), 0.9)


@query
def op11_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's SentencePiece ids and of the text they decode to."""
    return piece_codec.code(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut into prefix, middle and suffix, rearranged, and rebuilt."""
    return fill_middle.digest(fill_middle.transform(table(spark, sf_dir, "documents")))


ORACLE_SQL["op12_fill_middle"] = fill_middle.SQL


@query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language lie apart, and the terms that set them apart."""
    return source_divergence.audit(table(spark, sf_dir, "documents"))


ORACLE_SQL["op13_source_divergence"] = source_divergence.SQL
