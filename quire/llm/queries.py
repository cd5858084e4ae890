"""The queries of this subpackage: each applies one operator, with production parameters, to a whole given table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import attention_quality, conversation_repair, mixing, packing, quality_rules, repeated_passages, secret_scan, sharding, shingle_join, token_alignment, token_counts, toxicity, winnowing
from quire.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = read(spark, sf_dir, "labels").where(F.col("quality") == 1)
    return quality_rules.quality_rules(read(spark, sf_dir, "documents"), trusted)


@query
def op2_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.near_duplicates(read(spark, sf_dir, "documents")).drop("text_hash", "class_hash")


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).drop("ids")


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_scan(read(spark, sf_dir, "documents"))


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_quality.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read(spark, sf_dir, "documents"))


@query
def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edited_fingerprints(read(spark, sf_dir, "documents"))


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(read(spark, sf_dir, "documents"))


@query
def op11_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages.without_repeats(read(spark, sf_dir, "documents")).drop("spans", "kept_text")


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return token_alignment.alignment_digests(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_digests(read(spark, sf_dir, "conversations"))
