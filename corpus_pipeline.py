"""A training corpus from ``documents`` in five stages, each applying one operator of ``quire.llm``.

1. ``toxicity``: documents predicted toxic go (maximum-scoring segments, learned from ``labels``).
2. ``near_duplicates``: of every group of near-duplicates one document stays, the one with the least id.
3. ``secrets``: every secret in a text is replaced by a marker; no document goes.
4. ``mixing``: documents become the pieces of their source's blocks that the mixture takes, once per round.
5. ``packing``: token sequences of 2048 ids, one row per piece of a document.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows of ``docs``; all but the last return the columns of
``docs``. Between stages rows are written as Parquet and read again. An empty table passes through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quire.llm import mixing, packing, secret_scan, shingle_join, toxicity
from quire.llm.common import read, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean_documents(docs, read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shingle_join.one_per_class(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Model fitting, token ids and path sampling have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
