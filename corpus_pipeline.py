"""A training corpus from raw documents: STAGES, each written as Parquet and read again by the next.

run(spark, sf_dir) filters by quality and language, keeps one document of each
group of near-duplicates, mixes the sources along the curriculum and encodes
what is left. All stages but the last return the columns of `documents`; the
last has a row per document of the mix, in training order within each file:
doc_id, n_tokens, ids_sha256, decoded_sha256 and the token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, langid, mixing, quality, simhash
from tidemark.llm.common import prepare
from tidemark.session import write_and_reread

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SHINGLE, DISTANCE = 3, 2


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the plain limits and are no outliers of their language and source."""
    prepare(spark)
    return quality.keep_good(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    prepare(spark)
    return langid.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document, by doc_id, of each group of near-duplicates."""
    prepare(spark)
    return simhash.keep_first(docs, SHINGLE, DISTANCE)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per copy that the curriculum takes, in training order."""
    prepare(spark)
    return mixing.training_order(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, with their count and checksums of ids and decoded text."""
    prepare(spark)
    return bpe.digests(docs, VOCABULARY, with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("language identification", language),
    ("near-duplicates", near_duplicates),
    ("mix to target weights", mix),
    ("encoding", encode),
]

# Robust covariance, naive Bayes and SimHash components are not for SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_and_reread(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
