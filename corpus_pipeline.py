"""A training-corpus pipeline: toxic documents go, near-duplicates merge, personal data is masked, sources are mixed, tokens come out.

Each stage takes all that the one before it kept, written as Parquet and read again. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from starproof.llm import bpe, jaccard, mixing, pii, toxicity
from starproof.llm.queries import table
from starproof.llm.scratch import stored

VOCABULARY = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5; the score is learned from the labels outside the held-out fold."""
    return toxicity.not_toxic(docs, table(spark, sf_dir, "labels"))


def merge_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more."""
    return jaccard.keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with confirmed personal data replaced by tags."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that each source's words come near its target."""
    return mixing.mixed(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text, one row per row of the mix."""
    return bpe.digests(bpe.encode(docs, public_tokenizers.path(VOCABULARY)))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", merge_near_duplicates),
    ("personal_data", mask_personal_data),
    ("source_mix", mix_sources),
    ("bpe", encode_texts),
]

#: SQL cannot learn the toxicity model nor apply the vocabulary; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
