"""Corpus preparation: documents in, packed training sequences out.

Language identification, exact dedup, near-dedup, benchmark decontamination and
packing. Every stage works on all that the one before kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campaignlake.llm import (
    backoff_langid,
    block_naming,
    probminhash,
    vector_packing,
    winnowing,
)
from campaignlake.llm.common import materialize, ship, table, without_rows


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told go: no letter, or no word that the model recognises."""
    ship(spark)
    found = backoff_langid.identify(docs, backoff_langid.fit(docs))
    known = (F.col("lang_pred") != backoff_langid.UNKNOWN) & F.col("recognised")
    return without_rows(docs, found.where(~known))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    ship(spark)
    return block_naming.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    ship(spark)
    return probminhash.drop_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    return winnowing.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids, a row per piece."""
    ship(spark)
    return vector_packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", keep_known_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: SQL can't express the learned and randomised stages; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
