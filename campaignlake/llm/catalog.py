"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campaignlake.llm import (
    backoff_langid,
    block_naming,
    chat_prefix,
    collocations,
    fim_boundaries,
    mincut_html,
    pii_boosting,
    probminhash,
    splitters,
    token_files,
    toxicity,
    vector_packing,
    winnowing,
)
from campaignlake.llm.common import table
from campaignlake.llm.oracle import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]


def op1_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return winnowing.contamination(docs, items)


def op5_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_naming.exact_groups(table(spark, sf_dir, "documents"))


def op2_backoff_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return backoff_langid.identify(docs, backoff_langid.fit(docs))


def op3_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = vector_packing.pack_documents(table(spark, sf_dir, "documents"), path)
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op6_chat_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)],
        "conv_id long, turn long, role string, text string",
    )
    return chat_prefix.read_back(chat_prefix.expand(turns.unionByName(added)))


def op7_levenshtein_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.score_toxicity(docs, toxicity.fit(docs, labels))


def op8_mincut_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mincut_html.extract_main_text(table(spark, sf_dir, "pages"))


def op9_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitters.shard_by_size(table(spark, sf_dir, "documents"))


def op10_range_coder(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_files.round_trip(table(spark, sf_dir, "documents"), path)


def op11_roaring_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fim_boundaries.fill_in_middle(table(spark, sf_dir, "documents"))
    text = fim_boundaries.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(text, 256).alias("restored_sha256"),
    )


def op12_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_boosting.personal_data(table(spark, sf_dir, "documents"))
    counts = [pii_boosting.count_of(kind).alias(f"n_{kind}") for kind in pii_boosting.KINDS]
    return found.select("doc_id", *counts, F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op13_misra_gries_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_winnowing,
        op2_backoff_langid,
        op3_probminhash,
        op4_vector_packing,
        op5_block_naming,
        op6_chat_prefix,
        op7_levenshtein_toxicity,
        op8_mincut_html,
        op9_sampled_splitters,
        op10_range_coder,
        op11_roaring_fim,
        op12_boosted_pii,
        op13_misra_gries_phrases,
    )
}
