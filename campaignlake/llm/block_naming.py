"""Exact deduplication by deterministic block naming.

Every text (A-Z lower-cased) is cut into blocks of ``BLOCK_BYTES``. Equal blocks
get one integer name by sorting; then adjacent pairs of names are named the same
way, level by level, until each document has one name. Names come from sorted
contents, never from a hash, so two documents share ``(levels, name)`` exactly
when their texts are equal.

Scale: a batch of a map task sends a block's content once however many of its rows have it
(others point at the first), so a text that a third of all rows share costs one
row per batch. Contents are shuffled once; all later levels move integers. Pairs
are pre-aggregated before they are named, and only documents of several blocks
take part in the levels above the first.

Defined results: null text is empty text; an empty text is one empty block;
repeated rows are separate rows of one group; of rows with equal text the one
with the largest ``doc_id`` stays (null is smallest, and among rows repeating
that ``doc_id`` one stays); an empty table gives an empty result; only ``doc_id``
and the text column are read, so further columns may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaignlake.llm.common import lower_ascii, materialize, staying_rows, tidy, utf8

BLOCK_BYTES = 16384

_BLOCKS = (
    "rid long, doc_id long, text_sha256 string, n_blocks int, block int,"
    " rep_rid long, rep_block int, content binary"
)
_NAMED = "rep_rid long, rep_block int, name long"


def _cut(size: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rid = TaskContext.get().partitionId() << 33
        for frame in frames:
            first: dict[bytes, tuple[int, int]] = {}
            rows = []
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                data = utf8(text)
                blocks = [data[i : i + size] for i in range(0, len(data), size)] or [b""]
                digest = hashlib.sha256(data).hexdigest()
                key = None if pd.isna(doc_id) else int(doc_id)
                for k, content in enumerate(blocks):
                    owner = first.setdefault(content, (rid, k))
                    sent = content if owner == (rid, k) else None
                    rows.append((rid, key, digest if not k else None, len(blocks), k, *owner, sent))
                rid += 1
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in _BLOCKS.split(", ")])
            yield out.astype({"doc_id": "Int64"})

    return tidy(run)


def _name_sorted(column: str, tasks: int):
    """Names of a sorted partition: the rank of each distinct value, made unique per task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, rank, last = TaskContext.get().partitionId(), -1, None
        for frame in frames:
            names = []
            for value in frame[column]:
                if rank < 0 or value != last:
                    rank, last = rank + 1, value
                names.append(rank * tasks + task)
            yield frame[["rep_rid", "rep_block"]].assign(name=names)

    return tidy(run)


def _name_contents(blocks: DataFrame) -> DataFrame:
    """(rep_rid, rep_block, name) of every block whose content was sent."""
    tasks = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        blocks.where(F.col("content").isNotNull())
        .select("rep_rid", "rep_block", "content")
        .repartition(tasks, "content")
        .sortWithinPartitions("content")
        .mapInPandas(_name_sorted("content", 1 << 24), _NAMED)
    )


def _name_pairs(names: DataFrame) -> DataFrame:
    """One level up: (rid, block, name) of adjacent pairs named by their sorted values."""
    pairs = names.groupBy("rid", F.expr("block div 2").cast("int").alias("block")).agg(
        F.max(F.when(F.col("block") % 2 == 0, F.col("name"))).alias("left_name"),
        F.coalesce(F.max(F.when(F.col("block") % 2 == 1, F.col("name"))), F.lit(-1)).alias(
            "right_name"
        ),
    )
    pairs = materialize(pairs, "block-pairs")
    distinct = pairs.select("left_name", "right_name").distinct()
    tasks = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rank, task = 0, TaskContext.get().partitionId()
        for frame in frames:
            ranks = range(rank, rank + len(frame))
            yield frame.assign(name=[r * (1 << 24) + task for r in ranks])
            rank += len(frame)

    named = (
        distinct.repartition(tasks, "left_name", "right_name")
        .sortWithinPartitions("left_name", "right_name")
        .mapInPandas(tidy(run), "left_name long, right_name long, name long")
    )
    return pairs.join(named, ["left_name", "right_name"]).select("rid", "block", "name")


def document_names(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(rid, doc_id, text_sha256, levels, name) per row of ``docs`` (doc_id, text)."""
    blocks = materialize(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            lower_ascii(F.coalesce("text", F.lit(""))).alias("text"),
        ).mapInPandas(_cut(block_bytes), _BLOCKS),
        "blocks",
    )
    contents = _name_contents(blocks)
    named = materialize(
        blocks.drop("content").join(contents, ["rep_rid", "rep_block"]), "block-names"
    )
    head = named.where("block = 0").select("rid", "doc_id", "text_sha256", "n_blocks", "name")
    result = head.where("n_blocks = 1").withColumn("levels", F.lit(0))
    level, several = 0, named.where("n_blocks > 1").select("rid", "block", "name", "n_blocks")
    most = several.agg(F.max("n_blocks")).first()[0] or 1
    several = several.drop("n_blocks")
    heads = head.where("n_blocks > 1").drop("name")
    while most > 1:
        level, most = level + 1, (most + 1) // 2
        several = _name_pairs(several) if most == 1 else materialize(_name_pairs(several), "level")
        done = heads.where(f"ceil(log2(n_blocks)) = {level}").join(
            several.where("block = 0").select("rid", "name"), "rid"
        )
        result = result.unionByName(done.withColumn("levels", F.lit(level)))
    return result.select("rid", "doc_id", "text_sha256", "levels", "name")


def exact_groups(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256."""
    named = materialize(document_names(docs, block_bytes), "document-names")
    groups = named.groupBy("levels", "name").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.max(F.struct(F.col("doc_id").alias("keep_id"), F.col("rid").alias("keep_rid"))).alias(
            "keep"
        ),
    )
    groups = groups.select("levels", "name", "group_size", "keep.keep_id", "keep.keep_rid")
    return named.join(groups, ["levels", "name"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("rid") == F.col("keep_rid")).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    groups = materialize(exact_groups(docs, block_bytes), "groups")
    digest = F.unhex(F.sha2(lower_ascii(F.coalesce("text", F.lit(""))), 256))
    return staying_rows(docs, groups.withColumn("digest", F.unhex("text_sha256")), digest)
