"""Binary token files: whole texts as ids in ascending doc_id order, and back.

A file table is Parquet with one container per row: ``shard`` and ``part`` order
the containers, ``payload`` is the container. Container layout (little-endian):

    magic "TKR1", vocabulary u32, documents u32, blocks u32
    doc_id i64 and its presence u8, documents times each
    ids of each document (with the end id) u64, documents times
    per block: ids u32, crc32 of the ids u32, code bytes u32
    the codes of the blocks, as ``range_coder`` makes them

Scale: texts are range-partitioned by doc_id and sorted inside a partition; each
task streams over its documents and closes a container once it has
``CONTAINER_IDS`` ids, so memory is bounded by that and by the longest document.
Containers are read back one by one, without a shuffle. Positions over all files
need one number per shard: the sums of a table as long as there are shards.

Defined results: null and empty texts have the end id alone; rows with equal
doc_ids follow one another in an order of their texts; rows with null doc_id come
first; an empty table gives empty files.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from campaignlake.llm import range_coder
from campaignlake.llm.common import scratch_path, slices
from campaignlake.llm.tokenizing import Encoder

CONTAINER_IDS = range_coder.LANES * range_coder.BLOCK_IDS
_MAGIC = b"TKR1"
_SLICE_CHARS = 2_000_000
_FILE = "shard int, part int, n_ids long, payload binary"
_READ = "shard int, doc_id long, in_shard long, n_tokens long, ids_crc32 long"


def pack_container(doc_ids: list[int | None], parts: list[bytes], vocabulary: int) -> bytes:
    ids = np.frombuffer(b"".join(parts), "<u4")
    blocks = range_coder.encode_blocks(ids, vocabulary)
    return b"".join(
        [
            _MAGIC,
            struct.pack("<III", vocabulary, len(parts), len(blocks)),
            np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
            np.array([d is not None for d in doc_ids], "u1").tobytes(),
            np.array([len(p) // 4 for p in parts], "<u8").tobytes(),
            np.array([(n, crc, len(code)) for n, crc, code in blocks], "<u4").tobytes(),
            *(code for _, _, code in blocks),
        ]
    )


def unpack_container(payload: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc_ids, ids of each document, all ids) of a container."""
    if payload[:4] != _MAGIC:
        raise ValueError("not a token container")
    vocabulary, docs, count = struct.unpack_from("<III", payload, 4)
    at = 16
    doc_ids = np.frombuffer(payload, "<i8", docs, at).tolist()
    present = np.frombuffer(payload, "u1", docs, at + 8 * docs)
    sizes = np.frombuffer(payload, "<u8", docs, at + 9 * docs).astype(np.int64)
    at += 17 * docs
    head = np.frombuffer(payload, "<u4", 3 * count, at).reshape(count, 3)
    at += 12 * count
    blocks = []
    for n, crc, size in head.tolist():
        blocks.append((n, crc, payload[at : at + size]))
        at += size
    ids = range_coder.decode_blocks(blocks, vocabulary)
    return [d if p else None for d, p in zip(doc_ids, present, strict=True)], sizes, ids


def _encode(path: str, keep_blanks: bool, end_id: int, vocabulary: int, container: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, shard, part = Encoder(path, keep_blanks, end_id), TaskContext.get().partitionId(), 0
        doc_ids, parts, held = [], [], 0

        def close() -> pd.DataFrame:
            payload = pack_container(doc_ids, parts, vocabulary)
            row = (shard, part, held, payload)
            return pd.DataFrame([row], columns=["shard", "part", "n_ids", "payload"])

        for frame in slices(frames, "text", _SLICE_CHARS):
            coded = encoder(frame["text"].tolist())
            for doc_id, ids in zip(frame["doc_id"], coded, strict=True):
                doc_ids.append(None if pd.isna(doc_id) else int(doc_id))
                parts.append(ids)
                held += len(parts[-1]) // 4
                if held >= container:
                    yield close()
                    doc_ids, parts, held, part = [], [], 0, part + 1
        if parts:
            yield close()

    return run


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    keep_blanks: bool = True,
    end_id: int = 2,
    vocabulary: int = 50257,
    container_ids: int = CONTAINER_IDS,
) -> None:
    """Encode every text and write containers in ascending doc_id order to ``path``."""
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = ordered.repartitionByRange(tasks, "doc_id").sortWithinPartitions("doc_id", "text")
    run = _encode(tokenizer, keep_blanks, end_id, vocabulary, container_ids)
    ordered.mapInPandas(run, _FILE).write.option("compression", "none").parquet(path)


def _decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in batches:
        for shard, before, payload in zip(
            frame["shard"], frame["before"], frame["payload"], strict=True
        ):
            doc_ids, sizes, ids = unpack_container(payload)
            data, ends = ids.tobytes(), np.cumsum(sizes)
            starts = ends - sizes
            yield pd.DataFrame(
                {
                    "shard": shard,
                    "doc_id": pd.array(doc_ids, "Int64"),
                    "in_shard": before + starts,
                    "n_tokens": sizes,
                    "ids_crc32": [
                        zlib.crc32(data[4 * a : 4 * b])
                        for a, b in zip(starts.tolist(), ends.tolist(), strict=True)
                    ],
                }
            )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document, decoded from the files: doc_id, start, n_tokens, ids_crc32."""
    files = spark.read.schema(_FILE).parquet(path)
    sizes = files.select("shard", "part", "n_ids")
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("shard_ids"))
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    first = shards.select("shard", F.coalesce(F.sum("shard_ids").over(order), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(
        "shard", "part", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("before")
    )
    read = files.join(before, ["shard", "part"]).select("shard", "before", "payload")
    decoded = read.mapInPandas(_decode, _READ)
    return decoded.join(first, "shard").select(
        "doc_id", (F.col("first") + F.col("in_shard")).alias("start"), "n_tokens", "ids_crc32"
    )


def round_trip(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write the token files to the shared scratch folder and read them back."""
    path = scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, tokenizer, **options)
    return read_token_files(docs.sparkSession, path)
