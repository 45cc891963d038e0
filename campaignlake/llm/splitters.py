"""Sharding by sampled splitters, under the law ``bytes``: shard sizes near equal.

Records are ordered by (doc_id, row). Keys are drawn with a chance in proportion to
their size; quantiles of the draw are the splitters that cut the order into ranges,
and the records are range-partitioned by them. The exact size of every range is
then summed, and ranges that hold more than ``OVERFULL`` times their share are cut
again by a fresh draw inside them, until none is left or a range is one record. A
drawn record larger than a share, and the largest record of a range to be cut, get
a range of their own, so every round cuts every such range.
Running sizes over the ranges, and over the records inside a range, give every
record its place in bytes, and the shard is the eighth (n-th) part that the middle
of the record falls into: neighbouring shards differ by about one record.

Scale: only (doc_id, row, size, crc) moves, texts never. The draw has an expected
``SAMPLE`` keys whatever the table's size. The driver holds the splitters and one
sum per range. A doc_id that a third of all rows repeat is cut too, as the row
number is part of the key.

Defined results: null text has size 1 and the crc32 of the empty text; null
doc_ids come first; rows repeating a doc_id are separate records; slots count from
0 in every shard in key order; an empty table has no shards.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import count
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaignlake.llm.common import materialize

SHARDS = 8
SAMPLE = 20_000
OVERFULL = 2.0
_KEYED = "doc_id long, row long, size long, text_crc32 long, part int"


def _key(doc_id: int | None, row: int) -> tuple:
    return doc_id is not None, doc_id or 0, row


def _draw(records: DataFrame, total: int, wanted: int, seed: int) -> list[tuple]:
    """(key, size) drawn with a chance of size * wanted / total, in order."""
    chance = F.least(F.lit(1.0), F.col("size") * F.lit(wanted / max(total, 1)))
    lot = F.pmod(F.xxhash64("row", "doc_id", F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    rows = records.where(lot < chance).select("doc_id", "row", "size").collect()
    return sorted((_key(r["doc_id"], r["row"]), r["size"]) for r in rows)


def _around(key: tuple) -> tuple[tuple, tuple]:
    """The cuts right before and after a record."""
    return key, (*key[:2], key[2] + 1)


def _cuts(drawn: list[tuple], ranges: int, share: float) -> set[tuple]:
    """Quantiles of a draw, and the cuts around its records larger than a share."""
    cuts = {drawn[k * len(drawn) // ranges][0] for k in range(1, ranges)} if drawn else set()
    for key, size in drawn:
        if size > share:
            cuts.update(_around(key))
    return cuts


def _assign(cuts: list[tuple]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            known = frame["doc_id"].notna()
            ids = frame["doc_id"].fillna(0).astype("int64")
            part = [
                bisect_right(cuts, key)
                for key in zip(known.tolist(), ids.tolist(), frame["row"].tolist(), strict=True)
            ]
            yield frame.assign(part=np.array(part, "int32"), doc_id=ids.where(known).astype("Int64"))

    return run


def _place(shards: int, total: int, before: dict[int, int]):
    """Shards of the records of sorted ranges, from the bytes before each range."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, at, shard, slot = None, 0, -1, 0
        for frame in frames:
            out = np.empty((len(frame), 2), np.int64)
            for k, (p, size) in enumerate(
                zip(frame["part"].tolist(), frame["size"].tolist(), strict=True)
            ):
                if p != part:
                    part, at, shard = p, before[p], -1
                middle = min(shards - 1, (2 * at + size) * shards // (2 * total))
                if middle != shard:
                    shard, slot = middle, 0
                out[k] = shard, slot
                slot, at = slot + 1, at + size
            yield frame.assign(
                doc_id=frame["doc_id"].astype("Int64"), shard=out[:, 0].astype("int32"), nth=out[:, 1]
            )

    return run


def shard_by_size(
    docs: DataFrame, shards: int = SHARDS, sample: int = SAMPLE, overfull: float = OVERFULL
) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    records = materialize(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.monotonically_increasing_id().alias("row"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
        ),
        "records",
    )
    total = records.agg(F.sum("size")).first()[0] or 1
    ranges = max(2 * shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    share = total / ranges
    cuts = sorted(_cuts(_draw(records, total, sample, 0), ranges, share))
    largest = F.max(F.struct("size", "doc_id", "row")).alias("largest")
    for seed in count(1):
        keyed = records.mapInPandas(_assign(cuts), _KEYED)
        found = keyed.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), largest)
        sums, wide = {}, {}
        for r in found.collect():
            sums[r["part"]] = r["bytes"]
            if r["bytes"] > overfull * share and r["n"] > 1:
                wide[r["part"]] = _key(r["largest"]["doc_id"], r["largest"]["row"])
        if not wide:
            break
        inside = keyed.where(F.col("part").isin(sorted(wide)))
        own = {p: [] for p in wide}
        for key, size in _draw(inside, sum(sums[p] for p in wide), sample, seed):
            own[bisect_right(cuts, key)].append((key, size))
        more = set(cuts)
        for p, key in wide.items():
            more.update(_around(key))
            more.update(_cuts(own[p], min(len(own[p]), ceil(sums[p] / share)), share))
        cuts = sorted(more)
    before, at = {}, 0
    for p in sorted(sums):
        before[p] = at
        at += sums[p]
    placed = (
        records.mapInPandas(_assign(cuts), _KEYED)
        .repartitionByRange(len(sums) or 1, "part")
        .sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), "row")
        .mapInPandas(_place(shards, total, before), _KEYED + ", shard int, nth long")
    )
    placed = materialize(placed, "placed")
    counts = placed.groupBy("shard", "part").count().collect()
    first, seen = [], {}
    for r in sorted(counts, key=lambda r: (r["shard"], r["part"])):
        first.append((r["shard"], r["part"], seen.get(r["shard"], 0)))
        seen[r["shard"]] = seen.get(r["shard"], 0) + r["count"]
    starts = spark.createDataFrame(first, "shard int, part int, before long")
    return placed.join(starts, ["shard", "part"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("before") + F.col("nth")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
