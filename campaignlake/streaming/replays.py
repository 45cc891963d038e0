"""Typed layer without dedup state: replays are found in the typed table itself.

The stateful dedup (:func:`campaignlake.operators.dedup.dedup_stream`) keeps every
event id for ever. Here a micro-batch is deduplicated in itself (a partial limit before
the shuffle, so copies of a hot id never meet in one task) and then anti-joined with the
ids of the typed table. A producer's retry sends the same payload, so the copies of an
event share its timestamp: only the days that the batch speaks of are looked up, as
timestamp ranges that Parquet's row-group statistics prune. A replay of last year reads
that day of last year and nothing between. ``anywhere=True`` looks ids up in the whole
table, for producers that send an id again with another timestamp.

What is kept between runs is the source's offsets; it doesn't grow with the events. The
table is also what makes a batch repeatable: rows that a lost attempt has written are
known ids to the next attempt, so nothing is written twice or lost.

Defined results: of copies in a batch the one with the lowest (partition, offset) stays,
of copies in several batches the first to arrive. Rows with a null id are left out (they
are the quarantine's). Null timestamps are one more range. An empty batch writes nothing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from campaignlake.operators.dedup import dedup_events
from campaignlake.operators.typed import parse_typed
from campaignlake.schemas import (
    LINEAGE_COLUMNS,
    RAW_COLUMNS,
    RAW_SCHEMA,
    TYPED_COLUMNS,
    TYPED_PARTITION_COLUMNS,
    TYPED_SCHEMA,
)
from campaignlake.sinks.tables import write_table
from campaignlake.sources.tables import read_table, read_table_stream
from campaignlake.streaming.layers import LayerPaths

#: Ranges of a filter. Beyond it the narrowest gaps are closed: more is read, nothing is missed.
MOST_RANGES = 40

_DAY = dt.timedelta(days=1)


def close_gaps(days: list[dt.date], most: int = MOST_RANGES) -> list[tuple[dt.date, dt.date]]:
    """At most ``most`` ranges (first day, last day) that hold all ``days``."""
    days = sorted(set(days))
    if not days:
        return []
    gaps = [(later - day, later) for day, later in zip(days, days[1:]) if later - day > _DAY]
    starts = sorted(later for _, later in sorted(gaps, reverse=True)[: most - 1])
    ends = [max(d for d in days if d < start) for start in starts]
    return list(zip([days[0], *starts], [*ends, days[-1]]))


def span_of(batch: DataFrame, at: str = "event_timestamp") -> Column | None:
    """A filter on ``at`` that holds for every row of a day in ``batch``; None without rows.

    The days of a batch are collected: there are no more of them than the calendar has.
    """
    days = [r["day"] for r in batch.select(F.to_date(at).alias("day")).distinct().collect()]
    parts = []
    for first, last in close_gaps([d for d in days if d is not None]):
        part = F.col(at) >= F.lit(dt.datetime.combine(first, dt.time(), dt.timezone.utc))
        if last < dt.date.max:
            part &= F.col(at) < F.lit(dt.datetime.combine(last + _DAY, dt.time(), dt.timezone.utc))
        parts.append(part)
    if None in days:
        parts.append(F.col(at).isNull())
    held = None
    for part in parts:
        held = part if held is None else held | part
    return held


def unseen(batch: DataFrame, known: DataFrame, key: str = "event_id", anywhere: bool = False) -> DataFrame:
    """One row for each id of ``batch`` (typed rows with lineage) that isn't in ``known``."""
    if not anywhere:
        span = span_of(batch)
        known = known.where(F.lit(False) if span is None else span)
    return dedup_events(batch, key).join(known.select(key), key, "left_anti")


def append_unseen(batch: DataFrame, paths: LayerPaths, anywhere: bool = False) -> None:
    """Append the new events of a batch to the typed table; a repeated call adds nothing."""
    known = read_table(batch.sparkSession, paths.typed, TYPED_COLUMNS, schema=TYPED_SCHEMA)
    write_table(
        unseen(batch, known, anywhere=anywhere).select(*TYPED_COLUMNS),
        paths.typed,
        partition_by=TYPED_PARTITION_COLUMNS,
        mode="append",
        fmt=paths.fmt,
        cluster_by=["event_timestamp"],
    )


def _refuse_stream_table(spark: SparkSession, path: str) -> None:
    """A table that a streaming file sink wrote is read by that sink's log, which has no other files."""
    log = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_spark_metadata")
    if log.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(log):
        raise ValueError(f"{path} was written by a streaming file sink; readers would not see rows added here")


def start_typed_lookup_stream(
    spark: SparkSession,
    paths: LayerPaths,
    single_pass: bool = True,
    max_files_per_trigger: int | None = None,
    anywhere: bool = False,
) -> StreamingQuery:
    """Raw table -> typed table, exactly once per event id, without dedup state."""
    _refuse_stream_table(spark, paths.typed)
    # creates the table on a first run
    spark.createDataFrame([], TYPED_SCHEMA).select(*TYPED_COLUMNS).write.mode("append").partitionBy(
        *TYPED_PARTITION_COLUMNS
    ).format(paths.fmt).save(paths.typed)
    raw = read_table_stream(
        spark, paths.raw, RAW_SCHEMA, RAW_COLUMNS, fmt=paths.fmt, max_files_per_trigger=max_files_per_trigger
    )
    parsed = parse_typed(raw, single_pass=single_pass, carry=LINEAGE_COLUMNS)
    return (
        parsed.writeStream.foreachBatch(lambda batch, _: append_unseen(batch, paths, anywhere))
        .option("checkpointLocation", paths.typed_checkpoint)
        .trigger(availableNow=True)
        .start()
    )
