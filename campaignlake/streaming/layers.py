"""The three layers as incremental jobs, run in order.

raw:     topic (Kafka, or files of Kafka-shaped records) -> raw table,
         append stream, partitioned by (event_date, event_type)
typed:   raw table (incremental file/Delta read) -> parse -> exact dedup
         by event_id -> typed table, append stream, partitioned by event_type
metrics: typed table -> KPIs -> metrics table, full overwrite by event_date

Streams use ``availableNow``: each run drains everything new since the last
committed offsets in its checkpoint and stops, so a scheduler can run the
chain every N minutes and a rerun with no new input adds nothing.  Each
layer starts only after the previous one finished; a failure raises and
stops the chain.  Checkpoints and tables live under paths the caller gives
(on a cluster: the shared checkpoint folder / object store, never a local
disk), so a lost executor or driver resumes from the last committed batch.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StructField, StructType

from campaignlake.functions.payload import event_day
from campaignlake.operators.dedup import dedup_stream
from campaignlake.operators.metrics import campaign_metrics, campaign_metrics_single_pass
from campaignlake.operators.raw import to_raw
from campaignlake.operators.typed import parse_typed
from campaignlake.schemas import (
    LINEAGE_COLUMNS,
    METRICS_COLUMNS,
    METRICS_PARTITION_COLUMNS,
    RAW_COLUMNS,
    RAW_PARTITION_COLUMNS,
    RAW_SCHEMA,
    TYPED_COLUMNS,
    TYPED_PARTITION_COLUMNS,
    TYPED_SCHEMA,
)
from campaignlake.session import session_conf
from campaignlake.sinks.tables import start_stream, write_table
from campaignlake.sources.tables import read_table, read_table_stream
from campaignlake.sources.topic import read_kafka_stream, read_records_stream

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STATE_CONF = "spark.sql.streaming.stateStore.providerClass"
_CHANGELOG_CONF = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


@dataclass
class LayerPaths:
    """Where each layer's table and checkpoint live."""

    source: str | None
    raw: str
    typed: str
    metrics: str
    raw_checkpoint: str
    typed_checkpoint: str
    fmt: str = "parquet"
    metrics_cursor: str | None = None
    dirty_days: str | None = None

    @classmethod
    def under(cls, root: str, source: str | None = None, fmt: str = "parquet") -> "LayerPaths":
        root = root.rstrip("/")
        return cls(
            source=source,
            raw=f"{root}/raw/campaign_events",
            typed=f"{root}/typed/campaign_events",
            metrics=f"{root}/metrics/campaign_metrics",
            raw_checkpoint=f"{root}/checkpoints/raw_campaign_events",
            typed_checkpoint=f"{root}/checkpoints/typed_campaign_events",
            fmt=fmt,
            metrics_cursor=f"{root}/checkpoints/metrics_cursor",
            dirty_days=f"{root}/checkpoints/metrics_dirty_days",
        )


@dataclass
class LayerRun:
    """What one run of the chain did (progress of each streaming layer)."""

    progress: dict[str, list[dict]] = field(default_factory=dict)


def exact_state(spark: SparkSession, state_partitions: int | None = None):
    """RocksDB state (unless the session names a provider) for a query started inside."""
    settings = {}
    if not spark.conf.get(_STATE_CONF, None):
        settings = {_STATE_CONF: _ROCKSDB, _CHANGELOG_CONF: "true"}
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    return session_conf(spark, settings)


def start_raw_stream(
    spark: SparkSession,
    paths: LayerPaths,
    kafka: dict[str, str] | None = None,
    records_format: str = "parquet",
    max_files_per_trigger: int | None = None,
    salt_buckets: int | None = None,
) -> StreamingQuery:
    """Topic -> raw table.  ``kafka`` options select the Kafka source; else
    ``paths.source`` holds record files.  ``salt_buckets`` bounds the files
    per (event_date, event_type) directory of a micro-batch (useful for
    backfills that span many days); by default rows are written where they
    are read, with no shuffle."""
    if kafka:
        records = read_kafka_stream(spark, kafka)
    else:
        records = read_records_stream(spark, paths.source, records_format, max_files_per_trigger)
    return start_stream(
        to_raw(records).select(*RAW_COLUMNS),
        paths.raw,
        paths.raw_checkpoint,
        partition_by=RAW_PARTITION_COLUMNS,
        fmt=paths.fmt,
        options={"mergeSchema": "true"},
        salt=(["eh_partition", "eh_offset"], salt_buckets) if salt_buckets else None,
    )


def typed_stream(
    spark: SparkSession,
    paths: LayerPaths,
    single_pass: bool = True,
    dedup: bool = True,
    max_files_per_trigger: int | None = None,
    dedup_salt_buckets: int | None = None,
) -> DataFrame:
    """The typed layer as a streaming DataFrame over the raw table."""
    raw = read_table_stream(
        spark, paths.raw, RAW_SCHEMA, RAW_COLUMNS, fmt=paths.fmt, max_files_per_trigger=max_files_per_trigger
    )
    carry = LINEAGE_COLUMNS if dedup_salt_buckets else None
    parsed = parse_typed(raw, single_pass=single_pass, carry=carry)
    if dedup:
        parsed = dedup_stream(parsed, salt_buckets=dedup_salt_buckets)
    return parsed.select(*TYPED_COLUMNS)


def start_typed_stream(
    spark: SparkSession,
    paths: LayerPaths,
    single_pass: bool = True,
    dedup: bool = True,
    max_files_per_trigger: int | None = None,
    dedup_salt_buckets: int | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Raw table -> typed table (exact dedup state in the checkpoint).

    ``state_partitions`` sets how many partitions the dedup state (and its
    shuffle) gets when the checkpoint is new; Spark then keeps that number
    for the life of the checkpoint.  Streams cannot coalesce partitions at
    run time, so this should follow the data (about one per core for a
    backfill); by default the session's ``spark.sql.shuffle.partitions``
    applies.  The setting is scoped to this query: a started stream runs on
    its own copy of the session conf, and the session's value is restored.
    """
    df = typed_stream(spark, paths, single_pass, dedup, max_files_per_trigger, dedup_salt_buckets)
    settings = {}
    if dedup and not spark.conf.get(_STATE_CONF, None):
        settings = {_STATE_CONF: _ROCKSDB, _CHANGELOG_CONF: "true"}
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    with session_conf(spark, settings):
        return start_stream(
            df,
            paths.typed,
            paths.typed_checkpoint,
            partition_by=TYPED_PARTITION_COLUMNS,
            fmt=paths.fmt,
            options={"mergeSchema": "true", "delta.enableChangeDataFeed": "true"},
        )


def build_metrics(
    spark: SparkSession,
    paths: LayerPaths,
    single_pass: bool = False,
    exact: bool = False,
) -> None:
    """Typed table -> metrics table, recomputed in full and overwritten.

    With ``fmt="delta"`` the overwrite is one atomic commit; a Parquet
    overwrite replaces files in place, so readers should not query the
    metrics table while it is being rebuilt."""
    typed = read_table(spark, paths.typed, TYPED_COLUMNS, fmt=paths.fmt, schema=TYPED_SCHEMA)
    build = campaign_metrics_single_pass if single_pass else campaign_metrics
    metrics = build(typed, exact=exact).select(*METRICS_COLUMNS)
    write_table(
        metrics,
        paths.metrics,
        partition_by=METRICS_PARTITION_COLUMNS,
        mode="overwrite",
        fmt=paths.fmt,
        options={"overwriteSchema": "true"},
        source_paths=[paths.typed],
    )


DIRTY_DAYS_SCHEMA = StructType([StructField("event_date", DateType())])


def _record_dirty_days(spark: SparkSession, paths: LayerPaths, timeout_seconds: float | None) -> None:
    """Append the days of typed rows added since the cursor last ran.

    The cursor is a stream over the typed table with its own checkpoint, so
    every typed file is accounted for exactly once; each micro-batch writes
    its distinct days (a retried batch only repeats days, which is harmless).
    """
    new_rows = read_table_stream(spark, paths.typed, TYPED_SCHEMA, ["event_timestamp"], fmt=paths.fmt)
    days = new_rows.select(event_day("event_timestamp").alias("event_date"))

    def record(batch: DataFrame, _batch_id: int) -> None:
        batch.distinct().write.mode("append").format("parquet").save(paths.dirty_days)

    query = (
        days.writeStream.foreachBatch(record)
        .option("checkpointLocation", paths.metrics_cursor)
        .trigger(availableNow=True)
        .start()
    )
    await_query(query, timeout_seconds)


def dirty_day_metrics(
    spark: SparkSession,
    paths: LayerPaths,
    single_pass: bool = False,
    exact: bool = False,
) -> DataFrame | None:
    """Metrics rows of the days recorded as dirty, or None when there are none.

    The typed scan is limited to the dirty days' time span by a literal
    ``event_timestamp`` range (taken from a one-row summary of the small day
    set), which Parquet row-group statistics use to skip files outside it;
    a semi-join then keeps exactly the dirty days.
    """
    dirty = read_table(spark, paths.dirty_days, schema=DIRTY_DAYS_SCHEMA).distinct()
    span = dirty.agg(
        F.min("event_date").alias("lo"),
        F.max("event_date").alias("hi"),
        F.count_if(F.col("event_date").isNull()).alias("undated"),
    ).first()
    if span["lo"] is None and not span["undated"]:
        return None
    ts = F.col("event_timestamp")
    in_span = F.lit(False)
    if span["lo"] is not None:
        lo = F.lit(span["lo"]).cast("timestamp")
        hi = F.date_add(F.lit(span["hi"]), 1).cast("timestamp")
        in_span = (ts >= lo) & (ts < hi)
    if span["undated"]:
        in_span = in_span | ts.isNull()
    typed = read_table(spark, paths.typed, TYPED_COLUMNS, fmt=paths.fmt, schema=TYPED_SCHEMA).where(in_span)
    scoped = typed.join(dirty, event_day("event_timestamp").eqNullSafe(dirty["event_date"]), "left_semi")
    build = campaign_metrics_single_pass if single_pass else campaign_metrics
    return build(scoped, exact=exact).select(*METRICS_COLUMNS)


def refresh_metrics(
    spark: SparkSession,
    paths: LayerPaths,
    single_pass: bool = False,
    exact: bool = False,
    timeout_seconds: float | None = None,
) -> None:
    """Bring the metrics table up to date by recomputing only the days that
    received typed rows since the last refresh.

    A day's metrics depend only on that day's events, so this gives the same
    table as :func:`build_metrics` while reading and writing far less on a
    table that grows every run (see :func:`dirty_day_metrics`); only the
    dirty days' ``event_date`` partitions are replaced (dynamic partition
    overwrite).  The dirty-day set is cleared only after the metrics write
    succeeded; after a crash the same days are simply recomputed.
    """
    # an empty append creates the dirty-day table on a first run
    spark.createDataFrame([], DIRTY_DAYS_SCHEMA).write.mode("append").format("parquet").save(paths.dirty_days)
    _record_dirty_days(spark, paths, timeout_seconds)
    metrics = dirty_day_metrics(spark, paths, single_pass, exact)
    if metrics is None:
        return
    write_table(
        metrics,
        paths.metrics,
        partition_by=METRICS_PARTITION_COLUMNS,
        mode="overwrite",
        fmt=paths.fmt,
        options={"partitionOverwriteMode": "dynamic"},
        source_paths=[paths.typed],
    )
    spark.createDataFrame([], DIRTY_DAYS_SCHEMA).write.mode("overwrite").format("parquet").save(paths.dirty_days)


PROGRESS_POLL_SECONDS = 0.2


def await_query(query: StreamingQuery, timeout_seconds: float | None = None) -> list[dict]:
    """Wait for an ``availableNow`` query; raise if it failed or timed out.

    Returns the progress of every batch of this run. Spark keeps only the latest
    updates, so they are gathered while the query runs.
    """
    batches: dict[int, dict] = {}

    def gather() -> None:
        for p in query.recentProgress:
            # an update without rows may follow a batch's own under the same id
            known = batches.get(p["batchId"])
            if known is None or int(p["numInputRows"]) >= int(known["numInputRows"]):
                batches[p["batchId"]] = p

    end = time.monotonic() + timeout_seconds if timeout_seconds else None
    while not query.awaitTermination(PROGRESS_POLL_SECONDS):
        gather()
        if end and time.monotonic() > end:
            query.stop()
            raise TimeoutError(f"streaming query {query.id} did not finish in {timeout_seconds}s")
    if query.exception() is not None:
        raise query.exception()
    gather()
    return [batches[k] for k in sorted(batches)]


def run_layers(
    spark: SparkSession,
    paths: LayerPaths,
    kafka: dict[str, str] | None = None,
    single_pass_parse: bool = True,
    dedup: bool = True,
    single_pass_metrics: bool = False,
    exact: bool = False,
    timeout_seconds: float | None = None,
    max_files_per_trigger: int | None = None,
    salt_buckets: int | None = None,
    dedup_salt_buckets: int | None = None,
    incremental_metrics: bool = False,
    state_partitions: int | None = None,
) -> LayerRun:
    """raw, then typed, then metrics; each starts after the previous ended.

    For a backfill (many days in one run) pass ``salt_buckets`` (e.g. 2-8)
    to keep the raw table's file count per directory bounded;
    ``dedup_salt_buckets`` protects the typed stream against a replay storm
    of one event id (see :func:`campaignlake.operators.dedup.dedup_stream`);
    ``incremental_metrics`` recomputes only the days that received new events
    (:func:`refresh_metrics`) instead of the whole metrics table."""
    run = LayerRun()
    raw_q = start_raw_stream(
        spark, paths, kafka, max_files_per_trigger=max_files_per_trigger, salt_buckets=salt_buckets
    )
    run.progress["raw"] = await_query(raw_q, timeout_seconds)
    typed_q = start_typed_stream(
        spark, paths, single_pass_parse, dedup, dedup_salt_buckets=dedup_salt_buckets, state_partitions=state_partitions
    )
    run.progress["typed"] = await_query(typed_q, timeout_seconds)
    if incremental_metrics:
        refresh_metrics(spark, paths, single_pass=single_pass_metrics, exact=exact, timeout_seconds=timeout_seconds)
    else:
        build_metrics(spark, paths, single_pass=single_pass_metrics, exact=exact)
    return run
