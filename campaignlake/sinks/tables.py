"""Layer sinks: append streams and full-overwrite batch tables.

Format is a parameter (``parquet`` here; ``delta`` where its jars exist).
Delta-only options (``mergeSchema`` on append, ``overwriteSchema``, change
data feed) are passed through for Delta and dropped for Parquet, where
schema evolution is read-side (``mergeSchema`` on read) and an overwrite
replaces the schema anyway.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

_DELTA_ONLY = {"mergeSchema", "overwriteSchema", "delta.enableChangeDataFeed"}


def _options(fmt: str, options: dict[str, str] | None) -> dict[str, str]:
    opts = dict(options or {})
    if fmt != "delta":
        opts = {k: v for k, v in opts.items() if k not in _DELTA_ONLY}
    return opts


def _same_path(a: str, b: str) -> bool:
    def norm(p: str) -> str:
        return p[len("file:"):].rstrip("/") if p.startswith("file:") else p.rstrip("/")

    return norm(a) == norm(b)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    mode: str = "overwrite",
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    rebalance: bool = True,
    source_paths: list[str] | None = None,
    cluster_by: list[str] | None = None,
) -> None:
    """Batch write of a layer table.

    ``rebalance`` asks AQE to shuffle rows by the partition columns and then
    split oversized partitions and merge small ones, so each table partition
    gets a few right-sized files: no file explosion from every task writing
    every partition, and no single task writing a hot partition.

    ``cluster_by`` sorts rows within each task before writing, so Parquet
    row-group min/max statistics on those columns are narrow and a range
    predicate (e.g. a time window) skips most of the table.

    Refuses to overwrite a path the plan reads from (``source_paths``):
    a Parquet overwrite deletes its own input before reading it.
    """
    if mode == "overwrite" and any(_same_path(path, s) for s in source_paths or []):
        raise ValueError(f"refusing to overwrite {path}: it is also an input of this plan")
    if rebalance and partition_by:
        df = df.hint("rebalance", *partition_by)
    if cluster_by:
        # a per-task sort (no shuffle): row groups then cover narrow ranges
        # of these columns, so range filters skip them by their statistics
        df = df.sortWithinPartitions(*(partition_by or []), *cluster_by)
    writer = df.write.format(fmt).mode(mode).options(**_options(fmt, options))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def salted_partitioning(df: DataFrame, partition_by: list[str], salt_cols: list[str], buckets: int) -> DataFrame:
    """Shuffle rows so each table partition value lands in at most
    ``buckets`` tasks: few files per partition directory, and a hot value is
    still split ``buckets`` ways (deterministic salt, so a retried task
    reproduces the same shuffle)."""
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in salt_cols]), F.lit(buckets))
    # one task per core: streams cannot coalesce partitions at run time (no
    # AQE), so the shuffle-partition default would be a guess either way
    tasks = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(tasks, *[F.col(c) for c in partition_by], salt)


def start_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: list[str] | None = None,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    query_name: str | None = None,
    salt: tuple[list[str], int] | None = None,
) -> StreamingQuery:
    """Append-mode stream into a layer table with exactly-once progress
    tracked in ``checkpoint``.  ``available_now`` drains what is there and
    stops (the scheduled-batch mode); else ``processing_time`` runs it on a
    timer.  ``salt=(columns, buckets)`` applies :func:`salted_partitioning`
    before a partitioned write (streams run without AQE, so the batch
    ``rebalance`` cannot be used)."""
    if salt and partition_by:
        df = salted_partitioning(df, partition_by, salt[0], salt[1])
    writer = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .options(**_options(fmt, options))
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start(path)
