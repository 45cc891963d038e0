"""Metrics kept by signed deltas: each drain reads its new typed rows only.

A cursor stream over the typed table (own checkpoint) reduces every micro-batch to
signed partials and writes them to a folder named by the batch's number, so that a
retried batch replaces its own folder. Events are taken back by name: the partials of
``retract`` with one name replace each other too. The metrics table is merged from all
partials. ``compact`` merges a generation of partials into the base of the next one,
which counts once its ``_SUCCESS`` marker is there; it runs between drains (a drain
that was cut short is finished first), so no batch is in two generations.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from campaignlake.operators.deltas import (
    PARTIAL_SCHEMA,
    merge_partials,
    metrics_from_partials,
    signed_partials,
)
from campaignlake.schemas import (
    METRICS_COLUMNS,
    METRICS_PARTITION_COLUMNS,
    TYPED_COLUMNS,
    TYPED_SCHEMA,
)
from campaignlake.sinks.tables import write_table
from campaignlake.sources.tables import read_table_stream
from campaignlake.streaming.layers import LayerPaths, await_query


def _root(paths: LayerPaths) -> str:
    return f"{paths.metrics}_deltas"


def _files(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _exists(spark: SparkSession, path: str) -> bool:
    fs, target = _files(spark, path)
    return fs.exists(target)


def generation(spark: SparkSession, paths: LayerPaths) -> int:
    """The generation that counts: the latest with a complete base, else 0."""
    fs, root = _files(spark, _root(paths))
    if not fs.exists(root):
        return 0
    numbers = [int(f.getPath().getName().removeprefix("gen=")) for f in fs.listStatus(root)]
    whole = [n for n in numbers if _exists(spark, f"{_root(paths)}/gen={n}/part=base/_SUCCESS")]
    return max(whole, default=0)


def _write(partials: DataFrame, paths: LayerPaths, part: str, number: int | None = None) -> None:
    number = generation(partials.sparkSession, paths) if number is None else number
    # partials are a row per campaign and day; a few files hold them
    partials.coalesce(8).write.mode("overwrite").parquet(f"{_root(paths)}/gen={number}/part={part}")


def drain_deltas(spark: SparkSession, paths: LayerPaths, timeout_seconds: float | None = None) -> list[dict]:
    """Write the partials of the typed rows that came since the last drain."""
    rows = read_table_stream(spark, paths.typed, TYPED_SCHEMA, TYPED_COLUMNS, fmt=paths.fmt)

    def record(batch: DataFrame, batch_id: int) -> None:
        _write(signed_partials(batch), paths, f"batch-{batch_id}")

    query = (
        rows.writeStream.foreachBatch(record)
        .option("checkpointLocation", f"{paths.typed_checkpoint}_deltas")
        .trigger(availableNow=True)
        .start()
    )
    return await_query(query, timeout_seconds)


def retract(typed: DataFrame, paths: LayerPaths, name: str) -> None:
    """Take back typed events; a second call with this name replaces the first."""
    if not re.fullmatch(r"[A-Za-z0-9_]+", name):
        raise ValueError(f"name is {name!r}, letters, digits and underscores are needed")
    _write(signed_partials(typed, -1), paths, f"retract-{name}")


def partials(spark: SparkSession, paths: LayerPaths) -> DataFrame:
    """All partials that count."""
    root = f"{_root(paths)}/gen={generation(spark, paths)}"
    if not _exists(spark, root):
        return spark.createDataFrame([], PARTIAL_SCHEMA)
    return spark.read.schema(PARTIAL_SCHEMA).option("recursiveFileLookup", "true").parquet(root)


def compact(spark: SparkSession, paths: LayerPaths) -> None:
    """Merge the partials into the base of a new generation."""
    number = generation(spark, paths)
    _write(merge_partials(partials(spark, paths)), paths, "base", number + 1)
    fs, target = _files(spark, f"{_root(paths)}/gen={number - 1}")
    fs.delete(target, True)  # the generation before the last; readers may still use that


def write_metrics(spark: SparkSession, paths: LayerPaths, exact: bool = False) -> None:
    """Overwrite the metrics table with what the partials say."""
    write_table(
        metrics_from_partials(partials(spark, paths), exact=exact).select(*METRICS_COLUMNS),
        paths.metrics,
        partition_by=METRICS_PARTITION_COLUMNS,
        mode="overwrite",
        fmt=paths.fmt,
        options={"overwriteSchema": "true"},
        source_paths=[paths.typed, _root(paths)],
    )
