"""Streaming progress as data: one row per micro-batch of each layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

PROGRESS_SCHEMA = StructType(
    [
        StructField("layer", StringType()),
        StructField("batch_id", LongType()),
        StructField("num_input_rows", LongType()),
        StructField("input_rows_per_second", DoubleType()),
        StructField("processed_rows_per_second", DoubleType()),
        StructField("trigger_ms", LongType()),
    ]
)


def _rate(value) -> float | None:
    try:
        return float(value)
    except (TypeError, ValueError):
        return None


def progress_rows(progress: dict[str, list[dict]]) -> list[tuple]:
    rows = []
    for layer, entries in progress.items():
        for p in entries or []:
            durations = p.get("durationMs") or {}
            rows.append(
                (
                    layer,
                    int(p.get("batchId", -1)),
                    int(p.get("numInputRows", 0)),
                    _rate(p.get("inputRowsPerSecond")),
                    _rate(p.get("processedRowsPerSecond")),
                    int(durations.get("triggerExecution", 0)),
                )
            )
    return rows


def progress_frame(spark: SparkSession, progress: dict[str, list[dict]]) -> DataFrame:
    """Per-batch progress of a run (from ``recentProgress``; bounded by the
    number of updates Spark retains, metadata only)."""
    return spark.createDataFrame(progress_rows(progress), PROGRESS_SCHEMA)


def batches_with_data(entries: list[dict]) -> int:
    """Micro-batches of one run that read rows (``batchId + 1`` would count
    every batch since the checkpoint was created, across runs)."""
    return sum(1 for p in entries or [] if int(p.get("numInputRows", 0)) > 0)
