"""Structured Streaming form of the raw and typed layers and the layer chain."""

from campaignlake.streaming.layers import (
    RAW_SCHEMA,
    LayerPaths,
    LayerRun,
    await_query,
    build_metrics,
    refresh_metrics,
    run_layers,
    start_raw_stream,
    start_typed_stream,
    typed_stream,
)
from campaignlake.streaming.progress import batches_with_data, progress_frame

__all__ = [
    "RAW_SCHEMA",
    "LayerPaths",
    "LayerRun",
    "await_query",
    "batches_with_data",
    "build_metrics",
    "progress_frame",
    "refresh_metrics",
    "run_layers",
    "start_raw_stream",
    "start_typed_stream",
    "typed_stream",
]
