"""Freshness against the end-to-end target (event to metric within a window)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the schedule target, minutes from event to metric.
SLA_MINUTES = 30


def _minutes(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier)) / F.lit(60_000_000)


def layer_freshness(
    raw: DataFrame,
    typed: DataFrame,
    metrics: DataFrame,
    as_of: Column | None = None,
    sla_minutes: int = SLA_MINUTES,
) -> DataFrame:
    """Per layer: rows, the newest event in it, minutes from that event to ``as_of``
    (default: now), whether that is within the target, and when its newest row was
    written. Metrics rows only know their day, so their newest event is that day's
    start. An unreadable event time counts as no event; an empty layer has NULLs."""
    as_of = as_of if as_of is not None else F.current_timestamp()

    def one(layer: str, rows: DataFrame, event: Column, written: str) -> DataFrame:
        return rows.agg(
            F.count("*").alias("rows"), F.max(event).alias("newest_event"), F.max(written).alias("newest_write")
        ).withColumn("layer", F.lit(layer))

    layers = (
        one("raw", raw, F.col("event_timestamp").try_cast("timestamp"), "ingested_at")
        .unionByName(one("typed", typed, F.col("event_timestamp"), "ingested_at"))
        .unionByName(one("metrics", metrics, F.col("event_date").cast("timestamp"), "updated_at"))
    )
    staleness = _minutes(as_of, F.col("newest_event"))
    return layers.select(
        "layer",
        "rows",
        "newest_event",
        F.round(staleness, 3).alias("staleness_minutes"),
        (staleness <= F.lit(sla_minutes)).alias("within_sla"),
        "newest_write",
    )


def freshness(raw: DataFrame, as_of: Column | None = None, sla_minutes: int = SLA_MINUTES) -> DataFrame:
    """Per event type in the raw layer: records, last enqueue time, minutes
    from it to ``as_of`` (default: now), whether that is within the target,
    and the worst enqueue-to-ingest delay seen."""
    as_of = as_of if as_of is not None else F.current_timestamp()
    staleness = _minutes(as_of, F.col("last_enqueued"))
    agg = raw.groupBy("event_type").agg(
        F.count("*").alias("records"),
        F.max("eh_enqueued_time").alias("last_enqueued"),
        F.max(F.unix_micros("ingested_at") - F.unix_micros("eh_enqueued_time")).alias("__lag_us"),
    )
    return agg.select(
        "event_type",
        "records",
        "last_enqueued",
        F.round(staleness, 3).alias("staleness_minutes"),
        (staleness <= F.lit(sla_minutes)).alias("within_sla"),
        (F.col("__lag_us") / F.lit(1_000_000)).alias("max_ingest_delay_seconds"),
    )
