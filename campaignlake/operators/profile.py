"""Data profiles of the layers, as DataFrames a caller can show, test or
store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campaignlake.operators.quarantine import quarantine_reason


def raw_profile(raw: DataFrame, ordered: bool = False) -> DataFrame:
    """Records per (event_type, event_date); foreign/bad payloads show as NULLs."""
    out = raw.groupBy("event_type", "event_date").agg(F.count("*").alias("count"))
    return out.orderBy("event_date", "event_type") if ordered else out


def typed_profile(typed: DataFrame, approximate: bool = False, rsd: float = 0.01) -> DataFrame:
    """Per event type: rows, distinct event ids, campaigns and users.

    ``total == distinct_events`` is the dedup check.  Exact distinct counts
    use Spark's Expand rewrite (one shuffle, every distinct value crosses it
    once); ``approximate`` swaps in HyperLogLog++ sketches, which merge
    map-side and keep the shuffle at one sketch per group per task.
    """
    if approximate:
        def distinct(c):
            return F.approx_count_distinct(c, rsd)
    else:
        def distinct(c):
            return F.count_distinct(c)
    return typed.groupBy("event_type").agg(
        F.count("*").alias("total"),
        distinct("event_id").alias("distinct_events"),
        distinct("campaign_id").alias("campaigns"),
        distinct("user_id_hashed").alias("users"),
    )


def type_counts(typed: DataFrame) -> DataFrame:
    """Rows per event type in one grouped job (not one count job per type)."""
    return typed.groupBy("event_type").agg(F.count("*").alias("events"))


def layer_counts(raw: DataFrame, typed: DataFrame) -> DataFrame:
    """Conservation check: raw records are typed events, quarantined records and
    the further copies of events (``duplicates``: what is left of raw without the
    other two). Each table is read once."""
    of_raw = raw.agg(
        F.count("*").alias("raw"), F.count_if(quarantine_reason().isNotNull()).alias("quarantine")
    ).withColumn("typed", F.lit(0).cast("long"))
    of_typed = typed.agg(F.count("*").alias("typed")).withColumns(
        {"raw": F.lit(0).cast("long"), "quarantine": F.lit(0).cast("long")}
    )
    total = of_raw.unionByName(of_typed).agg(*(F.sum(c).alias(c) for c in ("raw", "typed", "quarantine")))
    total = total.withColumn("duplicates", F.expr("raw - typed - quarantine"))
    return total.unpivot([], ["raw", "typed", "quarantine", "duplicates"], "layer", "rows")
