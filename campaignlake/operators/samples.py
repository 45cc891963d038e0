"""Samples and rankings.

Samples take an explicit order key so they are reproducible; with a limit
Spark plans them as TakeOrderedAndProject (a per-task top-n, then a merge of
n rows per task), never a full sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def raw_sample(raw: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` records in topic order (partition, offset)."""
    return raw.orderBy("eh_partition", "eh_offset").limit(n)


def typed_sample(typed: DataFrame, event_type: str = "conversion", n: int = 10) -> DataFrame:
    """``n`` events of one type, by event id."""
    return typed.filter(F.col("event_type") == event_type).orderBy("event_id").limit(n)


def roas_ranking(metrics: DataFrame, top: int | None = None) -> DataFrame:
    """Metrics rows by ROAS, best first (NULLs last), ties by day and campaign.

    Without ``top`` this is a distributed range-partitioned sort; with it, a
    top-k.
    """
    ordered = metrics.orderBy(F.col("roas").desc_nulls_last(), "event_date", "campaign_id", "advertiser_id")
    return ordered.limit(top) if top else ordered
