"""Quarantine: raw records that never become typed events.

A record lands here when its ``event_type`` is missing or not one of the
three known types (foreign payloads, connection probes, malformed JSON), or
when it is of a known type but its parse yields no ``event_id``.  Together
with the typed table this accounts for every raw record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from campaignlake.schemas import COMMON_FIELDS, EVENT_TYPES, RAW_COLUMNS

_ID_ONLY = StructType([f for f in COMMON_FIELDS if f.name == "event_id"])


def quarantine_reason() -> Column:
    """Why a raw row is no typed event; NULL for those that are."""
    t = F.col("event_type")
    known = F.coalesce(t.isin(*EVENT_TYPES), F.lit(False))
    parsed_id = F.from_json(F.col("raw_payload"), _ID_ONLY).getField("event_id")
    return F.when(~known, F.lit("unknown_event_type")).when(parsed_id.isNull(), F.lit("missing_event_id"))


def quarantine(raw: DataFrame) -> DataFrame:
    """Raw rows (without the ingest clock) plus a ``reason`` column."""
    cols = [c for c in RAW_COLUMNS if c != "ingested_at"]
    return raw.select(*cols, quarantine_reason().alias("reason")).filter(F.col("reason").isNotNull())
