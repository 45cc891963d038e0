"""Column functions over the JSON payload of a record (all JVM built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def payload_string(col: str | Column = "value") -> Column:
    """Kafka ``value`` bytes as a UTF-8 string."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("string")


def safe_date(text: Column) -> Column:
    """Calendar day of an ISO-8601 string, NULL (not an error) on garbage.

    The string's own day is used (no zone conversion), so an event at 01:30Z
    is dated by its UTC day.  ``try_cast`` keeps a bad value from failing the
    stream under ANSI mode.
    """
    return text.try_cast("date")


def event_day(ts: str | Column) -> Column:
    """Day of a timestamp in the session time zone (pinned to UTC)."""
    return F.to_date(ts)
