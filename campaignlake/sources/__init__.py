"""Sources: the event topic (Kafka or files of the same shape), layer tables,
and the fixture that derives topic records from the ``events`` table."""

from campaignlake.sources.fixtures import kafka_records, mapped_events
from campaignlake.sources.tables import read_table, read_table_stream
from campaignlake.sources.topic import (
    kafka_options,
    read_kafka_stream,
    read_records,
    read_records_stream,
)

__all__ = [
    "kafka_options",
    "kafka_records",
    "mapped_events",
    "read_kafka_stream",
    "read_records",
    "read_records_stream",
    "read_table",
    "read_table_stream",
]
